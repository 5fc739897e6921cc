"""Near-duplicate documents: banded MinHash candidates, odd sketches, exact confirmation, connected classes.

1. Every text becomes its set of word shingles, 128 MinHash samples in 32 bands of 4, and an odd sketch: the samples folded into a bitmap
   by parity. Equal sets are one *class* from here on, however many copies there are.
2. Classes that share a band meet at the least class of that band, their *centre*: one row per class and centre, never one per pair.
   All classes of a band are with its centre, so whatever pair shares a band is together in one centre's group.
3. Groups are dealt out in blocks of bounded size. In a block the odd sketches (population count of the XOR) and the set
   sizes rule pairs out; the rest is confirmed on the full sets, which are taken anew from the texts. A block returns
   only a spanning forest of its links.
4. Components of these links. A group of several blocks, whose classes are not all connected yet, is then finished exactly: each class
   outside its largest component meets all blocks of the group.
5. Components again; each document gets the smallest id in its component.

A pair at the threshold of 0.8 shares no band with probability 5e-8, and passes the odd sketch but for six standard deviations.

Defined results: NULL and empty texts, and texts without a word, have the empty set: linked with nothing, their component is their own id.
Repeated rows are copies like others. A NULL id never is the smallest; where a component has no other, its id is NULL and its rows are kept.
An empty table gives an empty result. Extra columns, whatever their names, are ignored by ``near_duplicates`` and kept by
``deduplicated``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import materialize, mix, shingle_set, unique
from refloom.operators.graph import components

BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
ODD_BITS = 512
#: Parts that the rows of a centre are dealt out to for a join.
SALTS = 32
#: Classes, and shingles, in a block on average.
BLOCK_CLASSES, BLOCK_SHINGLES = 1024, 1 << 20
_R = mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_A = (_R[:SAMPLES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_B = (_R[SAMPLES:] >> np.uint64(32)).astype(np.uint32)


def min_hashes(shingles: np.ndarray) -> np.ndarray:
    """128 MinHash samples of a set of 64-bit hashes."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(x), 1024):
        np.minimum(out, (x[at : at + 1024, None] * _A + _B).min(0), out=out)
    return out


def band_keys(mins: np.ndarray) -> np.ndarray:
    """A key per band; rows of ``mins`` are documents."""
    cols = mins.reshape(-1, BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), cols.shape[:2])
    for k in range(ROWS):
        key = mix((key ^ cols[:, :, k]) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k))
    return key.view(np.int64)


def odd_sketches(mins: np.ndarray) -> np.ndarray:
    """Parity bitmap of the samples, a row of bytes per document."""
    at = mix((mins.astype(np.uint64) << np.uint64(10)) + np.arange(SAMPLES, dtype=np.uint64)) % np.uint64(ODD_BITS)
    rows = np.arange(len(mins))[:, None] * ODD_BITS
    bits = np.bincount((at.astype(np.int64) + rows).ravel(), minlength=len(mins) * ODD_BITS) & 1
    return np.packbits(bits.astype(np.uint8).reshape(-1, ODD_BITS), axis=1)


def odd_similarity(odd_bits: np.ndarray) -> np.ndarray:
    """Similarity that so many odd bits in the XOR of two sketches suggest."""
    share = np.minimum(2 * np.asarray(odd_bits, float) / ODD_BITS, 1 - 1e-9)
    return np.maximum(0.0, 1 + ODD_BITS / (4 * SAMPLES) * np.log1p(-share))


def odd_limit(percent: int, deviations: float = 6.0) -> int:
    """Odd bits that a pair at the threshold exceeds only beyond so many standard deviations."""
    apart = 1 - percent / 100
    loss = math.exp(-4 * SAMPLES * apart / ODD_BITS)
    mean = ODD_BITS / 2 * (1 - loss)
    samples = SAMPLES * apart * (1 - apart) * (2 * loss) ** 2
    return math.ceil(mean + deviations * math.sqrt(samples + ODD_BITS / 4 * (1 - loss * loss)))


_SIGNED = "doc_id long, text_key long, n_shingles long, set_id binary, bands array<long>, odd binary"


def signatures(docs: DataFrame, words: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document, without its text."""

    def sign(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            sets = [shingle_set(t if isinstance(t, str) else "", words) for t in pdf.pop("text").tolist()]
            mins = np.array([min_hashes(s) for s in sets], np.uint32).reshape(-1, SAMPLES)
            pdf["doc_id"] = pdf["doc_id"].astype("Int64")
            pdf["n_shingles"] = [len(s) for s in sets]
            pdf["set_id"] = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
            pdf["bands"] = list(band_keys(mins))
            pdf["odd"] = [row.tobytes() for row in odd_sketches(mins)]
            yield pdf

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(F.col(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text")
    )
    return rows.mapInPandas(sign, _SIGNED)


def text_key(text: Column) -> Column:
    return F.xxhash64(text.cast("string"))


def salted(facts: DataFrame) -> DataFrame:
    """Facts once for each salt, to be met by rows that are dealt out. They are never broadcast: the planner takes them for as small as they were before
    they were repeated, so some MB of facts would be a gigabyte on the driver."""
    salts = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    return facts.withColumn("salt", F.explode(salts)).hint("merge")


def by_centre(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Join a few facts per centre to its rows. A centre may have a large share of all rows, so these are dealt out by node too."""
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)))
    return dealt.join(salted(facts), ["centre", "salt"]).drop("salt")


def one_text_each(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """One text of each key in ``wanted``. A text may have very many copies: these are dealt out, and one of each part is left before they meet."""
    dealt = texts.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    chosen = dealt.join(salted(wanted.select("text_key").distinct()), ["text_key", "salt"], "left_semi").dropDuplicates(["text_key", "salt"])
    return chosen.drop("salt").dropDuplicates(["text_key"])


class Forest:
    """Union-find over positions, seeded with components that are known."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True


def confirm(
    sets: list[np.ndarray], odd: np.ndarray, known: np.ndarray, asks: np.ndarray, percent: int, limit: int
) -> list[tuple[int, int]]:
    """Links (positions) that connect what ``known`` (a component number each) does not connect yet: a spanning forest of them.

    ``asks`` marks the positions that are compared with all others; a pair needs one such end.
    """
    forest = Forest(len(sets))
    for same in pd.Series(range(len(sets))).groupby(known).indices.values():
        for x in same[1:]:
            forest.join(int(same[0]), int(x))
    size = np.array([len(s) for s in sets])
    flat = unique(np.concatenate(sets))
    ids = np.searchsorted(flat, np.concatenate(sets))
    starts = np.r_[0, np.cumsum(size)[:-1]]
    mark = np.zeros(len(flat), bool)
    bits = odd.view(np.uint64).reshape(len(sets), -1)
    out = []
    for x in np.flatnonzero(asks).tolist():
        near = np.bitwise_count(bits ^ bits[x]).sum(1) <= limit
        near &= (100 * np.minimum(size, size[x]) >= percent * np.maximum(size, size[x])) & ~(asks & (np.arange(len(sets)) <= x))
        near[x] = False
        at = np.flatnonzero(near)
        if not len(at):
            continue
        own = ids[starts[x] : starts[x] + size[x]]
        mark[own] = True
        if len(at) * 8 < len(sets):
            common = np.array([mark[ids[starts[y] : starts[y] + size[y]]].sum() for y in at])
        else:
            common = np.add.reduceat(mark[ids], starts, dtype=np.int64)[at]
        mark[own] = False
        for y in at[100 * common >= percent * (size[at] + size[x] - common)].tolist():
            if forest.join(x, y):
                out.append((x, y))
    return out


def _linked(jobs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Links found in tasks: ``jobs`` has task (a struct), node, text_key, odd, comp, asks; sets come from the texts."""
    limit = odd_limit(percent)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("node").sort_values("node", ignore_index=True)
        if len(pdf) < 2 or not pdf["asks"].any():
            return pd.DataFrame({"a": [], "b": []})
        sets = [shingle_set(t, words) for t in pdf["text"]]
        odd = np.frombuffer(b"".join(pdf["odd"]), np.uint8).reshape(len(pdf), -1)
        known = pd.factorize(pdf["comp"])[0]
        found = confirm(sets, odd, known, pdf["asks"].to_numpy(bool), percent, limit)
        nodes = pdf["node"].tolist()
        return pd.DataFrame({"a": [nodes[x] for x, _ in found], "b": [nodes[y] for _, y in found]})

    rows = jobs.join(texts, "text_key")
    return materialize(rows.groupBy("task").applyInPandas(run, "a binary, b binary"), "links")


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
    block_classes: int = BLOCK_CLASSES, block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """``doc_id``, ``text_key``, ``n_shingles``, ``component_id`` and ``kept`` of every document.

    Documents are linked where ``100 * |intersection| >= percent * |union|`` of their sets of ``words``-word shingles.
    """
    signed = materialize(signatures(docs, words, id_col, text_col), "signatures")
    classes = materialize(
        signed.filter("n_shingles > 0").groupBy(F.col("set_id").alias("node")).agg(
            F.min("doc_id").alias("first_id"), F.min("text_key").alias("text_key"), F.min("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"), F.first("odd").alias("odd"),
        ),
        "classes",
    )
    # Copies of a text have the same key; one of them stands for its class.
    texts = docs.select(text_key(F.col(text_col)).alias("text_key"), F.col(text_col).cast("string").alias("text"))

    banded = classes.select("node", F.explode("bands").alias("band"))
    centres = banded.groupBy("band").agg(F.min("node").alias("centre"), F.count("*").alias("n")).filter("n > 1").drop("n")
    met = materialize(banded.join(centres, "band").select("centre", "node").distinct(), "groups")
    info = classes.select("node", "text_key", "n_shingles", "odd")
    sized = met.join(classes.select("node", "n_shingles"), "node").groupBy("centre").agg(
        F.greatest(
            F.ceil(F.count("*") / block_classes), F.ceil(F.sum("n_shingles") / block_shingles)
        ).alias("n_blocks"), F.count("*").alias("n"),
    ).filter("n > 1")
    members = by_centre(met, sized.drop("n")).withColumn("block", F.pmod(F.xxhash64("node"), "n_blocks"))
    members = materialize(members, "groups")
    needed = members.select("node").distinct().join(info, "node")
    chosen = materialize(one_text_each(texts, needed), "texts")

    # The centre is in every block of its group.
    centre_rows = members.groupBy("centre", "n_blocks").agg(F.lit(1)).select(
        "centre", F.col("centre").alias("node"), F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)).alias("block")
    )
    within = members.select("centre", "node", "block").unionByName(centre_rows.select("centre", "node", "block")).distinct()
    jobs = within.join(info, "node").select(
        F.struct("centre", "block").alias("task"), "node", "text_key", "odd", F.col("node").alias("comp"), F.lit(True).alias("asks")
    )
    links = _linked(jobs, chosen, words, percent)
    roots = components(links)

    split = members.filter("n_blocks > 1")
    if not split.isEmpty():
        placed = split.join(roots, "node", "left").withColumn("comp", F.coalesce("root", "node")).drop("root")
        sizes = placed.groupBy("centre", "comp").agg(F.count("*").alias("n"))
        largest = sizes.groupBy("centre").agg(F.max_by("comp", F.struct("n", "comp")).alias("main"), F.count("*").alias("n_comps"))
        placed = materialize(by_centre(placed, largest.filter("n_comps > 1")), "groups")
        asking = placed.filter("comp <> main")
        ask_blocks = asking.groupBy("centre", "block").agg(F.lit(1)).select("centre", F.col("block").alias("ask_block"))
        every = F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))
        asks = asking.select("centre", "node", "comp", F.col("block").alias("ask_block"), every.alias("block"), F.lit(True).alias("asks"))
        others = by_centre(placed, ask_blocks).select("centre", "node", "comp", "ask_block", "block", F.lit(False).alias("asks"))
        # A class that asks is among the others too; it stays once, as one that asks.
        rows = asks.unionByName(others).groupBy("centre", "ask_block", "block", "node", "comp").agg(F.max("asks").alias("asks"))
        jobs = rows.join(info, "node").select(
            F.struct("centre", "ask_block", "block").alias("task"), "node", "text_key", "odd", "comp", "asks"
        )
        more = _linked(jobs, chosen, words, percent)
        if not more.isEmpty():
            roots = components(links.unionByName(more))

    rooted = classes.select("node", "first_id").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    ids = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_set = rooted.join(ids, "root").select(F.col("node").alias("set_id"), "component_id", F.col("root"))
    out = signed.select("doc_id", "text_key", "n_shingles", "set_id")
    # A set may have a large share of all documents, so these are dealt out by document too; texts without words look nothing up.
    dealt = out.filter("n_shingles > 0").withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    found = dealt.join(salted(of_set), ["set_id", "salt"]).drop("salt")
    nothing = out.filter("n_shingles = 0").withColumns({"component_id": F.lit(None).cast("long"), "root": F.lit(None).cast("binary")})
    out = found.unionByName(nothing)
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "root"
    )


def deduplicated(docs: DataFrame, words: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all columns, one of each group of near copies (the one with the smallest id); texts without words all stay."""
    near = near_duplicates(docs, words, percent, id_col, text_col).filter("n_shingles > 0")
    best = near.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "text_key")).alias("b"))
    chosen = best.select(F.col("b.doc_id").alias("__id"), F.col("b.text_key").alias("__key"))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    has_words = text.rlike(r"[^\x20\x09-\x0D]")
    rows = docs.filter(has_words).withColumn("__text_key", text_key(F.col(text_col)))
    same = rows[id_col].cast("long").eqNullSafe(chosen["__id"]) & (rows["__text_key"] == chosen["__key"])
    kept = rows.join(chosen, same, "left_semi").dropDuplicates(["__text_key", id_col]).drop("__text_key")
    return kept.unionByName(docs.filter(~has_words))
