"""SimHash near-duplicates over a covering code: whatever lies within a Hamming radius meets at an anchor.

A fingerprint has 64 bits, each set where more than half of the text's shingle hashes set it. Fingerprints are linked where at most ``distance`` bits differ.

Anchors are the words of the binary Golay code of length 23. It is perfect: every 23-bit word is within 3 bits of exactly one of its 4,096 words, its
*home*. The 64 bits are three blocks of 22, 21 and 21 bits, each padded to 23. Two linked fingerprints differ by at most ``distance // 3`` bits in one of
the blocks, so there the home of one lies within the covering radius and that threshold of the other. Every fingerprint is therefore
replicated, per block, to all anchors within covering radius plus threshold (5 of 4,096 for a distance of 4), and compared per anchor. Beyond
``WIDE`` different fingerprints an anchor is a pair of words, for two blocks together (all within the radius still meet, at 61 of 16,777,216 anchors for each two
blocks): more rows travel, and far fewer meet. Both ways find the same links.

1. Copies: equal fingerprints are one node from here on, with the smallest id among them.
2. Replicas are dealt out by anchor, sorted, and read as a stream. A crowded anchor is cut into blocks of bounded size.
3. In a block, links are found by walking: a fingerprint that is reached is compared with those not reached yet, so a dense group of near copies costs little
   more than its own size; a spanning forest of the links goes on.
4. Components. Where a crowded anchor's blocks are not all connected yet, each node outside its largest component then meets all its blocks.
5. Components again; each document gets the smallest id that is reachable.

Defined results: NULL and empty texts, and texts without a word, have fingerprint zero, which is linked like any other. Fewer words than a shingle make one shingle.
Repeated rows are copies like others. A NULL id is never the smallest; where a component has no other, its id is NULL. An empty
table gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import materialize
from refloom.operators.graph import components

WORDS, DISTANCE, SEED = 4, 4, 42
#: Generator polynomial, length and radius of the perfect binary Golay code.
GENERATOR, LENGTH, RADIUS = 0b110001110101, 23, 3
#: First bit and number of bits of each block.
BLOCKS = ((0, 22), (22, 21), (43, 21))
#: Different fingerprints from which an anchor is a pair of code words.
WIDE = 1 << 25
#: Fingerprints in a block of a crowded anchor on average.
CROWD = 8192
#: Parts that the rows of one fingerprint are dealt out to when its component is joined to them.
SALTS = 32
#: Shingles whose hashes are counted at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Majority bits of the shingle hashes of a whole text."""
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    n = min(words, len(found))
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found])
    starts = np.r_[0, ends[:-1]].tolist()
    spans = list(zip(starts[: len(found) - n + 1], (ends[n - 1 :] - 1).tolist(), strict=True))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(spans), CHUNK):
        part = spans[at : at + CHUNK]
        hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in part), ">u8", len(part))
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(spans)).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the fingerprint as a signed number) of every document."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        prints = np.array([fingerprint(t if isinstance(t, str) else None, words) for t in texts.tolist()], np.uint64)
        return pd.Series(prints.view(np.int64))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), of(F.col(text_col).cast("string")).alias("fp"))


@cache
def _patterns(radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Differences of at most ``radius`` bits by their remainder: first position per remainder, and the differences and weights in that order.

    A word and a code word are a difference apart that has the same remainder as the word, so these are a word's anchors.
    """
    found, weights = [0], [0]
    for weight in range(1, radius + 1):
        for bits in combinations(range(LENGTH), weight):
            found.append(sum(1 << b for b in bits))
            weights.append(weight)
    found, weights = np.array(found, np.int64), np.array(weights, np.int8)
    remainders = remainder(found)
    order = np.lexsort((weights, remainders))
    firsts = np.searchsorted(remainders[order], np.arange(1 << 11))
    return np.r_[firsts, len(found)], found[order], weights[order]


def remainder(words: np.ndarray) -> np.ndarray:
    """Of a 23-bit word after division by the generator; 0 for a code word."""
    words = words.copy()
    for bit in range(LENGTH - 1, 10, -1):
        words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0)
    return words


def block(prints: np.ndarray, k: int) -> np.ndarray:
    """Bits of one block of the fingerprints."""
    first, bits = BLOCKS[k]
    return (prints >> np.uint64(first)).astype(np.int64) & ((1 << bits) - 1)


def anchors_of(words: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All code words within a radius: position of the word, code word, distance."""
    firsts, differences, weights = _patterns(radius)
    r = remainder(words)
    n = firsts[r + 1] - firsts[r]
    row = np.repeat(np.arange(len(words)), n)
    at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + firsts[r][row]
    return row, words[row] ^ differences[at], weights[at].astype(np.int64)


def replicas(prints: np.ndarray, distance: int, wide: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position of the fingerprint, anchor, and whether that is its home, for all anchors at which it may meet another."""
    if not wide:
        found = [(k, *anchors_of(block(prints, k), RADIUS + distance // 3)) for k in range(3)]
        rows = np.concatenate([r for _, r, _, _ in found])
        keys = np.concatenate([a + (k << LENGTH) for k, _, a, _ in found])
        return rows, keys, np.concatenate([d for *_, d in found]) <= RADIUS
    # Two blocks differ by at most this much together.
    threshold = 2 * distance // 3
    out = []
    for k, (i, j) in enumerate(combinations(range(3), 2)):
        r1, a1, d1 = anchors_of(block(prints, i), RADIUS + threshold)
        r2, a2, d2 = anchors_of(block(prints, j), RADIUS + threshold)
        n1, n2 = np.bincount(r1, minlength=len(prints)), np.bincount(r2, minlength=len(prints))
        left = np.repeat(np.arange(len(r1)), n2[r1])
        first = np.repeat(np.cumsum(n1 * n2) - n1 * n2, n1 * n2)
        within = np.arange(len(left)) - first
        right = (np.cumsum(n2) - n2)[r1[left]] + within % np.repeat(n2, n1 * n2)
        beyond = np.maximum(d1[left] - RADIUS, 0) + np.maximum(d2[right] - RADIUS, 0)
        near = beyond <= threshold
        out.append((r1[left][near], (a1[left] << LENGTH | a2[right])[near] + (k << 2 * LENGTH), (beyond == 0)[near]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def walk(prints: np.ndarray, homes: np.ndarray, distance: int, asks: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Positions of links that connect whatever is linked: a spanning forest. Links need one end in ``homes``, and one in ``asks`` where that is given.

    A position that is reached leaves the open ones and is then compared with those still open.
    """
    out: list[tuple[int, int]] = []
    left = np.flatnonzero(homes if asks is None else asks)[::-1].tolist()
    rest, n_open = np.arange(len(prints)), len(prints)
    is_open = np.ones(len(prints), bool)
    while left:
        start = left.pop()
        if not is_open[start]:
            continue
        is_open[start] = False
        n_open -= 1
        reached = [start]
        while reached:
            x = reached.pop()
            if 2 * n_open < len(rest):
                rest = rest[is_open[rest]]
            near = rest[np.bitwise_count(prints[rest] ^ prints[x]) <= distance]
            near = near[is_open[near]]
            if not homes[x]:
                near = near[homes[near]]
            if asks is not None and not asks[x]:
                near = near[asks[near]]
            is_open[near] = False
            n_open -= len(near)
            reached += near.tolist()
            out += [(x, y) for y in near.tolist()]
    return out


_LINKS = "a long, b long"


def _pairs(prints: np.ndarray, links: list[tuple[int, int]]) -> pd.DataFrame:
    signed = prints.view(np.int64)
    at = np.array(links, np.int64).reshape(-1, 2)
    return pd.DataFrame({"a": signed[at[:, 0]], "b": signed[at[:, 1]]})


def groups_of(frames: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Runs of equal keys of a sorted stream, whatever batches it comes in."""
    held: list[pd.DataFrame] = []
    for pdf in frames:
        if not len(pdf):
            continue
        changed = np.zeros(len(pdf), bool)
        for k in keys:
            values = pdf[k].to_numpy()
            changed[1:] |= values[1:] != values[:-1]
            changed[0] |= bool(held) and held[-1][k].iloc[-1] != values[0]
        cuts = np.flatnonzero(changed)
        for at, end in zip(np.r_[0, cuts], np.r_[cuts, len(pdf)], strict=True):
            if (at or changed[0]) and held:
                yield pd.concat(held)
                held = []
            if end > at:
                held.append(pdf.iloc[at:end])
    if held:
        yield pd.concat(held)


def _linked(rows: DataFrame, keys: list[str], distance: int) -> DataFrame:
    """Links of a spanning forest per task: ``rows`` has the keys, fp, home and asks."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in groups_of(frames, keys):
            homes, asks = pdf["home"].to_numpy(bool), pdf["asks"].to_numpy(bool)
            if len(pdf) > 1 and homes.any() and asks.any():
                prints = pdf["fp"].to_numpy(np.int64).view(np.uint64)
                found = walk(prints, homes, distance, None if asks.all() else asks)
                if found:
                    yield _pairs(prints, found)

    dealt = rows.select(*keys, "fp", "home", "asks").repartition(*keys).sortWithinPartitions(*keys)
    return materialize(dealt.mapInPandas(run, _LINKS), "links")


def dealt_join(rows: DataFrame, facts: DataFrame, key: str, by: str, how: str = "inner") -> DataFrame:
    """Join a few facts per key to its rows. A key may have a large share of all rows, so these are dealt out by another column too."""
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(by), F.lit(SALTS)))
    return salted.join(facts.withColumn("salt", salts), [key, "salt"], how).drop("salt")


def _replicated(nodes: DataFrame, distance: int, wide: bool) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), 2048):
                signed = pdf["fp"].to_numpy(np.int64)[at : at + 2048]
                rows, anchors, homes = replicas(signed.view(np.uint64), distance, wide)
                yield pd.DataFrame({"anchor": anchors, "fp": signed[rows], "home": homes})

    return nodes.select("fp").mapInPandas(run, "anchor long, fp long, home boolean").withColumn("asks", F.lit(True))


def links(nodes: DataFrame, distance: int = DISTANCE, wide: bool = False, crowd: int = CROWD) -> DataFrame:
    """``node`` and ``root`` of all linked fingerprints (column fp, each once) but the roots themselves."""
    placed = _replicated(nodes, distance, wide)
    size = F.ceil(F.col("n") / crowd)
    crowds = placed.groupBy("anchor").agg(F.count("*").alias("n")).filter(F.col("n") > crowd).select("anchor", size.alias("n_blocks"))
    crowds = materialize(crowds, "crowds")
    if crowds.isEmpty():
        return components(_linked(placed, ["anchor"], distance))
    placed = dealt_join(placed, crowds, "anchor", "fp", "left").withColumn("n_blocks", F.coalesce("n_blocks", F.lit(1)))
    placed = materialize(placed.withColumn("block", F.pmod(F.xxhash64("fp"), "n_blocks")), "replicas")
    found = _linked(placed, ["anchor", "block"], distance)
    roots = components(found)

    # Blocks of one anchor have not met each other yet: all outside its largest component meet all of its blocks.
    split = placed.filter("n_blocks > 1").join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    split = split.withColumn("comp", F.coalesce("root", "fp")).select("anchor", "block", "n_blocks", "fp", "home", "comp")
    sizes = split.groupBy("anchor", "comp").agg(F.count("*").alias("n"))
    main = sizes.groupBy("anchor").agg(
        F.max_by("comp", F.struct("n", "comp")).alias("main"), F.ceil((F.sum("n") - F.max("n")) / crowd).alias("ask_blocks")
    )
    split = materialize(dealt_join(split, main.filter("ask_blocks > 0"), "anchor", "fp"), "crowds")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1))
    asking = split.filter("comp <> main").select(
        "anchor", F.pmod(F.xxhash64("fp", F.lit(1)), "ask_blocks").alias("ask_block"), every.alias("block"), "fp", "home", F.lit(True).alias("asks")
    )
    others = split.select(
        "anchor", F.explode(F.sequence(F.lit(0).cast("long"), F.col("ask_blocks") - 1)).alias("ask_block"), "block", "fp", "home",
        F.lit(False).alias("asks"),
    )
    more = _linked(asking.unionByName(others), ["anchor", "ask_block", "block"], distance)
    return roots if more.isEmpty() else components(found.unionByName(more))


def near_duplicates(
    docs: DataFrame, words: int = WORDS, distance: int = DISTANCE, id_col: str = "doc_id", text_col: str = "text",
    wide_from: int = WIDE, crowd: int = CROWD,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex) and ``component_id`` of every document."""
    if not 0 <= distance <= 8:
        raise ValueError("distances up to 8 bits are supported")
    prints = materialize(fingerprints(docs, words, id_col, text_col), "prints")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"))
    nodes = materialize(nodes, "nodes")
    roots = links(nodes, distance, nodes.count() > wide_from, crowd)

    linked = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    linked = linked.withColumn("root", F.coalesce("root", "fp"))
    ids = linked.groupBy("root").agg(F.min("first_id").alias("component_id"), F.sum("n").alias("rows"))
    # A fingerprint that one document has, linked with nothing, needs no look-up.
    known = dealt_join(linked, ids.filter("rows > 1"), "root", "fp").select("fp", "component_id", F.lit(True).alias("found"))
    out = dealt_join(prints, known, "fp", "doc_id", "left")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), component.alias("component_id"))
