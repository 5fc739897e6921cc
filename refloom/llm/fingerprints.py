"""Document fingerprints: bottom-k sketches of word-shingle hashes.

A sketch is the k smallest distinct shingle hashes. Sketches of parts merge into the sketch of the whole, and two sketches
estimate resemblance, containment and the number of distinct shingles. As text, a sketch is its hashes in ascending order,
``DIGITS`` hex digits each; a document with at most k distinct shingles is described exactly.

Defined results: NULL and empty texts, and texts without a word, have the empty sketch (''); two empty sketches are alike (1.0), an empty and a
non-empty one are not (0.0). Fewer words than a shingle holds make one shingle. Repeated rows are kept; rows with the same id are
ordered by their text, a NULL id comes first. An empty table gives an empty result. Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import contained, shingle_hashes, unique, word_hashes

WORDS = 5
KEPT = 64
BITS = 48
DIGITS = BITS // 4
_EMPTY = np.empty(0, np.uint64)


def sketch(text: str | None, words: int = WORDS, kept: int = KEPT) -> np.ndarray:
    """The ``kept`` smallest distinct shingle hashes of a whole text, ascending."""
    hashes = shingle_hashes(word_hashes(text), words) >> np.uint64(64 - BITS)
    # Copies of a shingle may crowd the smallest values, so the cut widens until enough distinct ones are below it.
    width = 4 * kept
    while len(hashes) > width:
        low = unique(np.partition(hashes, width)[:width])
        if len(low) >= kept:
            return low[:kept]
        width *= 4
    return unique(hashes)[:kept]


def merge(sketches: Iterable[np.ndarray], kept: int = KEPT) -> np.ndarray:
    """Sketch of the union of what the sketches describe."""
    out = _EMPTY
    for s in sketches:
        out = unique(np.concatenate([out, s]))[:kept]
    return out


def to_text(s: np.ndarray) -> str:
    return s.astype(">u8").tobytes().hex() if DIGITS == 16 else "".join([f"{x:0{DIGITS}x}" for x in s.tolist()])


def from_text(s: str) -> np.ndarray:
    return np.array([int(s[i : i + DIGITS], 16) for i in range(0, len(s), DIGITS)], np.uint64)


def distinct(s: np.ndarray, kept: int = KEPT) -> float:
    """Estimated number of distinct shingles; exact below ``kept``."""
    return float(len(s)) if len(s) < kept else (kept - 1) * 2.0**BITS / (float(s[-1]) + 1.0)


def resemblance(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Estimated share of common shingles among all of both."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = unique(np.concatenate([a, b]))[:kept]
    return float((contained(union, a) & contained(union, b)).sum()) / len(union)


def containment(a: np.ndarray, b: np.ndarray, kept: int = KEPT) -> float:
    """Estimated share of the shingles of ``a`` that ``b`` has too."""
    if not len(a):
        return 1.0
    common = resemblance(a, b, kept) * distinct(merge([a, b], kept), kept)
    return min(1.0, common / distinct(a, kept))


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = WORDS, kept: int = KEPT, name: str = "fingerprint") -> Column:
    """Column with the sketch of a text column of ``docs``."""

    @F.pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([to_text(sketch(t, words, kept)) for t in texts.tolist()])

    return of(docs[text_col].cast("string")).alias(name)


def merged(df: DataFrame, key: str, fingerprint: str = "fingerprint", kept: int = KEPT, fan_in: int = 1024) -> DataFrame:
    """One sketch per key of a table of sketches, with its estimated distinct count; a key of any size is merged in two steps."""
    kind = dict(df.dtypes)[key]
    schema = f"group_key {kind}, fingerprint string, n_distinct double"

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        s = merge(map(from_text, pdf["fingerprint"]), kept)
        return pd.DataFrame({"group_key": pdf["group_key"].iloc[:1], "fingerprint": [to_text(s)], "n_distinct": [distinct(s, kept)]})

    rows = df.select(F.col(key).alias("group_key"), F.coalesce(F.col(fingerprint), F.lit("")).alias("fingerprint"))
    salt = F.pmod(F.xxhash64("fingerprint"), F.lit(fan_in))
    return rows.groupBy("group_key", salt).applyInPandas(fold, schema).groupBy("group_key").applyInPandas(fold, schema)


def edit(text: str, following: str) -> str:
    """``text`` whose last quarter (in code points, rounded down) gives way to as many first code points of ``following``."""
    quarter = len(text) // 4
    return text[: len(text) - quarter] + following[:quarter]


_OUT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
    "near_next double"
)


def _row(doc_id, text: str, own: np.ndarray, following: str, after: np.ndarray) -> tuple:
    changed = edit(text, following)
    s = sketch(changed)
    sha = hashlib.sha256(changed.encode()).hexdigest()
    return doc_id, len(text), sha, to_text(own), to_text(s), resemblance(own, s), resemblance(own, after)


def _places(docs: DataFrame, parts: int) -> DataFrame:
    """Deal documents out to places in ascending order of (id, text hash), with each place's successor row added to it.

    Places are bounded by quantiles of the id; an id that fills several is spread over them by its texts' hashes. Only the bounds and
    the first row (two numbers) of each place reach the driver.
    """
    spark = docs.sparkSession
    shares = [k / parts for k in range(1, parts)]
    bounds = docs.agg(F.percentile_approx("doc_id", shares, 10_000)).first()[0] if shares else []
    bounds = np.array(bounds or [], np.int64)

    def place(ids: pd.Series, hashes: pd.Series) -> np.ndarray:
        missing = ids.isna().to_numpy()
        keys = ids.fillna(0).to_numpy(np.int64)
        share = (hashes.to_numpy(np.int64).astype(float) + 2.0**63) / 2.0**64 * 0.999999
        left, right = np.searchsorted(bounds, keys, "left"), np.searchsorted(bounds, keys, "right")
        out = left + np.floor(share * np.maximum(1, right - left)).astype(np.int64)
        return np.where(missing, np.floor(share * parts).astype(np.int64) - parts, out)

    @F.pandas_udf("long")
    def own(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(place(ids, hashes))

    at = own("doc_id", "hash")
    firsts = docs.select(at.alias("place"), "doc_id", "hash").groupBy("place").agg(
        F.min(F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "hash")).alias("first")
    )
    rows = sorted((r["place"], r["first"]["doc_id"], r["first"]["hash"]) for r in firsts.collect())
    before = {(i, h): rows[k - 1][0] for k, (_, i, h) in enumerate(rows)}
    shared = spark.sparkContext.broadcast(before)

    @F.pandas_udf("array<long>")
    def targets(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        known, out = shared.value, []
        for i, h, p in zip(ids.astype("Int64"), hashes.tolist(), place(ids, hashes).tolist(), strict=True):
            q = known.get((None if i is pd.NA else int(i), h))
            out.append([2 * p] if q is None else [2 * p, 2 * q + 1])
        return pd.Series(out)

    placed = docs.withColumn("target", F.explode(targets("doc_id", "hash")))
    return placed.withColumn("place", F.floor(F.col("target") / 2))


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document's fingerprint, that of its text edited with the next document's, and how alike these are.

    Documents are dealt out once, in ascending order, and every place also gets the row that follows its last one, so that each row meets the
    next while the place is read; the last document's next is the first.
    """
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in frames:
            out = []
            for doc_id, text, target in zip(pdf["doc_id"].astype("Int64"), pdf["text"].tolist(), pdf["target"].tolist(), strict=True):
                if held is None and target % 2:
                    continue  # a copy of the successor: the place has ended already
                text = text if isinstance(text, str) else ""
                s = sketch(text)
                if held is not None:
                    out.append(_row(*held, text, s))
                held = None if target % 2 else (doc_id, text, s)
            yield pd.DataFrame(out, columns=names).astype({"doc_id": "Int64", "n_chars": "int64"})

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(text_col).cast("string")).alias("hash"),
    )
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    dealt = _places(rows, parts).repartitionByRange(parts, "place").sortWithinPartitions("place", "target", "doc_id", "hash")
    return dealt.select("doc_id", "text", "target").mapInPandas(walk, _OUT)
