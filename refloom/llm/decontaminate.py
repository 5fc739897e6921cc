"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact weighted-shingle similarity.

Benchmark items and documents become sequences of word hashes (lower case, letters and digits only) and 5-word shingles.
For every item size, the windows of that size are fingerprinted with a 256-bit SimHash of their shingles, weighted by how often they
occur. Fingerprints are cut into 64 blocks of 4 bits: two of at most 63 different bits agree in a block, so the blocks find all
fingerprints within that radius; at a similarity of 0.8 the distance is 39 bits on average with a deviation of 6.
What is found is confirmed by the exact weighted similarity, sum of the smaller counts over sum of the larger ones, and the best window of each
document and item is reported.

Windows that cannot reach the similarity are never fingerprinted: those with too few shingles of any item, and those that
start with a shingle of no item, since moving on by one word then loses nothing.

Items come in parts of ``PART`` items, one pass over the documents each, so what a task holds has a bound and any number of items works.

Defined results: NULL and empty texts, and texts without letters or digits, match nothing, and so do such items. An item of fewer than five words is
one shingle and matches only a document that is the same sequence as a whole. A document shorter than an item is one window. Repeated
rows are reported each; repeated items too, and ids that are NULL like any other. Of equally similar windows the first is reported. Empty
tables give an empty result. Extra columns, whatever their names, are ignored by ``leaks`` and kept by ``clean``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import BLOCK, contained, materialize, mix, shingle_hashes, unique

WORDS = 5
PERCENT = 80
BITS, BLOCKS = 256, 64
RADIUS = BLOCKS - 1
#: Items that one pass over the documents looks for.
PART = 50_000
#: Words whose hashes a Python worker remembers.
REMEMBERED = 250_000
#: Shingles of a document that are fingerprinted at once.
STRETCH = 1 << 15

MATCHES = "array<struct<item_id:long,similarity:double,start:int,end:int,n_words:int>>"


def _clean(word: str) -> str:
    return word.lower() if word.isalnum() else "".join(filter(str.isalnum, word.lower()))


class CleanHashes(dict):
    """Hash of a word without case and punctuation; 0 if nothing is left."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        clean = _clean(word)
        value = self[word] = (xxhash.xxh3_64_intdigest(clean) or 1) if clean else 0
        return value


_HASHES = CleanHashes()
_GAP = re.compile(r"\s")
_RUN = re.compile(r"\S+")


def clean_words(text: str | None) -> np.ndarray:
    """Hashes of the words of a whole text, in order."""
    if not text:
        return np.empty(0, np.uint64)
    parts, at = [], 0
    while at < len(text):
        gap = _GAP.search(text, at + BLOCK) if at + BLOCK < len(text) else None
        end = gap.end() if gap else len(text)
        words = text[at:end].split()
        parts.append(np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words)))
        at = end
    out = np.concatenate(parts)
    return out[out != 0]


def word_places(text: str, first: int, count: int) -> tuple[int, int]:
    """Code points from which to which ``count`` kept words stand, from word ``first`` on."""
    start, seen = 0, 0
    for m in _RUN.finditer(text):
        for piece in m[0].split():
            if _HASHES[piece]:
                if seen == first:
                    start = m.start()
                seen += 1
                if seen == first + count:
                    return start, m.end()
    return start, len(text)


def shingle_bits(shingles: np.ndarray) -> np.ndarray:
    """256 signs (+1 or -1) per shingle."""
    seeds = np.arange(1, BITS // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    wide = mix(shingles[:, None] ^ seeds)
    return np.unpackbits(wide.view(np.uint8), axis=1).astype(np.int8) * np.int8(2) - np.int8(1)


def simhash(totals: np.ndarray) -> np.ndarray:
    """Fingerprints, as bytes, from sums of signs."""
    return np.packbits(totals > 0, axis=-1)


def nibbles(prints: np.ndarray) -> np.ndarray:
    return np.stack([prints >> 4, prints & 15], axis=-1).reshape(*prints.shape[:-1], BLOCKS)


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of smaller counts over sum of larger counts of two shingle sequences."""
    if not len(a) or not len(b):
        return 0.0
    both = np.concatenate([a, b])
    keys = unique(both)
    of = np.searchsorted(keys, both)
    x, y = np.bincount(of[: len(a)], minlength=len(keys)), np.bincount(of[len(a) :], minlength=len(keys))
    return float(np.minimum(x, y).sum() / np.maximum(x, y).sum())


@dataclass
class SizeIndex:
    """Items of one number of shingles: per block and value, a bit set of the items with that value."""

    rows: np.ndarray  # positions of the items
    prints: np.ndarray
    table: np.ndarray  # [block, value, bytes of the bit set]

    @staticmethod
    def of(rows: np.ndarray, prints: np.ndarray) -> SizeIndex:
        value = nibbles(prints)
        table = np.stack([np.packbits(value.T == v, axis=1) for v in range(16)], axis=1)
        return SizeIndex(rows, prints, table)

    def near(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Windows, by number, and positions of all items within the radius of their fingerprints."""
        at, items = [], []
        for start in range(0, len(windows), 256):
            part = windows[start : start + 256]
            found = np.bitwise_or.reduce(self.table[np.arange(BLOCKS), nibbles(part)], axis=1)
            w, k = np.nonzero(np.unpackbits(found, axis=1, count=len(self.rows)))
            close = np.bitwise_count(self.prints[k] ^ part[w]).sum(1) <= RADIUS
            at.append(w[close] + start)
            items.append(self.rows[k[close]])
        return np.concatenate(at), np.concatenate(items)


class Index:
    """Items of one part, ready for any number of documents."""

    def __init__(self, items: list[tuple[int, str | None]], words: int = WORDS, percent: int = PERCENT):
        self.words, self.percent = words, percent
        sequences = [(i, clean_words(t)) for i, t in items]
        self.short: dict[bytes, list[int]] = {}
        self.ids, self.shingles, self.lengths = [], [], []
        for i, s in sequences:
            if 0 < len(s) < words:
                self.short.setdefault(s.tobytes(), []).append(i)
            elif len(s):
                self.ids.append(i)
                self.lengths.append(len(s))
                self.shingles.append(shingle_hashes(s, words))
        self.known = unique(np.concatenate(self.shingles)) if self.shingles else np.empty(0, np.uint64)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[self.known >> np.uint64(44)] = True
        prints = np.array([simhash(shingle_bits(s).sum(0, dtype=np.int32)) for s in self.shingles])
        count = np.array([len(s) for s in self.shingles])
        self.sizes = {int(n): SizeIndex.of(np.flatnonzero(count == n), prints[count == n]) for n in np.unique(count)}

    def least(self, n: int) -> int:
        return -(-self.percent * n // 100)

    def matches(self, text: str | None) -> list[dict]:
        """The best window of each item that a text has, with its place in code points."""
        words = clean_words(text)
        if len(words) < self.words:
            same = self.short.get(words.tobytes(), []) if len(words) else []
            return [self._row(text, i, 1.0, 0, len(words)) for i in same]
        shingles = shingle_hashes(words, self.words)
        hit = self.filter[shingles >> np.uint64(44)]
        at = np.flatnonzero(hit)
        if not len(at):
            return []
        hit[at] = contained(shingles[at], self.known)
        best: dict[int, tuple[float, int, int]] = {}
        longest = max(self.sizes)
        for start in range(0, len(shingles), STRETCH):
            own = hit[start : start + STRETCH + longest]
            if own.any():
                self._stretch(shingles[start : start + STRETCH + longest], own, start, len(shingles), best)
        return [
            self._row(text, self.ids[k], sim, first, count + self.words - 1) for k, (sim, first, count) in sorted(best.items())
        ]

    def _stretch(self, shingles: np.ndarray, hit: np.ndarray, start: int, total: int, best: dict) -> None:
        sums, signs = np.r_[0, np.cumsum(hit)], None
        for n, index in self.sizes.items():
            if n > total:
                if start or total < self.least(n) or sums[total] < self.least(n):
                    continue
                places, n = np.array([0]), total
            else:
                # Windows that start in this stretch; the text's last window may start with any shingle.
                last = min(len(hit) - n, STRETCH - 1)
                if last < 0:
                    continue
                enough = sums[n : n + last + 1] - sums[: last + 1] >= self.least(n)
                enough &= hit[: last + 1] | (np.arange(start, start + last + 1) == total - n)
                places = np.flatnonzero(enough)
            if not len(places):
                continue
            if signs is None:
                signs = np.zeros((len(shingles) + 1, BITS), np.int32)
                np.cumsum(shingle_bits(shingles), axis=0, out=signs[1:])
            prints = simhash(signs[places + n] - signs[places])
            for w, k in zip(*index.near(prints), strict=True):
                place = int(places[w])
                sim = weighted_similarity(shingles[place : place + n], self.shingles[k])
                if 100 * sim >= self.percent - 1e-9 and sim > best.get(int(k), (0.0,))[0]:
                    best[int(k)] = sim, start + place, n

    def _row(self, text: str, item: int, sim: float, first: int, count: int) -> dict:
        start, end = word_places(text, first, count)
        return {"item_id": item, "similarity": sim, "start": start, "end": end, "n_words": count}


def _finders(
    benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT, part: int = PART
) -> Iterator[Callable[[Column], Column]]:
    """A column function per part of the items, in order. The driver sends one part on before it reads the next."""
    sc = benchmark.sparkSession.sparkContext
    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).orderBy(id_col, text_col)
    held: list[tuple[int, str | None]] = []
    sent = 0
    for row in rows.toLocalIterator():
        if len(held) >= part:
            yield _finder(sc.broadcast(held), words, percent)
            held, sent = [], sent + 1
        held.append(tuple(row))
    if held or not sent:
        yield _finder(sc.broadcast(held), words, percent)


_INDEXES: dict = {}


def _finder(shared, words: int, percent: int) -> Callable[[Column], Column]:
    """Column function: the items of a part that a text has, an array of item, similarity, place and number of words."""

    @F.pandas_udf(MATCHES)
    def find(texts: pd.Series) -> pd.Series:
        key = id(shared), words, percent
        if key not in _INDEXES:
            _INDEXES.clear()
            _INDEXES[key] = shared, Index(shared.value, words, percent)
        index = _INDEXES[key][1]
        return pd.Series([index.matches(t if isinstance(t, str) else None) for t in texts.tolist()])

    return find


def leaks(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
    **options,
) -> DataFrame:
    """One row per document and item that it contains, with similarity and place; one pass over the documents per part of the items."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    finders = _finders(benchmark, item_id_col, item_text_col, **options)
    found = [rows.select("doc_id", F.explode(find(F.col("text"))).alias("m")).select("doc_id", "m.*") for find in finders]
    return reduce(DataFrame.unionByName, found)


def clean(
    docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text", **options
) -> DataFrame:
    """The documents without a benchmark item, with all their columns. Each further part of the items looks at what the last one left, as a table."""
    for k, find in enumerate(_finders(benchmark, item_id_col, item_text_col, **options)):
        docs = (materialize(docs, "clean") if k else docs)
        docs = docs.filter(F.size(find(F.col(text_col).cast("string"))) == 0)
    return docs
