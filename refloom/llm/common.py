"""Shared pieces: hold-out rule, word and shingle hashes over whole texts, tree merging of small states."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.session import materialize

#: The white space that ends a word.
SPACE = rb"[\x20\x09-\x0D]"
_SPACE = re.compile(SPACE)
#: Bytes of a text that are taken apart at once; only a matter of memory.
BLOCK = 1 << 20
#: Distinct words whose hashes a Python worker remembers.
REMEMBERED = 250_000

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


class WordHashes(dict):
    """64-bit hash of a word (bytes), remembered for a bounded number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def blocks(data: bytes, size: int = BLOCK) -> Iterator[bytes]:
    """Pieces of about ``size`` bytes, cut only at white space."""
    at = 0
    while at < len(data):
        found = _SPACE.search(data, at + size) if at + size < len(data) else None
        end = found.end() if found else len(data)
        yield data[at:end]
        at = end


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of all words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z lower-cased; empty for NULL."""
    if not text:
        return np.empty(0, np.uint64)
    parts = []
    for block in blocks(text.encode().lower()):
        words = block.split()
        parts.append(np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words)))
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words, in order; a shorter sequence is one shingle, an empty one none."""
    n = min(size, len(words))
    if not n:
        return np.empty(0, np.uint64)
    rows = len(words) - n + 1
    out = np.full(rows, n, np.uint64)
    for k in range(n):
        out = out * _M1 + words[k : k + rows]
    return mix(out)


def unique(values: np.ndarray) -> np.ndarray:
    """Distinct values, ascending, by sorting."""
    if len(values) < 2:
        return values
    values = np.sort(values)
    return values[np.r_[True, values[1:] != values[:-1]]]


def contained(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Whether each value is among ``known``, which is ascending."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Distinct shingle hashes of a whole text, ascending."""
    return unique(shingle_hashes(word_hashes(text), size))


def tree_reduce(
    df: DataFrame, parts: int, combine: Callable[[Iterator[bytes]], bytes], fan_in: int = 32
) -> bytes | None:
    """Combine one fixed-size ``state`` (binary) per row, with a ``part`` number, in a tree; only the root reaches the driver.

    ``parts`` is more than the largest part number. Each group holds ``fan_in`` states at most, however many parts there are.
    """
    schema = "part long, state binary"

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0]) // fan_in
        return pd.DataFrame({"part": [part], "state": [combine(iter(pdf.sort_values("part")["state"]))]})

    while parts > fan_in:
        df = df.groupBy(F.floor(F.col("part") / fan_in)).applyInPandas(fold, schema)
        parts = -(-parts // fan_in)
    rows = df.orderBy("part").collect()
    return combine(bytes(r["state"]) for r in rows) if rows else None


__all__ = [
    "BLOCK", "SPACE", "blocks", "contained", "materialize", "mix", "remainder", "shingle_hashes", "shingle_set", "tree_reduce",
    "unique", "word_hashes",
]
