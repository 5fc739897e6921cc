"""Best-fit packing of documents into sequences: hierarchical residual packing.

Pieces are dealt out by size, so that every group has the same mix of long and short ones from all partitions, however the input is sorted.
Groups pack best-fit, emit the bins that are nearly full, and hand the underfull ones on, dealt by size again, in a tree: an underfull bin
of at most half a sequence travels as one item; a fuller one, into which hardly anything would fit as a whole, travels opened, so that its
pieces can find better partners. Only numbers travel, never tokens.

Where more is left than the tree's next groups may hold, no bin is opened in that round. Best fit then leaves one bin of at most half a sequence
a group at most; fuller ones never fit each other, so of these only as many can meet a partner as there are such small ones, and it may
as well be the least full. They go on, the rest is emitted, which costs no sequence. No task grows with the input, and the root closes everything.

Defined results: NULL and empty texts are one piece of length 1 (the separator). Repeated rows are packed as often as they
occur. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import BLOCK, materialize

SEQUENCE = 2048
SEPARATOR = 0
#: A bin with at most this many free places is emitted at once.
SLACK = 8
#: Pieces of a group at first, and later at most (or four sequences of single tokens, if that is more).
GROUP, CARRY = 4_096, 100_000
FAN_IN = 8

#: Distinct words whose ids a Python worker remembers.
REMEMBERED = 400_000
#: Texts with other characters than these (or with the tokenizer's special strings) go to the tokenizer itself.
_OTHER = re.compile(r"[^\x01-\x1b\x20-\x84\x86-\u02ff\u2010-\u2027\u20ac]|[\xb2\xb3\xb9\xbc-\xbe\u0130]|<\|(?:start|end)oftext\|>")
#: The tokenizer's pre-tokens, as they are among the characters of the fast path.
_PRE_TOKEN = re.compile(r"'(?:[stmd]|re|ve|ll)|[^\W\d_]+|\d|(?:[^\s\w]|_)+")
_SPACE = re.compile(r"[ \n]")
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f", "\x85")
_TOKENIZERS: dict[str, "WordTokenizer"] = {}


class WordTokenizer:
    """Ids of a word-end BPE vocabulary file, as little-endian 32-bit bytes.

    White space separates pre-tokens, so the ids of a word do not depend on its neighbours: they are remembered by word, and new
    words are encoded together. A pre-token's end is the byte 0 here, which the fast path therefore excludes from texts.
    """

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        suffix = spec["model"]["end_of_word_suffix"]
        special = {t["id"] for t in spec["added_tokens"]}
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        byte_of = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
        ranks, ends = {}, np.zeros(len(spec["model"]["vocab"]) + len(special), bool)
        for token, i in spec["model"]["vocab"].items():
            if i in special:
                continue
            end = token.endswith(suffix) and token != suffix
            body = bytes(byte_of[c] for c in (token[: -len(suffix)] if end else token))
            if end and 0 in body or not end and 0 in body and body != b"\0":
                continue
            ranks[body + b"\0" * end] = i
            ends[i] = end
        self.ends = ends
        self.fast = tiktoken.Encoding("words", pat_str=r"[^\x00 ]+\x00", mergeable_ranks=ranks, special_tokens={})
        self.known: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        parts, at = [], 0
        if any(c in text for c in _SEPARATORS):
            return self._slow(text)
        while at < len(text):
            end = len(text)
            if at + BLOCK < end:
                cut = _SPACE.search(text, at + BLOCK)
                end = cut.end() if cut else end
            words = text[at:end].split()
            try:
                parts.append(b"".join([self.known[w] for w in words]))
            except KeyError:
                if not self._learn(words):
                    return self._slow(text)
                parts.append(b"".join([self.known[w] for w in words]))
            at = end
        return b"".join(parts)

    def _slow(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _learn(self, words: list[str]) -> bool:
        """Encode the new words together; False if one has characters that the fast path leaves out."""
        new = list(set(words).difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known = {}
            new = list(set(words))
        line = " ".join(new)
        if _OTHER.search(line):
            return False
        line = _PRE_TOKEN.sub("\\g<0>\0", line.lower())
        ids = np.array(self.fast.encode_ordinary(line), "<u4")
        stops = np.flatnonzero(self.ends[ids]) + 1
        last = np.cumsum([w.count("\0") for w in line.split(" ")])
        if len(stops) != last[-1]:
            raise ValueError("the vocabulary has no word end for a pre-token")
        data, start = ids.tobytes(), 0
        for w, stop in zip(new, np.r_[0, stops][last].tolist(), strict=True):
            self.known[w] = data[start : stop * 4]
            start = stop * 4
        return True


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each item, best fit; items come in descending size.

    ``free[r]`` has the open bins with r free places; a bit mask finds the tightest one that fits in one step.
    """
    out = np.empty(len(sizes), np.int64)
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0
    for k, size in enumerate(sizes.tolist()):
        fits = mask >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            number = free[room].pop()
            if not free[room]:
                mask &= ~(1 << room)
        else:
            number, room, bins = bins, capacity, bins + 1
        out[k] = number
        left = room - size
        if left:
            free[left].append(number)
            mask |= 1 << left
    return out


_NODE = (
    "item long, place long, fill long, open boolean, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)
_COLUMNS = [c.split()[0] for c in _NODE.split(", ")]


def by_size(items: np.ndarray, length: np.ndarray, node: int) -> np.ndarray:
    """Place of each piece's item among the node's items, largest first, from a start that differs by node."""
    known, of = np.unique(items, return_inverse=True)
    place = np.empty(len(known), np.int64)
    place[np.argsort(-np.bincount(of, length, len(known)), kind="stable")] = np.arange(len(known))
    return place[of] + (node * 2_654_435_761 >> 7) % 65_521


def pack_node(pieces: pd.DataFrame, node: int, level: int, capacity: int, slack: int, whole: bool, last: bool) -> pd.DataFrame:
    """One round over a node's pieces: pieces of the same ``item`` stay together. What is ``open`` is handed on; with ``whole``, as it is."""
    pieces = pieces.sort_values(["item", "length", "doc_id", "piece", "ids_crc32"], ascending=[True, False, True, True, True])
    items, of = np.unique(pieces["item"].to_numpy(), return_inverse=True)
    size = np.bincount(of, pieces["length"].to_numpy(), len(items)).astype(np.int64)
    order = np.argsort(-size, kind="stable")
    bins = np.empty(len(items), np.int64)
    bins[order] = best_fit(size[order], capacity)
    fill = np.bincount(bins, size).astype(np.int64)
    pieces = pieces.assign(bin=bins[of]).sort_values(["bin", "item"], kind="stable").reset_index(drop=True)
    length, number = pieces["length"].to_numpy(), pieces["bin"].to_numpy()
    before = np.cumsum(length) - length
    first = np.r_[True, number[1:] != number[:-1]]
    pieces["sequence_id"] = (level << 57 | node << 32) + number
    pieces["offset"] = before - np.maximum.accumulate(np.where(first, before, 0))
    pieces["fill"] = fill[number]
    pieces["open"] = not last and pieces["fill"] < capacity - slack
    # Handed on: small bins whole, fuller ones opened. Items of a node get numbers of their own.
    row = np.arange(len(pieces))
    lead = np.zeros(len(fill), np.int64)
    lead[number[first]] = row[first]
    pieces["item"] = (node << 32) + np.where(whole | (fill[number] * 2 <= capacity), lead[number], row)
    pieces["place"] = 0
    handed = pieces["open"].to_numpy()
    pieces.loc[handed, "place"] = by_size(pieces["item"].to_numpy()[handed], length[handed], node)
    return pieces[_COLUMNS]


def partners(left: DataFrame, capacity: int) -> tuple[DataFrame, DataFrame]:
    """Pieces of whole bins that may still meet another, and the rest: bins over half of which there are more than small ones."""
    bins = left.groupBy("item").agg(F.first("fill").alias("fill"))
    small = F.col("fill") * 2 <= capacity
    fuller = bins.filter(~small).orderBy("fill", "item").limit(bins.filter(small).count())
    keep = materialize(bins.filter(small).unionByName(fuller).select("item"), "pack")
    return left.join(keep, "item", "left_semi"), left.join(keep, "item", "left_anti")


def cut(data: bytes, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc) of a document's ids, given as bytes."""
    step = capacity * 4
    for piece, at in enumerate(range(0, len(data), step)):
        part = data[at : at + step]
        yield piece, at // 4, len(part) // 4, zlib.crc32(part)


def pack(
    docs: DataFrame, vocabulary: str, capacity: int = SEQUENCE, slack: int = SLACK, carry: int = CARRY, fan_in: int = FAN_IN,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Place every document of ``docs`` in sequences of at most ``capacity`` tokens; one row per piece.

    ``vocabulary`` is the path of the tokenizer file on the executors. Every document ends with the separator id; only those longer
    than a sequence are cut.
    """

    def local(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = tokenizer(vocabulary).encode
        end = np.array([SEPARATOR], "<u4").tobytes()
        got: list[np.ndarray] = []
        ids: list = []
        for pdf in frames:
            for doc_id, text in zip(pdf["doc_id"].tolist(), pdf["text"].tolist(), strict=True):
                rows = list(cut((encode(text) if isinstance(text, str) and text else b"") + end, capacity))
                got.append(np.array(rows, np.int64))
                ids += [doc_id] * len(rows)
        if not got:
            return
        table = np.concatenate(got)
        node = TaskContext.get().partitionId()
        pieces = pd.DataFrame(table, columns=["piece", "start", "length", "ids_crc32"])
        pieces["doc_id"] = pd.array([None if pd.isna(i) else int(i) for i in ids], "Int64")
        pieces["sequence_id"] = pieces["item"] = (node << 32) + np.arange(len(pieces))
        pieces["offset"], pieces["fill"] = 0, pieces["length"]
        pieces["open"] = pieces["length"] < capacity - slack
        pieces["place"] = by_size(pieces["item"].to_numpy(), pieces["length"].to_numpy(), node)
        yield pieces[_COLUMNS]

    def packing(level: int, groups: int, whole: bool):
        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf["doc_id"] = pdf["doc_id"].astype("Int64")
            return pack_node(pdf, int(pdf["place"].iloc[0]) % groups, level, capacity, slack, whole, groups == 1)

        return run

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    step = materialize(source.mapInPandas(local, _NODE), "pack")
    done, left = [step.filter(~F.col("open"))], step.filter("open")
    limit = max(carry, 4 * capacity)
    n, level, whole = left.count(), 0, False
    groups = -(-n // min(GROUP, limit))
    while n:
        level += 1
        run = packing(level, groups, whole)
        step = materialize(left.groupBy(F.col("place") % groups).applyInPandas(run, _NODE), "pack")
        done.append(step.filter(~F.col("open")))
        if groups == 1:
            break
        left = step.filter("open")
        if whole:
            left, rest = partners(left, capacity)
            done.append(rest)
        n = left.count()
        planned, need = -(-groups // fan_in), -(-n // limit)
        groups, whole = max(planned, need), need > planned
    out = done[0].select(_COLUMNS)
    for df in done[1:]:
        out = out.unionByName(df.select(_COLUMNS))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
