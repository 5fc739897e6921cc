"""Token counts that follow edits: a segment tree of pre-tokens per document.

A document's tree has its pre-tokens in leaves of about ``LEAF`` (their lengths and numbers of tokens), and above them a binary tree with the
characters and tokens of each subtree. Byte-pair merges never cross a pre-token, so the root has the document's token count. An edit
is located by descending the tree; pre-tokens are split anew from just before it (the splitting pattern looks ``LOOK`` characters ahead)
until a boundary falls on an old one behind the edit. Only these are encoded; their leaves change, and the sums on their paths.

Trees are binary values that are kept with the documents and loaded again for later edits.

Defined results: a NULL text is an empty one, with no tokens; NULL or no edits leave a document as it is. An edit's place is clipped to the text, in
the characters of the text as the edits before it left it. Repeated rows are kept. An empty table gives an empty result.
Extra columns, whatever their names, are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAF = 64
LOOK = 3
#: Distinct pre-tokens whose counts a Python worker remembers.
REMEMBERED = 250_000
Edit = tuple[int, int, str]
EDITS = "array<struct<start:int,delete:int,insert:string>>"


class Counter(dict):
    """Tokens of a pre-token, remembered for a bounded number of them."""

    def __init__(self, path: str, pattern: str):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(pattern)
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def __missing__(self, piece: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        n = self[piece] = len(self.encoding.encode_ordinary(piece))
        return n

    def whole(self, text: str) -> int:
        return len(self.encoding.encode_ordinary(text))


class Tree:
    """Pre-tokens of one document: ``leaves`` (lengths and counts), and heap-ordered sums, the root at 1."""

    def __init__(self, lengths: list[np.ndarray], counts: list[np.ndarray], chars: np.ndarray, tokens: np.ndarray):
        self.lengths, self.counts, self.chars, self.tokens = lengths, counts, chars, tokens

    @staticmethod
    def over(lengths: np.ndarray, counts: np.ndarray) -> Tree:
        n = max(1, -(-len(lengths) // LEAF))
        places = 1 << (n - 1).bit_length()
        chars, tokens = np.zeros(2 * places, np.int64), np.zeros(2 * places, np.int64)
        if len(lengths):
            starts = np.arange(0, len(lengths), LEAF)
            chars[places : places + n] = np.add.reduceat(lengths, starts)
            tokens[places : places + n] = np.add.reduceat(counts, starts)
        at = places
        while at > 1:
            for sums in (chars, tokens):
                sums[at // 2 : at] = sums[at : 2 * at].reshape(-1, 2).sum(1)
            at //= 2
        cut = range(LEAF, len(lengths), LEAF)
        return Tree(np.split(lengths, cut), np.split(counts, cut), chars, tokens)

    @staticmethod
    def of(text: str, counter: Counter) -> Tree:
        pieces = counter.pattern.findall(text)
        n = len(pieces)
        return Tree.over(np.fromiter(map(len, pieces), np.int64, n), np.fromiter(map(counter.__getitem__, pieces), np.int64, n))

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    @property
    def n_pieces(self) -> int:
        return sum(map(len, self.lengths))

    def locate(self, place: int) -> tuple[int, int]:
        """Leaf that has a character, and the characters before that leaf."""
        at, before, leaves = 1, 0, len(self.chars) // 2
        while at < leaves:
            at *= 2
            if place >= before + self.chars[at] and self.chars[at + 1]:
                before += int(self.chars[at])
                at += 1
        return min(at - leaves, len(self.lengths) - 1), before

    def put(self, leaf: int, lengths: np.ndarray, counts: np.ndarray) -> None:
        """Replace a leaf and update the sums on its path."""
        self.lengths[leaf], self.counts[leaf] = lengths, counts
        at = leaf + len(self.chars) // 2
        chars, tokens = int(lengths.sum()) - int(self.chars[at]), int(counts.sum()) - int(self.tokens[at])
        while at:
            self.chars[at] += chars
            self.tokens[at] += tokens
            at //= 2

    def edit(self, text: str, change: Edit, counter: Counter) -> tuple[str, int]:
        """The text after an edit, and how many pre-tokens were encoded for it; the tree follows."""
        start = min(max(0, change[0] or 0), len(text))
        delete = min(max(0, change[1] or 0), len(text) - start)
        insert = change[2] or ""
        after = text[:start] + insert + text[start + delete :]
        leaf, before = self.locate(max(0, start - LOOK))
        ends = before + np.cumsum(self.lengths[leaf])
        skip = int(np.searchsorted(ends, max(0, start - LOOK), "right")) if start > LOOK else 0
        skip = min(skip, len(ends))
        begin = int(ends[skip - 1]) if skip else before
        # Old boundaries behind the edit, leaf by leaf, until a new one falls on them.
        shift, edge = len(insert) - delete, start + len(insert)
        last, old = leaf, np.r_[begin, ends[skip:]]
        new_lengths, new_counts, at, kept = [], [], begin, None
        for m in counter.pattern.finditer(after, begin):
            if at >= edge:
                while old[-1] < at - shift and last + 1 < len(self.lengths):
                    last += 1
                    old = np.r_[old, old[-1] + np.cumsum(self.lengths[last])]
                k = int(np.searchsorted(old, at - shift))
                if k < len(old) and old[k] == at - shift:
                    kept = k
                    break
            new_lengths.append(m.end() - m.start())
            new_counts.append(counter[m[0]])
            at = m.end()
        span = range(leaf, (last if kept is not None else len(self.lengths) - 1) + 1)
        lengths, counts = np.array(new_lengths, np.int64), np.array(new_counts, np.int64)
        head = self.lengths[leaf][:skip], self.counts[leaf][:skip]
        tail_l = np.concatenate([self.lengths[x] for x in span])[skip:]
        tail_c = np.concatenate([self.counts[x] for x in span])[skip:]
        tail = (tail_l[kept:], tail_c[kept:]) if kept is not None else (tail_l[:0], tail_c[:0])
        for x in span[1:]:
            self.put(x, lengths[:0], counts[:0])
        self.put(leaf, np.concatenate([head[0], lengths, tail[0]]), np.concatenate([head[1], counts, tail[1]]))
        if len(self.lengths[leaf]) > 16 * LEAF:  # deal the pre-tokens out to leaves again; nothing is encoded for it
            self.__dict__ = Tree.over(np.concatenate(self.lengths), np.concatenate(self.counts)).__dict__
        return after, len(new_lengths)

    def to_bytes(self) -> bytes:
        """Leaf sizes, lengths, counts and sums, each in as few bytes as it needs."""
        parts = [np.array(list(map(len, self.lengths))), np.concatenate(self.lengths), np.concatenate(self.counts), self.chars, self.tokens]
        out = []
        for p in parts:
            kind = next(k for k in (1, 2, 4, 8) if not len(p) or int(p.max()) < 1 << (8 * k))
            out.append(np.array([kind, len(p)], "<i8").tobytes() + p.astype(f"<u{kind}").tobytes())
        return b"".join(out)

    @staticmethod
    def from_bytes(data: bytes) -> Tree:
        parts, at = [], 0
        for _ in range(5):
            kind, n = np.frombuffer(data, "<i8", 2, at).tolist()
            parts.append(np.frombuffer(data, f"<u{kind}", n, at + 16).astype(np.int64))
            at += 16 + kind * n
        cut = np.cumsum(parts[0])[:-1]
        return Tree(np.split(parts[1], cut), np.split(parts[2], cut), parts[3], parts[4])


_COUNTERS: dict = {}


def counter(path: str, pattern: str) -> Counter:
    if (path, pattern) not in _COUNTERS:
        _COUNTERS[path, pattern] = Counter(path, pattern)
    return _COUNTERS[path, pattern]


def build_trees(docs: DataFrame, path: str, pattern: str, text_col: str = "text") -> Column:
    """Column with the tree of a text column; ``path`` is the vocabulary file on the executors."""

    @F.pandas_udf("binary")
    def build(texts: pd.Series) -> pd.Series:
        c = counter(path, pattern)
        return pd.Series([Tree.of(t if isinstance(t, str) else "", c).to_bytes() for t in texts.tolist()])

    return build(docs[text_col].cast("string"))


_EDITED = "text string, tree binary, n_chars long, n_tokens long, n_pieces long, old_tokens long, old_pieces long, encoded long"


def apply_edits(text: Column, tree: Column, edits: Column, path: str, pattern: str, counts_only: bool = False) -> Column:
    """Column with the text, tree and counts after the edits, the counts before, and how many pre-tokens were encoded.

    With ``counts_only`` text and tree are NULL, and nothing large goes back.
    """

    @F.pandas_udf(_EDITED)
    def edited(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        c = counter(path, pattern)
        for texts, trees, changes in batches:
            rows = []
            for t, data, todo in zip(texts.tolist(), trees.tolist(), changes.tolist(), strict=True):
                t = t if isinstance(t, str) else ""
                tree, encoded = Tree.from_bytes(data), 0
                old = tree.n_tokens, tree.n_pieces
                for e in todo if todo is not None else ():
                    t, n = tree.edit(t, (e["start"], e["delete"], e["insert"]), c)
                    encoded += n
                kept = (None, None) if counts_only else (t, tree.to_bytes())
                rows.append((*kept, len(t), tree.n_tokens, tree.n_pieces, *old, encoded))
            yield pd.DataFrame(rows, columns=["text", "tree", "n_chars", "n_tokens", "n_pieces", "old_tokens", "old_pieces", "encoded"])

    return edited(text.cast("string"), tree, edits)


def edited_counts(docs: DataFrame, edits: Column, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token counts of every document before and after its edits, without encoding more than these touch."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), edits.cast(EDITS).alias("edits"),
        build_trees(docs, path, pattern, text_col).alias("tree"),
    )
    out = rows.select("doc_id", apply_edits(F.col("text"), F.col("tree"), F.col("edits"), path, pattern, True).alias("e"))
    return out.select(
        "doc_id", F.col("e.old_tokens").alias("n_tokens"), F.col("e.old_pieces").alias("n_pretokens"),
        F.col("e.n_chars").alias("edited_chars"), F.col("e.n_tokens").alias("edited_tokens"),
        F.col("e.n_pieces").alias("edited_pretokens"), F.col("e.encoded").alias("encoded_pretokens"),
    )
