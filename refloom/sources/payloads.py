"""Records of large ``{"results": [...]}`` documents, each file read by many tasks.

A payload may be one line of any length, so it is read in pieces that end at ``}``, which file splits can hold. Whether a brace counts depends on being
inside a string, and what it closes on how deep it is, both a matter of everything before it. So each split is summed up first, for both cases of
starting inside a string or not: quotes, change of depth, least depth, and where a top-level ``results`` array is left open. Such
summaries compose: one row per split gives the state at the start of every split. Then each split is cut into its records where it is
read; only records that lie across a border of splits are brought together, from a head and a tail per split.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refloom.operators.skew import join_keys

_PLACE = ["file", "block"]
_QUOTE, _BACKSLASH = ord('"'), ord("\\")
_TURN = np.zeros(256, np.int8)
_TURN[[ord("{"), ord("[")]], _TURN[ord("]")] = 1, -1


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Pieces of the files between ``}`` and ``}``, with the split they are in; ``at`` rises within it."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("value"),
    )


@dataclass
class Opening:
    """Where a piece opens an array under the wanted key: position after the bracket, depth before it, least depth behind it."""

    end: int
    depth: int
    least: int


class Pieces:
    """Pieces measured for both states (outside, inside a string) they may start in; each is followed by its ``}``."""

    def __init__(self, values: pa.Array, key: re.Pattern[bytes], name: str):
        self.values = values.cast(pa.large_binary())
        offsets = np.frombuffer(self.values.buffers()[1], np.int64)[self.values.offset : self.values.offset + len(values) + 1]
        data = np.frombuffer(self.values.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        starts, ends = offsets[:-1] - offsets[0], offsets[1:] - offsets[0]
        size = ends - starts
        quotes = data == _QUOTE
        if (data == _BACKSLASH).any():
            # A quote behind an odd number of backslashes does not count.
            at = np.arange(len(data))
            other = np.maximum(np.maximum.accumulate(np.where(data != _BACKSLASH, at, -1)), np.repeat(starts, size) - 1)
            run = np.r_[0, (at - other)[:-1]]
            run[starts[size > 0]] = 0
            quotes &= run % 2 == 0
        seen = np.r_[0, np.cumsum(quotes)]
        inside = (seen[:-1] - np.repeat(seen[starts], size)) & 1
        self.flips = (seen[ends] - seen[starts]) & 1
        turns, self.change, self.least, self.openings = _TURN[data], [], [], []
        named = np.flatnonzero(pc.match_substring(values.cast(pa.binary()), name).to_numpy(zero_copy_only=False))
        for h in (0, 1):
            depth = np.r_[0, np.cumsum(np.where(inside == h, turns, 0))]
            own = depth[ends] - depth[starts]
            after = own - ((self.flips ^ h) == 0)
            least = np.minimum(0, after)
            full = size > 0
            least[full] = np.minimum(least[full], np.minimum.reduceat(depth[1:], starts[full])[: full.sum()] - depth[starts[full]]) if full.any() else 0
            self.change.append(after)
            self.least.append(least)
            found: dict[int, list[Opening]] = {}
            for k in named.tolist():
                for m in key.finditer(self.values[k].as_py()):
                    at, end = starts[k] + m.start(), starts[k] + m.end()
                    if inside[at] == h and quotes[at]:
                        behind = min(int(depth[end : ends[k] + 1].min()), int(depth[starts[k]] + after[k]))
                        found.setdefault(k, []).append(Opening(m.end(), int(depth[at] - depth[starts[k]]), int(behind - depth[starts[k]])))
            self.openings.append(found)


@dataclass
class Summary:
    """What a split is, if it starts in one state: the state and depth after it, its least depth, and the depths at which arrays are left open."""

    inside: int
    depth: int = 0
    least: int = 0
    open: list[int] = field(default_factory=list)

    def add(self, p: Pieces) -> None:
        n = len(p.flips)
        inside = self.inside ^ np.r_[0, np.cumsum(p.flips)] & 1
        state = inside[:-1]
        before = self.depth + np.r_[0, np.cumsum(np.where(state, p.change[1], p.change[0]))]
        lowest = before[:-1] + np.where(state, p.least[1], p.least[0])
        at = 0
        for k in sorted({*p.openings[0], *p.openings[1]}):
            self._lower(lowest[at : k + 1])
            for o in p.openings[state[k]].get(k, ()):
                depth = int(before[k]) + o.depth
                if int(before[k]) + o.least > depth:
                    self.open.append(depth)
            at = k + 1
        self._lower(lowest[at:])
        self.inside, self.depth, self.least = int(inside[n]), int(before[n]), min(self.least, int(lowest.min(initial=0)))

    def _lower(self, depths: np.ndarray) -> None:
        if self.open and len(depths):
            least = int(depths.min())
            self.open = [d for d in self.open if least > d]


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches cut where the split changes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block").to_numpy()
        changed = np.r_[True, block[1:] != block[:-1]]
        changed[1:] |= pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(changed).tolist()
        for at, end in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            yield (file[at].as_py(), int(block[at])), batch.slice(at, end - at)


def _pattern(key: str) -> tuple[re.Pattern[bytes], str]:
    return re.compile(rb'"' + re.escape(key.encode()) + rb'"\s*:\s*\['), f'"{key}"'


_SUMMARY = "file string, block long, inside0 long, depth0 long, least0 long, open0 array<long>, inside1 long, depth1 long, least1 long, open1 array<long>"


def _summarize(key: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, both = None, []
        for here, rows in _by_split(batches):
            if here != place:
                if both:
                    yield _summary_row(place, both)
                place, both = here, [Summary(0), Summary(1)]
            pieces = Pieces(rows.column("value"), *_pattern(key))
            for s in both:
                s.add(pieces)
        if both:
            yield _summary_row(place, both)

    return run


def _summary_row(place: tuple[str, int], both: list[Summary]) -> pa.RecordBatch:
    arrays, names = [pa.array([place[0]]), pa.array([place[1]], pa.int64())], ["file", "block"]
    for h, s in enumerate(both):
        arrays += [pa.array([x], pa.int64()) for x in (s.inside, s.depth, s.least)] + [pa.array([s.open], pa.list_(pa.int64()))]
        names += [f"{n}{h}" for n in ("inside", "depth", "least", "open")]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _starts(summaries: DataFrame) -> DataFrame:
    """State at the start of every split: inside a string, depth, and whether the wanted array is open."""
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = F.pmod(F.coalesce(F.sum("inside0").over(earlier), F.lit(0)), F.lit(2))
    rows = summaries.withColumn("inside", inside)
    rows = rows.withColumns({n: F.when(F.col("inside") == 0, F.col(f"{n}0")).otherwise(F.col(f"{n}1")) for n in ("depth", "least", "open")})
    rows = rows.withColumn("deep", F.coalesce(F.sum("depth").over(earlier), F.lit(0)))
    event = F.when(F.array_contains("open", 1 - F.col("deep")), True).when(F.col("least") + F.col("deep") < 2, False)
    is_open = F.coalesce(F.last(event, ignorenulls=True).over(earlier), F.lit(False))
    return rows.select(*_PLACE, "inside", "deep", is_open.alias("is_open"))


_CUT = "file string, block long, seq long, whole boolean, ends boolean, record string"


def _cut(key: str):
    """Records of a split whose start is known. A split starts and ends in the middle of records: these parts are not ``whole``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, split = None, None
        for here, rows in _by_split(batches):
            if here != place:
                if split is not None:
                    yield from split.close()
                place, split = here, _Split(here, *(rows.column(n)[0].as_py() for n in ("inside", "deep", "is_open")))
            yield from split.cut(Pieces(rows.column("value"), *_pattern(key)))
        if split is not None:
            yield from split.close()

    return run


class _Split:
    def __init__(self, place: tuple[str, int], inside: int, depth: int, is_open: bool):
        self.place, self.inside, self.depth, self.is_open = place, inside, depth, is_open
        self.parts: list[bytes] = []
        self.whole, self.seq = not (is_open and place[1]), 0

    def cut(self, p: Pieces) -> Iterator[pa.RecordBatch]:
        inside = self.inside ^ np.r_[0, np.cumsum(p.flips)] & 1
        state = inside[:-1]
        depth = self.depth + np.r_[0, np.cumsum(np.where(state, p.change[1], p.change[0]))]
        lowest = depth[:-1] + np.where(state, p.least[1], p.least[0])
        out = []
        for k, (value, after, least, s) in enumerate(zip(p.values.to_pylist(), depth[1:].tolist(), lowest.tolist(), state.tolist(), strict=True)):
            if least < 2:
                # What was open has ended; the array may be opened in this very piece.
                self.is_open, self.parts = False, []
                for o in p.openings[s].get(k, ()):
                    if depth[k] + o.depth == 1 and depth[k] + o.least > 1:
                        self.is_open, self.whole, value = True, True, value[o.end :]
            if self.is_open:
                self.parts.append(value)
                if after == 2:
                    out.append(self._row(True))
        self.inside, self.depth = int(inside[-1]), int(depth[-1])
        if out:
            yield self._batch(out)

    def _row(self, ends: bool) -> tuple[int, bool, bool, bytes]:
        record = b"}".join(self.parts) + b"}"
        row = (self.seq, self.whole and ends, ends, record)
        self.parts, self.whole, self.seq = [], True, self.seq + 1
        return row

    def close(self) -> Iterator[pa.RecordBatch]:
        if self.is_open and self.parts:
            yield self._batch([self._row(False)])

    def _batch(self, rows: list[tuple[int, bool, bool, bytes]]) -> pa.RecordBatch:
        seq, whole, ends, record = zip(*rows, strict=True)
        n = len(rows)
        arrays = [pa.array([self.place[0]] * n), pa.array([self.place[1]] * n, pa.int64()), pa.array(seq, pa.int64()), pa.array(whole), pa.array(ends)]
        text = pa.array([r.decode("utf-8", "replace") for r in record], pa.string())
        return pa.RecordBatch.from_arrays([*arrays, text], names=["file", "block", "seq", "whole", "ends", "record"])


def payload_records(spark: SparkSession, path: str | list[str], key: str = "results") -> DataFrame:
    """Texts of the objects in the top-level array ``key`` of every JSON document, one document per file."""
    pieces = _pieces(spark, path)
    starts = _starts(pieces.drop("at").mapInArrow(_summarize(key), _SUMMARY))
    known = join_keys(pieces, starts, _PLACE).sortWithinPartitions(*_PLACE, "at")
    cut = known.drop("at").mapInArrow(_cut(key), _CUT)
    whole = cut.filter("whole").select("file", "record")
    # Parts across borders: at most a head and a tail per split.
    earlier = Window.partitionBy("file").orderBy("block", "seq").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut.filter("not whole").withColumn("number", F.coalesce(F.sum(F.col("ends").cast("long")).over(earlier), F.lit(0)))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "seq", "record"))), lambda x: x["record"]), "")
    joined = parts.groupBy("file", "number").agg(text.alias("record"), F.max("ends").alias("ends")).filter("ends")
    return whole.unionByName(joined.select("file", "record")).select("file", F.regexp_extract("record", r"(?s)\{.*", 0).alias("record"))
