"""Quoted delimited text read by file splits, also where quoted fields hold line breaks.

A line break ends a record only outside quotes, and whether a split starts inside quotes depends on all of the file before it. A line is therefore a map of
that one state: what it is after the line if the line starts a record, and if it goes on inside quotes. Maps compose, so each split is scanned once
for both cases, one row per split carries the state on over the splits of a file, and only the lines of records that span
several lines are brought together; all others are parsed where they are read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refloom.operators.skew import join_keys
from refloom.sources.documents import decode_fallback

_PLACE = ["file", "block"]


def _after(sep: str) -> tuple[Column, Column]:
    """State after a line (1: inside quotes) that starts a record, and after one that starts inside quotes."""
    other = re.escape(sep)
    rest = f"[^{other}]*+"
    field = f'(?:"[^"]*+(?:""[^"]*+)*+"{rest}|[^"{other}]{rest}|)'
    # Byte by byte where a line is not UTF-8: a broken character must not swallow the quote behind it.
    value = decode_fallback(F.col("value").cast("binary"))
    quoted = F.instr(value, '"') > 0
    whole = value.rlike(rf"\A{field}(?:{other}{field})*+\z")
    closed = value.rlike(rf'\A[^"]*+(?:""[^"]*+)*+"{rest}(?:{other}{field})*+\z')
    return F.when(quoted & ~whole, 1).otherwise(0), F.when(quoted & closed, 0).otherwise(1)


def _lines(spark: SparkSession, paths: list[str], sep: str) -> DataFrame:
    """Lines with the file and the split (its offset) they are in, and their state maps."""
    after0, after1 = _after(sep)
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value", after0.alias("f0"), after1.alias("f1"),
    )


class _Split:
    """State of a split while its lines go by, for both states it may have started in."""

    def __init__(self) -> None:
        self.lines, self.state, self.start = 0, [0, 1], [-1, -1]

    def scan(self, f0: np.ndarray, f1: np.ndarray) -> dict[str, np.ndarray]:
        at = np.arange(len(f0))
        fixed = np.maximum.accumulate(np.where(f0 == f1, at, -1))
        swaps = np.cumsum((f0 == 1) & (f1 == 0))
        since = swaps - np.where(fixed >= 0, swaps[fixed], 0)
        out = {"n": self.lines + at}
        for h in (0, 1):
            after = np.where(fixed >= 0, f0[fixed], self.state[h]) ^ (since & 1)
            before = np.r_[self.state[h], after[:-1]]
            start = np.maximum.accumulate(np.r_[self.start[h], np.where(before == 0, out["n"], -1)])[1:]
            out |= {f"before{h}": before, f"after{h}": after, f"start{h}": start}
            self.state[h], self.start[h] = int(after[-1]), int(start[-1])
        self.lines += len(f0)
        return out


_NUMBERS = ("n", "before0", "after0", "start0", "before1", "after1", "start1")
_SCANNED = "file string, block long, value binary, " + ", ".join(f"{n} long" for n in _NUMBERS)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of whole splits, numbered, with the states around them and the line that starts their record, for both states at the split's start."""
    place, split = None, _Split()
    for batch in batches:
        if not batch.num_rows:
            continue
        file, block = batch.column("file"), batch.column("block").to_numpy()
        f0, f1 = (batch.column(n).to_numpy() for n in ("f0", "f1"))
        changed = np.r_[True, block[1:] != block[:-1]]
        changed[1:] |= pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero(changed)
        found = []
        for at, end in zip(cuts, np.r_[cuts[1:], len(block)], strict=True):
            if (here := (file[int(at)].as_py(), int(block[at]))) != place:
                place, split = here, _Split()
            found.append(split.scan(f0[at:end], f1[at:end]))
        numbers = [pa.array(np.concatenate([f[n] for f in found]).astype(np.int64)) for n in _NUMBERS]
        yield pa.RecordBatch.from_arrays([file, batch.column("block"), batch.column("value"), *numbers], names=["file", "block", "value", *_NUMBERS])


def _carried(scanned: DataFrame) -> DataFrame:
    """Per split: the state at its start, the last record start before it, and whether its whole file is UTF-8."""
    splits = scanned.groupBy(*_PLACE).agg(
        F.max_by("after0", "n").alias("end0"), F.max_by("after1", "n").alias("end1"), F.max("start0").alias("start0"), F.max("start1").alias("start1"),
        F.bool_and(F.is_valid_utf8(F.col("value").cast("string"))).alias("valid"),
    )
    file = Window.partitionBy("file")
    upto = file.orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    earlier = file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("swaps", F.sum(((F.col("end0") == 1) & (F.col("end1") == 0)).cast("long")).over(upto))
    fixed = F.last(F.when(F.col("end0") == F.col("end1"), F.struct("end0", "swaps")), ignorenulls=True).over(earlier)
    swaps = F.coalesce(F.lag("swaps").over(file.orderBy("block")), F.lit(0)) - F.coalesce(fixed["swaps"], F.lit(0))
    state = F.coalesce(fixed["end0"], F.lit(0)).bitwiseXOR(F.pmod(swaps, F.lit(2)))
    splits = splits.withColumn("state", state).withColumn("utf8", F.bool_and("valid").over(file))
    start = F.when(F.col("state") == 0, F.col("start0")).otherwise(F.col("start1"))
    last = F.last(F.when(start >= 0, F.struct(F.col("block").alias("block"), start.alias("n"))), ignorenulls=True).over(earlier)
    return splits.select(*_PLACE, "state", "utf8", last.alias("last"))


def quoted_records(spark: SparkSession, paths: str | list[str], sep: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Records of quoted text as they stand in the files: (file, block, n, record).

    ``block`` and ``n`` are the split and the line in it at which a record starts, so (block, n) is the order in a file and its first record is at (0, 0).
    Line breaks inside quotes become ``\\n``. A UTF-8 file with any invalid line is Latin-1 as a whole.
    """
    lines = _lines(spark, [paths] if isinstance(paths, str) else list(paths), sep)
    scanned = lines.withColumn("value", F.col("value").cast("binary")).mapInArrow(_scan, _SCANNED)
    rows = join_keys(scanned, _carried(scanned), _PLACE)
    own = {n: F.when(F.col("state") == 0, F.col(f"{n}0")).otherwise(F.col(f"{n}1")) for n in ("before", "after", "start")}
    value = F.col("value").cast("string")
    text = F.when(F.col("utf8"), value).otherwise(F.decode("value", "ISO-8859-1")) if encoding == "UTF-8" else F.decode("value", encoding)
    rows = rows.withColumns(own).withColumn("text", text)
    alone = (F.col("before") == 0) & (F.col("after") == 0)
    whole = rows.filter(alone).select("file", "block", "n", F.col("text").alias("record"))
    first = F.when(F.col("start") >= 0, F.struct("block", F.col("start").alias("n"))).otherwise(F.col("last"))
    spanning = rows.filter(~alone).select("file", first.alias("first"), F.struct("block", "n", "text").alias("line"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda x: x["text"]), "\n")
    spanning = spanning.groupBy("file", "first").agg(joined.alias("record"))
    return whole.unionByName(spanning.select("file", "first.block", "first.n", "record"))


def read_quoted(
    spark: SparkSession, paths: str | list[str], schema: T.StructType, sep: str = ",", header: bool = False, encoding: str = "UTF-8"
) -> DataFrame:
    """Table of quoted text with the given layout: short rows padded with NULL, long ones cut, blank ones skipped. A header is checked and dropped.

    One pass over the text, without Python, tells whether each line is a record by itself and valid UTF-8. Then Spark's reader takes
    the splits as they are; else records are put together first.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    options = {"sep": sep, "quote": '"', "escape": '"', "mode": "PERMISSIVE"}
    valid = F.is_valid_utf8("value") if encoding == "UTF-8" else F.lit(True)
    found = _lines(spark, paths, sep).agg(F.max("f0").alias("open"), F.bool_and(valid).alias("valid")).first()
    if not found["open"] and found["valid"] is not False:
        return spark.read.schema(schema).options(header=header, enforceSchema=False, encoding=encoding, **options).csv(paths)
    rows = quoted_records(spark, paths, sep, encoding).filter(F.trim("record") != "")
    if header:
        rows = _without_header(rows, schema.names, options)
    parsed = F.from_csv("record", _ddl(schema), options)
    return rows.select(parsed.alias("r")).select("r.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _without_header(rows: DataFrame, names: Sequence[str], options: dict[str, str]) -> DataFrame:
    """Rows but the first of each file, which must name the columns."""
    cells = F.from_csv("record", ", ".join(f"c{k} string" for k in range(len(names) + 1)), options)
    is_header = F.lit(True)
    for k, name in enumerate(names):
        is_header &= F.lower(cells[f"c{k}"]).eqNullSafe(F.lit(name.lower()))
    is_header &= cells[f"c{len(names)}"].isNull()
    wrong = F.raise_error(F.concat(F.lit("Header does not fit the columns: "), F.col("record"))).cast("boolean")
    first = (F.col("block") == 0) & (F.col("n") == 0)
    return rows.filter(F.when(~first, F.lit(True)).when(is_header, F.lit(False)).otherwise(wrong))
