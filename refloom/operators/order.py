"""Sorting, limits and pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from refloom.operators.skew import GROUP_LIMIT, number_ranges, number_rows, tie

# Window group limit in Spark works up to this many rows per group.
WINDOW_LIMIT = 1_000


def order_export(df: DataFrame, *order: str | Column) -> DataFrame:
    """Global sort, for exports that ask for one."""
    return df.orderBy(*order)


def limit_ordered(df: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The first ``n`` rows of a fixed order (one pass, top-n per task)."""
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, number: int, size: int, order: Sequence[str | Column]) -> DataFrame:
    """Page ``number`` (from 1). Deep pages are found by position in sorted ranges, not by skipping rows.

    Both ways use the same order, in which ties follow their content, so pages never overlap.
    """
    start = (number - 1) * size
    if start + size <= GROUP_LIMIT:
        return df.orderBy(*order, tie(df)).offset(start).limit(size)
    rows = number_ranges(df, order, out="_rn")
    return rows.filter(F.col("_rn").between(start + 1, start + size)).drop("_rn")


def page_slices(df: DataFrame, size: int, order: Sequence[str | Column], out: str = "page") -> DataFrame:
    """All rows with the number of their page."""
    rows = number_ranges(df, order, out="_rn")
    return rows.withColumn(out, F.floor((F.col("_rn") - 1) / size) + 1).drop("_rn")


def write_pages(df: DataFrame, path: str, order: Sequence[str | Column]) -> None:
    """Store a table in one order, with a directory of its sorted ranges, so that any page can be read without sorting again.

    Each range is a folder; the directory says how many rows it has and how many come before it.
    """
    sort = [*order, tie(df)]
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort).withColumn("_at", F.monotonically_increasing_id())
    ranged = ranged.withColumns({"_range": F.shiftright("_at", 33), "_pos": F.col("_at").bitwiseAND((1 << 33) - 1)}).drop("_at")
    ranged.write.partitionBy("_range").parquet(f"{path}/rows")
    spans = df.sparkSession.read.parquet(f"{path}/rows").groupBy("_range").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("_range", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    spans.coalesce(1).write.parquet(f"{path}/directory")


def read_page(spark: SparkSession, path: str, number: int, size: int) -> DataFrame:
    """Page ``number`` (from 1) of a table stored by ``write_pages``: reads the directory and the ranges that the page lies in."""
    start = (number - 1) * size
    end = start + size
    spans = spark.read.parquet(f"{path}/directory").filter((F.col("before") < end) & (F.col("before") + F.col("n") > start))
    rows = spark.read.parquet(f"{path}/rows")
    # As many ranges as one page touches.
    inside = F.lit(False)
    for r in spans.orderBy("_range").collect():
        inside |= (F.col("_range") == r["_range"]) & F.col("_pos").between(start - r["before"], end - r["before"] - 1)
    return rows.filter(inside).orderBy("_range", "_pos").drop("_range", "_pos")


def limit_per_partition(
    df: DataFrame, part: str, total: int, parts: int, order: Sequence[str | Column], limit: int = GROUP_LIMIT
) -> DataFrame:
    """Split a global limit evenly over partitions: the first ``total // parts`` rows of each."""
    share = total // parts
    if share <= WINDOW_LIMIT:
        rows = df.withColumn("_rn", F.row_number().over(Window.partitionBy(part).orderBy(*order, tie(df))))
    else:
        rows = number_rows(df, [part], order, "_rn", limit)
    return rows.filter(F.col("_rn") <= share).drop("_rn")
