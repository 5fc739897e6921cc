"""Exact numbering and splitting of groups of any size.

A window or ``collect_list`` over one key sends that key to one task. The helpers here find the
keys that are too large for that, and work on those in ranges of the sort order instead, so that
results stay whole and every task stays bounded.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refloom.session import materialize

# Rows of a key that make one part of its list or text. A fixed rule for every key, whatever else is in the table: rows 1 to
# GROUP_LIMIT in the order of the list are part 0, the next ones part 1, and so on.
GROUP_LIMIT = 100_000


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi join on keys where NULL equals NULL; the left side's key columns are kept."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def _order(order: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def hot_groups(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame | None:
    """Keys with more than ``limit`` rows; None when there are none. This only chooses how positions are found, never what they are.

    Checked by running one count per key, which reads the keys only and is combined before the
    shuffle. Few keys come back: at most one per ``limit`` rows.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if (counts.agg(F.max("_n")).head()[0] or 0) <= limit:
        return None
    return materialize(counts.filter(F.col("_n") > limit).select(*keys), "hot")


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys and rows of hot keys."""
    return join_keys(df, hot, keys, "left_anti"), join_keys(df, hot, keys, "left_semi")


def tie(df: DataFrame) -> Column:
    """Last order column of every numbering: rows that are equal in the given order follow a hash of their content."""
    return F.xxhash64(*[f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


def number_ranges(df: DataFrame, order: Sequence[str | Column], keys: Sequence[str] = (), out: str = "rn") -> DataFrame:
    """1-based row number per key in ``order``, computed over sorted ranges.

    The sorted ranges are written once: the numbers and the range sizes must come from the same
    ranges, also when a lost executor makes Spark run a part again.
    """
    sort = [F.col(k) for k in keys] + [*_order(order), tie(df)]
    ranged = df.repartitionByRange(*sort).sortWithinPartitions(*sort)
    ranged = materialize(ranged.withColumn("_at", F.monotonically_increasing_id()), "ranges")
    ranged = ranged.withColumn("_range", F.shiftright("_at", 33))
    spans = ranged.groupBy(*keys, "_range").agg(F.min("_at").alias("_from"), F.count(F.lit(1)).alias("_n"))
    # One row per key and range; a key of n rows has at most n / range size + 1 of them.
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        *keys, "_range", "_from", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before")
    )
    number = (F.col("_at") - F.col("_from") + F.col("_before") + 1).alias(out)
    return join_keys(ranged, spans, [*keys, "_range"]).select(*df.columns, number)


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "rn", limit: int = GROUP_LIMIT
) -> DataFrame:
    """1-based row number per key: a window for ordinary keys, sorted ranges for hot ones."""
    hot = hot_groups(df, keys, limit)
    window = F.row_number().over(Window.partitionBy(*keys).orderBy(*_order(order), tie(df))).cast("long")
    if hot is None:
        return df.withColumn(out, window)
    cold, warm = split_hot(df, keys, hot)
    return cold.withColumn(out, window).unionByName(number_ranges(warm, order, keys, out))


def split_groups(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], out: str = "part", limit: int = GROUP_LIMIT
) -> DataFrame:
    """Number the slices of each group: rows 1..limit in ``order`` get 0, the next get 1, and so on.

    Grouping by the keys and ``out`` then collects at most ``limit`` rows anywhere.
    """
    return slice_hot(df, keys, order, hot_groups(df, keys, limit), out, limit)


def slice_hot(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], hot: DataFrame | None,
    out: str = "part", limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The same with the hot keys known. Keys listed there that are not large after all are fine."""
    if hot is None:
        return df.withColumn(out, F.lit(0).cast("long"))
    cold, warm = split_hot(df, keys, hot)
    numbered = number_ranges(warm, order, keys, "_rn")
    sliced = numbered.withColumn(out, F.floor((F.col("_rn") - 1) / limit).cast("long")).drop("_rn")
    return cold.withColumn(out, F.lit(0).cast("long")).unionByName(sliced)
