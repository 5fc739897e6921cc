"""Set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_tagged(variants: dict[str, DataFrame], tag: str) -> DataFrame:
    """Variants of one table under each other, with the name of the variant in ``tag``."""
    return reduce(DataFrame.unionByName, [df.withColumn(tag, F.lit(name)) for name, df in variants.items()])


def union_levels(*levels: DataFrame, default: str | None = "") -> DataFrame:
    """Tables under each other, columns one of them lacks filled with ``default``."""
    joined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), levels)
    return joined if default is None else joined.fillna(default)


def id_difference(left: DataFrame, right: DataFrame, left_id: str, right_id: str) -> DataFrame:
    """Ids of the left table that the right one lacks."""
    ids = left.select(F.col(left_id).alias("id")).distinct()
    return ids.join(right.select(F.col(right_id).alias("id")).distinct(), "id", "left_anti")


def id_union(*ids: DataFrame) -> DataFrame:
    """Distinct ids of several sources. Each source is reduced before they meet."""
    return reduce(DataFrame.union, [df.toDF("id").distinct() for df in ids]).distinct()
