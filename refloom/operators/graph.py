"""Connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.session import materialize


def components(links: DataFrame, low: str = "a", high: str = "b") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) of every node but the roots, from undirected links.

    Alternates between linking the larger and the smaller neighbours of each node to its smallest one; the number of rounds is
    logarithmic in the size of a component. Only links are moved, and each step is written once.
    """

    def fold(pairs: DataFrame) -> tuple[DataFrame, tuple]:
        done = materialize(pairs.distinct(), "links")
        return done, tuple(done.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    edges, state = fold(links.select(F.greatest(low, high).alias("u"), F.least(low, high).alias("v")).filter("u <> v"))
    while state[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, after = fold(small.unionByName(least.select("u", F.col("m").alias("v"))))
        if after == state:
            break
        state = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
