"""Product labels: label metadata with concept and class maps, search and statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from refloom.operators.aggregate import dataset_stats
from refloom.operators.joins import left_attach, search_joined


def with_concepts(metadata: DataFrame, concepts: DataFrame) -> DataFrame:
    """Every label with each of its concepts, sorted by title for export."""
    joined = left_attach(metadata, concepts.drop("spl_version"), ["setid"])
    return joined.orderBy("title", "setid", "rxcui")


def with_classes(classes: DataFrame, metadata: DataFrame) -> DataFrame:
    """Every class link with the metadata of its label."""
    return left_attach(classes.withColumnRenamed("spl_setid", "setid"), metadata.drop("spl_version"), ["setid"])


def search(metadata: DataFrame, concepts: DataFrame, term: str, k: int = 50) -> DataFrame:
    """The first ``k`` labels with the term in title, id or a concept name."""
    hits = search_joined(metadata, concepts, "setid", term, ["title", "setid"], ["rxstring", "rxcui"])
    return hits.distinct().orderBy("setid").limit(k)


def statistics(metadata: DataFrame, concepts: DataFrame, classes: DataFrame) -> DataFrame:
    """Row and distinct label counts per table."""
    tables = {"metadata": (metadata, "setid"), "concepts": (concepts, "setid"), "classes": (classes, "spl_setid")}
    rows = [
        dataset_stats(df.withColumnRenamed(key, "setid"), (), ["setid"]).withColumn("table", F.lit(name))
        for name, (df, key) in tables.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])
