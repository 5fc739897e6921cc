"""Concept files: ingredients of concepts, flat thesaurus, code lists, bulk identifiers."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from refloom.functions.arrays import distinct_ordered, names, pack
from refloom.operators.dedup import dedup_first
from refloom.operators.joins import pending
from refloom.operators.nested import explode_self
from refloom.operators.select import require_key
from refloom.schemas import CONCEPT_COLUMNS, TERMINOLOGY_COLUMNS
from refloom.sources.delimited import body_lines, fields, file_heads, read_folded, split_line

CONCEPT = """
    rxcui string, name string, tty string,
    related array<struct<tty: string, conceptProperties: array<struct<rxcui: string, name: string>>>>
"""


def _related(kind: str) -> Column:
    """Members of the related groups of one kind."""
    groups = F.filter("related", lambda g: g["tty"] == kind)
    empty = F.array().cast("array<struct<rxcui: string, name: string>>")
    return F.flatten(F.transform(groups, lambda g: F.coalesce(g["conceptProperties"], empty)))


def ingredients(concepts: DataFrame) -> DataFrame:
    """One row per concept and ingredient, brand names packed; an ingredient is its own, none gives a blank."""
    brands = pack(distinct_ordered(names(_related("BN"), "name")), "|")
    keep = [F.col("name").alias("query"), "rxcui", "name", "tty", brands.alias("synonym")]
    rows = explode_self(concepts, F.col("tty") == "IN", F.struct("rxcui", "name"), _related("IN"), keep, "i")
    return rows.select(
        "query", "rxcui", "name", "tty", "synonym",
        F.coalesce("i.rxcui", F.lit("")).alias("ingredient_rxcui"), F.coalesce("i.name", F.lit("")).alias("ingredient_name"),
    )


def pending_concepts(concepts: DataFrame, done: DataFrame) -> DataFrame:
    return pending(concepts, done, ["rxcui"])


def thesaurus(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Flat concept file; surplus fields fold into the subset column, the first synonym is the name."""
    rows = read_folded(spark, path, CONCEPT_COLUMNS)
    order = CONCEPT_COLUMNS[:3] + ["preferred_name"] + CONCEPT_COLUMNS[3:]
    return rows.select(*order)


def terminology(lines: DataFrame, standard: str | Column) -> DataFrame:
    """Tab separated code list lines (column ``value``, header dropped) with the name of their standard."""
    rows = lines.select(
        split_line("value", "\t").alias("p"), (F.lit(standard) if isinstance(standard, str) else standard).alias("Standard")
    )
    return require_key(rows.select(*fields("p", TERMINOLOGY_COLUMNS), "Standard"), "Code").select(*TERMINOLOGY_COLUMNS, "Standard")


# Fixed value: how the first line of a code list begins, if it is a header.
TERMINOLOGY_HEADER = "Code\t"


def read_terminologies(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Code lists of several standards in one table."""
    parts = []
    for standard, path in paths.items():
        heads = file_heads(spark, path)
        for titled in (True, False):
            files = [file for file, head in heads if head.startswith(TERMINOLOGY_HEADER) == titled]
            if files:
                parts.append(terminology(body_lines(spark, files, titled).withColumnRenamed("line", "value"), standard))
    return reduce(DataFrame.unionByName, parts)


def index_substances(links: DataFrame) -> DataFrame:
    """Substance index out of page links (page_id, pos, text, href): name, code and link, first seen name wins."""
    # Fixed value: the parameter of a report address that holds the substance.
    code = F.trim(F.regexp_replace(F.regexp_extract("href", r"P3=([^&]+)", 1), r"\+|%20", " "))
    is_report = F.contains("href", F.lit("dap.ema.europa.eu")) | F.contains("href", F.lit("saw.dll"))
    rows = links.filter(is_report & (F.col("text") != "")).select(
        "page_id", "pos", F.col("text").alias("substance_name"), F.nullif(code, F.lit("")).alias("substance_code"), F.col("href").alias("dap_url")
    )
    return dedup_first(rows, ["substance_name"], ["page_id", "pos"]).drop("page_id", "pos")
