"""Nested records to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def normalize(
    df: DataFrame, parent: Sequence[Column], children: dict[str, tuple[Column, Sequence[str | Column]]], key: str
) -> dict[str, DataFrame]:
    """One nested table to a parent table and one table per child array.

    Each result is its own projection over the same scan: nested column pruning reads only the
    fields it uses, and nothing is cached.
    """
    out = {"parent": df.select(*parent)}
    for name, (array, cols) in children.items():
        rows = df.select(key, F.explode(array).alias("_c"))
        out[name] = rows.select(key, *[F.col(f"_c.{c}").alias(c) if isinstance(c, str) else c for c in cols])
    return out


def explode_children(df: DataFrame, array: str | Column, out: str) -> DataFrame:
    """One row per array item, and one row with a NULL item when there is none."""
    return df.select("*", F.explode_outer(array).alias(out))


def explode_json(
    df: DataFrame, text: str, schema: str, keep: Sequence[str], out: str | None = None
) -> DataFrame:
    """One row per object of a JSON list held as text. Bad JSON and JSON that is no list are skipped."""
    valid = F.try_parse_json(text).isNotNull() & F.ltrim(F.col(text)).startswith("[")
    rows = df.select(*keep, F.when(valid, F.from_json(text, schema)).alias("_items"))
    rows = rows.select(*keep, F.posexplode("_items").alias("item_pos", "_item")).filter("_item is not null")
    if out:
        return rows.withColumnRenamed("_item", out)
    return rows.select(*keep, "item_pos", "_item.*")


def explode_self(
    df: DataFrame, is_atomic: Column, own: Column, related: Column, keep: Sequence[str | Column], out: str
) -> DataFrame:
    """One row per component; an atomic record is its own component, one without components keeps a blank row."""
    items = F.when(is_atomic, F.array(own)).otherwise(related)
    return df.select(*keep, F.explode_outer(items).alias(out))


def dimension(df: DataFrame, keys: Sequence[str], attrs: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First seen attributes per id; rows without an id are dropped. Combined before the shuffle."""
    at = F.struct(*order)
    rows = df
    for k in keys:
        rows = rows.filter(F.coalesce(F.col(k).cast("string"), F.lit("")) != "")
    if not attrs:
        return rows.select(*keys).distinct()
    first = rows.groupBy(*keys).agg(F.min_by(F.struct(*attrs), at).alias("_first"))
    return first.select(*keys, *[F.col(f"_first.{a}").alias(a) for a in attrs])
