"""Writers and flat text views."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refloom.sources.quoted import read_quoted


FORMATS = ("csv", "tsv", "jsonl", "json", "parquet")


def flat_value(df: DataFrame, name: str, sep: str = ";") -> Column:
    """A column as flat text: lists of scalars joined, other nested values as JSON, NULL as ``''``."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    nested = (T.StructType, T.MapType, T.ArrayType)
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, nested):
        text = F.array_join(value.cast("array<string>"), sep)
    elif isinstance(kind, nested):
        text = F.to_json(value)
    else:
        text = value.cast("string")
    return F.coalesce(text, F.lit("")).alias(name)


def to_reference_text(df: DataFrame, seps: dict[str, str] | None = None, sep: str = ";") -> DataFrame:
    """All-text view: NULL to ``''``, arrays joined by their separator, structs and maps as JSON."""
    return df.select(*[flat_value(df, c, (seps or {}).get(c, sep)) for c in df.columns])


def json_to_flat(df: DataFrame, sep: str = ";") -> DataFrame:
    """Flat table of JSON records with columns in alphabetical order."""
    return to_reference_text(df, sep=sep).select(*sorted(df.columns))


def declared(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exactly the declared columns in order: missing ones empty, undeclared ones dropped."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit("").alias(c) for c in columns])


def write_dataset(
    df: DataFrame, path: str, fmt: str = "csv", columns: Sequence[str] | None = None,
    seps: dict[str, str] | None = None, mode: str = "errorifexists",
) -> None:
    """Write with a fixed column order as csv, tsv, jsonl, json (an array in each file) or parquet. Files are written in parallel."""
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}: one of {', '.join(FORMATS)}")
    out = declared(df, columns) if columns else df
    if fmt in ("csv", "tsv"):
        writer = to_reference_text(out, seps).write.mode(mode).options(
            header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
        )
        writer.option("sep", "\t" if fmt == "tsv" else ",").csv(path)
    elif fmt == "jsonl":
        out.write.mode(mode).option("ignoreNullFields", False).json(path)
    elif fmt == "json":
        record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in out.columns]), {"ignoreNullFields": "false"})
        out.select(record.alias("value")).mapInPandas(_as_array, "value string").write.mode(mode).text(path)
    else:
        out.write.mode(mode).parquet(path)


def _as_array(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Lines of one JSON array around the records of a file."""
    lead = "["
    for rows in batches:
        if len(rows):
            yield pd.DataFrame({"value": [(lead if k == 0 else ",") + r for k, r in enumerate(rows["value"])]})
            lead = ","
    yield pd.DataFrame({"value": ["[]" if lead == "[" else "]"]})


def read_written(spark, path: str | Sequence[str], columns: Sequence[str], fmt: str = "csv") -> DataFrame:
    """Read a flat dataset back as text, empty cells as ``''``; the columns are checked against each file's header.

    Quoted fields may hold line breaks; files are read by their splits all the same.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return read_quoted(spark, path, schema, "\t" if fmt == "tsv" else ",", header=True).fillna("")


def consolidate(spark, paths: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Merge the partition files of a dataset into one table: one header, empty files skipped."""
    return read_written(spark, list(paths), columns)
