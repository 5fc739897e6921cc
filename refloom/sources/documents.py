"""JSON, XML and archive sources."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from refloom.operators.select import require_key


def read_results_json(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Records of ``{"results": [...]}`` documents, one document per file; a file is read by as many tasks as it has splits."""
    from refloom.sources.payloads import payload_records

    records = payload_records(spark, path)
    return records.select(F.from_json("record", schema).alias("r")).select("r.*")


def _fields(schema: str) -> str:
    """Column list as struct fields."""
    return T.StructType.fromDDL(schema).simpleString()[len("struct<"):-1]


def read_json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def parse_results(df: DataFrame, col: str, schema: str) -> DataFrame:
    """The same for documents held in a text column."""
    parsed = F.from_json(col, f"results array<struct<{_fields(schema)}>>")
    return df.select(F.inline(parsed["results"]))


def read_xml_records(
    spark: SparkSession, path: str | list[str], row_tag: str, schema: str | T.StructType, keys: tuple[str, ...] = (), flat: bool = False
) -> DataFrame:
    """Records of XML files by row tag; rows without a key are dropped.

    Spark reads a file of such records in one task. With ``flat``, for records that hold no element (nor comment) with the row tag, files are
    read by splits instead, cut behind the end tags.
    """
    if flat:
        ended = spark.read.option("lineSep", f"</{row_tag}>").text(path).select(F.concat("value", F.lit(f"</{row_tag}>")).alias("value"))
        whole = F.regexp_extract_all("value", F.lit(rf"(?s)<{row_tag}(?=[\s/>])(?:[^>]*/>|[^>]*>.*?</{row_tag}>)"), F.lit(0))
        rows = ended.select(F.explode(whole).alias("value")).select(parse_xml("value", schema).alias("r")).select("r.*")
    else:
        rows = spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)
    return require_key(rows, *keys) if keys else rows


def parse_xml(col: str | Column, schema: str | T.StructType) -> Column:
    """One record per XML text. A byte order mark in front is dropped."""
    text = F.col(col) if isinstance(col, str) else col
    return F.from_xml(F.regexp_replace(text, r"^\ufeff", ""), schema)


def xml_rows(df: DataFrame, col: str | Column, schema: str | T.StructType) -> DataFrame:
    """The record of each row's XML text, as columns. It is a generated row, so that filters on its fields come after the one parse and do not repeat it."""
    return df.select(F.explode(F.array(parse_xml(col, schema))).alias("r")).select("r.*")


def decode_fallback(raw: str | Column) -> Column:
    """Bytes as UTF-8 text when valid, else as Latin-1."""
    data = F.col(raw) if isinstance(raw, str) else raw
    return F.coalesce(F.try_validate_utf8(data.cast("string")), F.decode(data, "ISO-8859-1"))


def zip_members(files: DataFrame, suffix: str, raw: bool = False) -> DataFrame:
    """Members of archives held as rows of ``path`` and ``content``: (archive, member, pos, line), or (archive, member, content).

    For archives in files, ``archives.read_zip_members`` holds none of them.
    """
    files = files.select("path", "content")
    if raw:
        return files.mapInPandas(_whole_members(suffix), "archive string, member string, content binary")
    lines = files.mapInPandas(_member_lines(suffix), "archive string, member string, pos long, raw binary")
    return lines.withColumn("line", decode_fallback("raw")).drop("raw")


def _open(batch: pd.DataFrame, suffix: str):
    for path, content in zip(batch["path"], batch["content"]):
        with zipfile.ZipFile(io.BytesIO(content)) as archive:
            for name in archive.namelist():
                if name.lower().endswith(suffix):
                    yield path, name, archive


def _whole_members(suffix: str):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, name, archive in _open(batch, suffix):
                yield pd.DataFrame({"archive": [path], "member": [name], "content": [archive.read(name)]})

    return read


def _member_lines(suffix: str, size: int = 10_000):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, name, archive in _open(batch, suffix):
                with archive.open(name) as member:
                    rows, start = [], 0
                    for line in member:
                        rows.append(line.rstrip(b"\r\n"))
                        if len(rows) == size:
                            yield _frame(path, name, start, rows)
                            rows, start = [], start + size
                    if rows:
                        yield _frame(path, name, start, rows)

    return read


def _frame(path: str, name: str, start: int, rows: list[bytes]) -> pd.DataFrame:
    return pd.DataFrame({"archive": path, "member": name, "pos": range(start, start + len(rows)), "raw": rows})
