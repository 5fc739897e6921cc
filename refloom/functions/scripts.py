"""Data held in page scripts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The object literal with the glossary, and its entries in quotes or backticks.
OBJECT = r"(?s)glossaryData\s*=\s*\{(.*?)\};"
ENTRY = r'(?s)"([^"]+)"\s*:\s*(?:"((?:[^"\\]|\\.)*)"|`([^`]*)`)'


def glossary_entries(df: DataFrame, script: str, keep: Sequence[str]) -> DataFrame:
    """(term, definition) rows of a glossary object in a script text.

    Quoted definitions are unescaped; backtick ones lose blank lines and indentation.
    """
    body = F.regexp_extract(script, OBJECT, 1)
    found = [F.regexp_extract_all(body, F.lit(ENTRY), F.lit(i)) for i in (1, 2, 3)]
    rows = df.select(*keep, F.explode(F.arrays_zip(*[f.alias(n) for f, n in zip(found, "kqb")])).alias("e"))
    quoted = F.replace(F.replace(F.col("e.q"), F.lit('\\"'), F.lit('"')), F.lit("\\n"), F.lit("\n"))
    lines = F.transform(F.split("e.b", "\n"), lambda x: F.trim(x))
    ticked = F.array_join(F.filter(lines, lambda x: x != ""), "\n")
    text = F.when(F.col("e.q") != "", quoted).otherwise(ticked)
    return rows.select(*keep, F.col("e.k").alias("term"), F.trim(text).alias("definition"))
