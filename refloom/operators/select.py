"""Projections, filters and predicates."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.text import clean_name, col, safe_text, strip_space

# Texts that stand for a missing value.
LIST_SENTINELS = ("NIL", "None", "N/A")
INVALID_NAMES = ("", "n/a", "na", "n.a.", "none", "null")


def clean_columns(df: DataFrame) -> DataFrame:
    """All headers as lower snake case identifiers."""
    return df.toDF(*[clean_name(c) for c in df.columns])


def _plain(name: str) -> str:
    return re.sub(r"[ _.]", "", name.lower())


def find_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """First candidate that names a column, ignoring case, space, ``_`` and ``.``."""
    known = {}
    for c in df.columns:
        known.setdefault(_plain(c), c)
    return next((known[_plain(c)] for c in candidates if _plain(c) in known), None)


def pick(df: DataFrame, candidates: Sequence[str], default: str = "") -> Column:
    """Trimmed value of the first column found; ``default`` for no such column or a missing value."""
    found = find_column(df, candidates)
    return F.lit(default) if found is None else F.coalesce(strip_space(df[f"`{found}`"]), F.lit(default))


def nested_project(df: DataFrame, fields: dict[str, str | Column]) -> DataFrame:
    """Flat projection of nested fields as trimmed text, ``''`` where missing."""
    return df.select(*[safe_text(src).alias(name) for name, src in fields.items()])


def require_key(df: DataFrame, *keys: str) -> DataFrame:
    """Drop rows whose key is NULL or blank."""
    return df.filter(reduce(lambda a, b: a & b, [F.trim(F.col(k).cast("string")) != "" for k in keys]))


def contains_any(term: str, cols: Iterable[str | Column]) -> Column:
    """Case-insensitive literal substring in any of the columns; NULL columns do not match."""
    needle = F.lower(F.lit(term))
    tests = [F.coalesce(F.contains(F.lower(col(c)), needle), F.lit(False)) for c in cols]
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def search_any(df: DataFrame, term: str, cols: Sequence[str]) -> DataFrame:
    return df.filter(contains_any(term, cols))


def search_nested(df: DataFrame, term: str, cols: Sequence[str], arrays: dict[str, Sequence[str]]) -> DataFrame:
    """Substring search over plain columns and over fields of arrays of structs.

    ``arrays`` maps an array column to field paths; ``a.b`` reaches into an array nested in a struct.
    """
    test = contains_any(term, cols) if cols else F.lit(False)
    for array, paths in arrays.items():
        for path in paths:
            test = test | F.coalesce(_any_match(F.col(array), path.split("."), term), F.lit(False))
    return df.filter(test)


def _any_match(array: Column, path: list[str], term: str) -> Column:
    if len(path) == 1:
        return F.exists(array, lambda x: contains_any(term, [x[path[0]]]))
    return F.exists(array, lambda x: F.coalesce(_any_match(x[path[0]], path[1:], term), F.lit(False)))


def filter_in(df: DataFrame, name: str, allowed: str) -> DataFrame:
    """Keep rows whose value is in a comma list, without case; ``all`` keeps everything."""
    values = [v.strip().lower() for v in allowed.split(",") if v.strip()]
    return df if "all" in values else df.filter(F.lower(name).isin(values))


def filter_records(
    df: DataFrame,
    equals: dict[str, object] | None = None,
    at_least: dict[str, object] | None = None,
    icontains: dict[str, str] | None = None,
    iexact: dict[str, str] | None = None,
) -> DataFrame:
    """AND of the filters given; those left out do not apply."""
    tests = [F.col(c) == v for c, v in (equals or {}).items()]
    tests += [F.col(c) >= v for c, v in (at_least or {}).items()]
    tests += [contains_any(v, [c]) for c, v in (icontains or {}).items()]
    tests += [F.lower(c) == v.lower() for c, v in (iexact or {}).items()]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def eligible(key: str | Column, flags: Sequence[Column]) -> Column:
    """Has an id and at least one of the flags."""
    return (safe_text(key) != "") & F.coalesce(reduce(lambda a, b: a | b, flags), F.lit(False))


def filter_tokens(df: DataFrame, tokens: str, fields: dict[str, str | Column]) -> DataFrame:
    """AND of ``name:value`` tokens in a comma list. ``from_x`` / ``to_x`` are inclusive bounds on ``x``.

    Conditions stay plain comparisons on columns, so they reach the scan or prune partitions.
    """
    for token in filter(None, (t.strip() for t in tokens.split(","))):
        name, value = (p.strip() for p in token.split(":", 1))
        if name.startswith("from_") and name[5:] in fields:
            df = df.filter(col(fields[name[5:]]) >= value)
        elif name.startswith("to_") and name[3:] in fields:
            df = df.filter(col(fields[name[3:]]) <= value)
        else:
            df = df.filter(col(fields[name]) == value)
    return df


def quality_status(head: Column, text: Column, shortest: int = 100) -> Column:
    """Status of a document: wrong magic bytes, no text, too little text, or good."""
    size = F.length(strip_space(F.coalesce(text, F.lit(""))))
    return (
        F.when(~F.coalesce(F.substring(head, 1, 5) == "%PDF-", F.lit(False)), "corrupted")
        .when(size == 0, "empty_text")
        .when(size < shortest, "short_text")
        .otherwise("ok")
    )


def null_sentinels(df: DataFrame, cols: Sequence[str], sentinels: Sequence[str] = INVALID_NAMES) -> DataFrame:
    """NULL for texts that mean missing, compared trimmed and without case."""
    known = [s.lower() for s in sentinels]
    return df.withColumns({c: F.when(~F.lower(F.trim(c)).isin(known), F.col(c)) for c in cols})


# Terminology folders hold these besides the data files.
SKIPPED_FILE_WORDS = ("changes", "stamp", "readme")


def data_file(name: str | Column, suffix: str = ".txt", skip: Sequence[str] = SKIPPED_FILE_WORDS) -> Column:
    """Data file by extension, without change lists, stamps and read-me files."""
    lower = F.lower(col(name))
    return reduce(lambda a, w: a & ~F.contains(lower, F.lit(w)), skip, lower.endswith(suffix))
