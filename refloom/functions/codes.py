"""Code systems, dates and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refloom.functions.text import col, let

# Shape of a classification code at each of its five levels.
LEVEL_PATTERNS = {
    1: r"^[A-Z]$",
    2: r"^[A-Z]\d{2}$",
    3: r"^[A-Z]\d{2}[A-Z]$",
    4: r"^[A-Z]\d{2}[A-Z]{2}$",
    5: r"^[A-Z]\d{2}[A-Z]{2}\d{2}$",
}
# Characters of the parent code at each level.
PARENT_WIDTH = {2: 1, 3: 3, 4: 4, 5: 5}

# Month names, full names before short ones; the first name found in the text counts.
MONTHS = {
    "january": "01", "february": "02", "march": "03", "april": "04",
    "may": "05", "june": "06", "july": "07", "august": "08",
    "september": "09", "october": "10", "november": "11", "december": "12",
    "jan": "01", "feb": "02", "mar": "03", "apr": "04", "jun": "06",
    "jul": "07", "aug": "08", "sep": "09", "oct": "10", "nov": "11", "dec": "12",
}

# Role of a product in a safety report.
ROLE_LABELS = {"1": "Suspect", "2": "Concomitant", "3": "Interacting"}

# Axes of a fully specified observation name, in order.
NAME_AXES = ("component", "property", "time_aspect", "system", "scale_type", "method_type")


def iso_date(c: Column | str) -> Column:
    """``YYYYMMDD`` to ``YYYY-MM-DD`` by slicing; any other length is left alone."""
    raw = col(c)
    cut = F.concat_ws("-", F.substring(raw, 1, 4), F.substring(raw, 5, 2), F.substring(raw, 7, 2))
    return F.when(F.length(raw) == 8, cut).otherwise(raw)


def month_year(c: Column | str) -> Column:
    """``YYYY-MM`` from free text; month ``00`` when no name is found, ``unknown`` without a year."""
    text = F.lower(F.trim(col(c)))
    # The first word with exactly four digits in it.
    word = F.regexp_extract(text, r"(?:^|\s)((?:[^\d\s]*\d){4}[^\d\s]*)(?=\s|$)", 1)
    year = F.regexp_replace(word, r"\D", "")

    def month(t: Column) -> Column:
        expr = None
        for name, number in MONTHS.items():
            found = F.contains(t, F.lit(name))
            expr = F.when(found, number) if expr is None else expr.when(found, number)
        return expr.otherwise("00")

    return F.when(year != "", F.concat(year, F.lit("-"), let(text, month))).otherwise("unknown")


def code_level(c: Column | str) -> Column:
    """Level 1-5 of a classification code, NULL when it has no valid shape."""
    expr = None
    for level, pattern in LEVEL_PATTERNS.items():
        hit = col(c).rlike(pattern)
        expr = F.when(hit, level) if expr is None else expr.when(hit, level)
    return expr


def class_parent(c: Column | str) -> Column:
    """Parent classification code by prefix; ``''`` at level 1, NULL for no valid code."""
    level = code_level(c)
    expr = F.when(level == 1, F.lit(""))
    for at, width in PARENT_WIDTH.items():
        expr = expr.when(level == at, F.substring(col(c), 1, width))
    return expr


def dotted_parent(c: Column | str) -> Column:
    """Parent of a dotted code: ``A00.01`` to ``A00.0`` to ``A00``; NULL above."""
    code = col(c)
    stem, tail = F.split_part(code, F.lit("."), F.lit(1)), F.split_part(code, F.lit("."), F.lit(2))
    dotted = (F.length(code) > 3) & F.contains(code, F.lit("."))
    shorter = F.concat(stem, F.lit("."), F.left(tail, F.length(tail) - 1))
    return F.when(dotted & (F.length(tail) == 1), stem).when(dotted & (F.length(tail) > 1), shorter)


def code_range(c: Column | str) -> Column:
    """``A00-B99`` out of a title such as ``Diseases (A00-B99)``; ``''`` if absent."""
    return F.regexp_extract(col(c), r"\(([A-Z][0-9]{2}-[A-Z][0-9]{2})\)", 1)


def split_axes(c: Column | str, sep: str = ":") -> list[Column]:
    """Six named axes of a fully specified name; missing axes are ``''``."""
    parts = F.split(F.trim(F.regexp_replace(col(c), r"\u200b", "")), sep)
    return [
        F.coalesce(F.trim(F.get(parts, F.lit(i))), F.lit("")).alias(name)
        for i, name in enumerate(NAME_AXES)
    ]


def code_label(c: Column | str, labels: dict[str, str], default: str = "Unknown") -> Column:
    """Label of a short code out of a small fixed map."""
    expr = None
    for code, label in labels.items():
        hit = col(c) == code
        expr = F.when(hit, label) if expr is None else expr.when(hit, label)
    return expr.otherwise(default)


def record_kind(c: Column | str) -> Column:
    """Kind of a substance record from the first letter of its id."""
    return F.when(col(c).startswith("D"), "Descriptor").otherwise("Supplemental")


def numeric_id(c: Column | str) -> Column:
    """Identifier as integer; NULL for anything that is not one."""
    return F.when(F.trim(col(c)).rlike(r"^\d+$"), F.trim(col(c)).try_cast("bigint"))


def registration_type(c: Column | str) -> Column:
    """``Prospective`` / ``Retrospective`` / ``Unknown`` from a registration note."""
    text = F.lower(col(c))
    return (
        F.when(F.contains(text, F.lit("prospectively")), "Prospective")
        .when(F.contains(text, F.lit("retrospectively")), "Retrospective")
        .otherwise("Unknown")
    )


def all_matches(c: Column | str, pattern: str, group: int = 0) -> Column:
    """Every match of a pattern in the whole text."""
    return F.regexp_extract_all(col(c), F.lit(pattern), F.lit(group))
