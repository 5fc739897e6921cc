"""Text clean-up, naming and formatting expressions."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space in Unicode, as the inside of a Java regex class and as plain text.
SPACE = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CHARS = "".join(
    chr(c) for a, b in (
        (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
        (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
    ) for c in range(a, b + 1)
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill(template: str, *values: Column) -> Column:
    """Text with each ``%s`` replaced by a column; NULL if any of them is. (``format_string`` is far slower.)"""
    pieces = template.split("%s")
    parts = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:], strict=True):
        parts += [value, F.lit(piece)] if piece else [value]
    return F.concat(*parts)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def clean_text(c: Column | str) -> Column:
    """Any run of white space (non-breaking space and line ends too) becomes one space; ends trimmed.

    The pattern passes over single plain spaces, which are most of them.
    """
    return F.trim(F.regexp_replace(col(c), f"[{SPACE}&&[^ ]][{SPACE}]*| [{SPACE}]+", " "))


def clean(text: str) -> str:
    """``clean_text`` of one text. What ``split`` takes for white space is what ``SPACE`` holds."""
    return " ".join(text.split())


def strip_space(c: Column | str) -> Column:
    """Trim all Unicode white space at both ends."""
    return F.trim(col(c), F.lit(SPACE_CHARS))


def blank_to_null(c: Column | str) -> Column:
    return F.when(strip_space(c) != "", col(c))


def safe_text(c: Column | str) -> Column:
    """Text of any scalar, trimmed, with ``''`` for a missing value."""
    return F.coalesce(strip_space(col(c).cast("string")), F.lit(""))


def clean_name(name: str) -> str:
    """Header text as a lower snake case identifier (driver-side, names only)."""
    return re.sub(r"_+", "_", re.sub(r"[^a-z0-9]", "_", str(name).lower())).strip("_")


def slugify(c: Column | str) -> Column:
    """Safe file name: illegal characters dropped, white space to ``_``, 80 characters at most."""
    raw = col(c)
    bare = F.regexp_replace(raw, r'[\\/*?:"<>|]', "")
    slug = F.substring(F.trim(F.regexp_replace(bare, f"[{SPACE}]+", "_"), F.lit("_")), 1, 80)
    return F.when(F.coalesce(raw, F.lit("")) == "", F.lit("unnamed")).otherwise(slug)


def document_file_name(product: Column, kind: Column, licence: Column, original: Column) -> Column:
    """``PRODUCT_LICENCE_kind.ext`` with empty parts left out and the extension kept when known."""
    name = F.regexp_replace(F.upper(F.trim(product)), r"[^a-zA-Z0-9\s_\-]", "")
    name = F.substring(F.regexp_replace(name, r"\s+", "_"), 1, 80)
    number = F.regexp_replace(licence, r"[^a-zA-Z0-9]", "")
    ext = F.regexp_extract(original, r"(?i)(\.(?:pdf|txt|docx?))$", 1)
    stem = F.concat_ws("_", F.nullif(name, F.lit("")), F.nullif(number, F.lit("")), F.lower(kind))
    return F.concat(stem, F.coalesce(F.nullif(ext, F.lit("")), F.lit(".pdf")))


def strip_zeros(c: Column | str) -> Column:
    """Drop leading zeros of an identifier."""
    return F.ltrim(F.trim(col(c)), F.lit("0"))


def with_detail(name: Column, detail: Column, left: str = " (", right: str = ")") -> Column:
    """``name (detail)``, or the bare name when there is no detail."""
    bare = F.coalesce(name, F.lit(""))
    text = F.coalesce(detail, F.lit(""))
    return F.when(text != "", F.concat(bare, F.lit(left), text, F.lit(right))).otherwise(bare)


def patent_detail(number: Column, expires: Column, use_code: Column, use_text: Column) -> Column:
    head = fill("Patent %s (Exp: %s)", safe_text(number), safe_text(expires))
    use = fill(" [Use: %s - %s]", safe_text(use_code), safe_text(use_text))
    return F.concat(head, F.when(safe_text(use_code) != "", use).otherwise(""))


def exclusivity_detail(code: Column, expires: Column, text: Column) -> Column:
    head = fill("Exclusivity %s (Exp: %s)", safe_text(code), safe_text(expires))
    return F.concat(head, F.when(safe_text(text) != "", fill(" [%s]", safe_text(text))).otherwise(""))


def grant_detail(agency: Column, grant_id: Column, acronym: Column) -> Column:
    """``Agency (ID: x, Acronym: y)``; the acronym shows only next to an id."""
    tail = F.when(safe_text(acronym) != "", F.concat(F.lit(", Acronym: "), acronym)).otherwise("")
    ids = F.when(safe_text(grant_id) != "", F.concat(F.lit(" (ID: "), grant_id, tail, F.lit(")"))).otherwise("")
    return F.concat(F.coalesce(agency, F.lit("Unknown Agency")), ids)


def truncate(c: Column | str, size: int = 30_000) -> Column:
    """Cut text to a declared budget."""
    return F.substring(col(c), 1, size)


# Page budgets by document kind; an overview is never cut.
PAGE_BUDGET = {"product-information": 15, "assessment-report": 30}
OTHER_PAGE_BUDGET = 10


def page_budget(kind: Column, pages: Column) -> Column:
    """The first pages of a document, as many as its kind is granted."""
    budget = F.when(kind == "overview", F.size(pages))
    for name, cap in PAGE_BUDGET.items():
        budget = budget.when(kind == name, F.lit(cap))
    return F.slice(pages, 1, budget.otherwise(F.lit(OTHER_PAGE_BUDGET)))


def strip_title(c: Column | str) -> Column:
    """Drop the leading dashes that mark depth in an indented title list."""
    return F.trim(F.regexp_replace(col(c), r"^[-\s]+", ""))


def link_target(c: Column | str) -> Column:
    """URL inside a spreadsheet ``hyperlink`` cell, else the cell."""
    raw = F.trim(col(c))
    url = F.regexp_extract(raw, r'https?://[^\s"]+', 0)
    return F.when(F.contains(raw, F.lit("hyperlink")) & (url != ""), url).otherwise(raw)


def reply_json(c: Column | str) -> Column:
    """JSON object text of a model reply: reasoning block dropped, outermost braces kept; NULL if none."""
    bare = F.regexp_replace(col(c), r"(?s)<think>.*?</think>", "")
    return F.nullif(F.regexp_extract(bare, r"(?s)\{.*\}", 0), F.lit(""))


def reply_status(c: Column | str) -> Column:
    """``completed`` for a reply that holds a JSON object, ``failed`` otherwise."""
    parsed = F.try_parse_json(reply_json(c))
    return F.when(parsed.isNotNull(), F.lit("completed")).otherwise(F.lit("failed"))
