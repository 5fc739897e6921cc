"""Expressions over arrays, arrays of structs and packed lists. No explode, no shuffle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from refloom.functions.text import col, let, strip_space


def unpack(c: Column | str, sep: str) -> Column:
    """Packed text to array: parts trimmed, empty parts dropped."""
    parts = F.split(col(c), f"\\Q{sep}\\E")
    return F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != "")


def pack(c: Column | str, sep: str) -> Column:
    """Array to packed text, NULL and empty items left out; ``''`` for no items."""
    items = F.filter(col(c), lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_join(items, sep), F.lit(""))


def names(arr: Column | str, field: str = "display_name") -> Column:
    """Non-empty trimmed values of one field of an array of structs."""
    picked = F.transform(col(arr), lambda x: strip_space(x[field].cast("string")))
    return F.filter(picked, lambda x: x.isNotNull() & (x != ""))


def distinct_ordered(arr: Column | str) -> Column:
    """Distinct items, first occurrence order."""
    return F.array_distinct(col(arr))


def synonyms(arr: Column | str, preferred: Column | str, sort: bool = True) -> Column:
    """Distinct non-empty names other than the preferred one, compared without case."""
    kept = F.array_distinct(
        F.filter(
            F.transform(col(arr), lambda x: strip_space(x)),
            lambda x: x.isNotNull() & (x != "") & (F.lower(x) != F.lower(F.coalesce(col(preferred), F.lit("")))),
        )
    )
    return F.array_sort(kept) if sort else kept


def where(arr: Column | str, test: Callable[[Column], Column], field: str) -> Column:
    """One field of those structs that pass a test, empty values left out."""
    return names(F.filter(col(arr), test), field)


def first_where(arr: Column | str, test: Callable[[Column], Column], field: str) -> Column:
    """One field of the first struct that passes a test, else NULL."""
    return F.get(F.filter(col(arr), test), F.lit(0))[field]


def last_where(arr: Column | str, test: Callable[[Column], Column], field: str) -> Column:
    """One field of the last struct that passes a test, else NULL."""
    return F.get(F.reverse(F.filter(col(arr), test)), F.lit(0))[field]


def lookup(arrays: list[Column], kind: str, key: str = "kind", value: str = "value") -> Column:
    """Value stored under a kind: the last entry of the first list, else the first non-empty one of the others, in their order."""
    found = [F.nullif(last_where(arrays[0], lambda x: x[key] == kind, value), F.lit(""))]
    found += [first_where(a, lambda x: (x[key] == kind) & (x[value] != ""), value) for a in arrays[1:]]
    return F.coalesce(*found, F.lit(""))


def first_of_first(authorships: Column | str) -> Column:
    """First non-empty institution name of the first author, ``''`` if none."""
    first = F.get(col(authorships), F.lit(0))
    return F.coalesce(F.get(names(first["institutions"]), F.lit(0)), F.lit(""))


def heading_terms(arr: Column | str, major_only: bool = False) -> Column:
    """Distinct ``descriptor/qualifier`` terms in order; a missing qualifier leaves the descriptor."""
    rows = F.filter(col(arr), lambda m: F.coalesce(m["descriptor_name"], F.lit("")) != "")
    if major_only:
        rows = F.filter(rows, lambda m: F.coalesce(m["is_major_topic"], F.lit(False)))
    return F.array_distinct(
        F.transform(
            rows,
            lambda m: F.when(
                F.coalesce(m["qualifier_name"], F.lit("")) != "",
                F.concat(m["descriptor_name"], F.lit("/"), m["qualifier_name"]),
            ).otherwise(m["descriptor_name"]),
        )
    )


def rebuild_text(index: Column | str) -> Column:
    """Text from an inverted index (word to positions); gaps become empty words.

    Entries are turned into one sorted run of (position, word) pairs, so the work is
    n log n in the text length. Two words at one position: the later entry counts.
    """
    entries = F.map_entries(col(index))
    pairs = F.flatten(
        F.transform(
            entries,
            lambda e, i: F.transform(
                F.filter(e["value"], lambda p: p >= 0),
                lambda p: F.struct(p.alias("p"), i.alias("i"), e["key"].alias("w")),
            ),
        )
    )
    def place(run: Column) -> Column:
        """The last entry at each position."""
        after = F.slice(run, 2, F.greatest(F.size(run), F.lit(1)))
        last = F.zip_with(run, after, lambda x, nxt: F.when(~x["p"].eqNullSafe(nxt["p"]), x))
        return F.filter(last, lambda x: x.isNotNull())

    def spell(kept: Column) -> Column:
        """Each word behind the gap to the word before it."""
        before = F.concat(F.array(F.lit(None).cast("int")), F.transform(kept, lambda x: x["p"].cast("int")))
        words = F.zip_with(
            kept,
            before,
            lambda x, prev: F.concat(
                F.when(prev.isNull(), F.lit("")).otherwise(F.repeat(F.lit(" "), x["p"].cast("int") - prev)), x["w"]
            ),
        )
        return F.array_join(words, "")

    text = let(F.sort_array(pairs), lambda run: let(place(run), spell))
    return F.coalesce(strip_space(text), F.lit(""))


def text_list(c: Column | str) -> Column:
    """List out of a field that holds a JSON list or one plain text; items trimmed, empty ones dropped."""
    raw = col(c)
    parsed = F.when(raw.startswith("["), F.from_json(raw, "array<string>"))
    items = F.coalesce(parsed, F.array(raw))
    kept = F.filter(F.transform(items, lambda x: strip_space(x)), lambda x: x.isNotNull() & (x != ""))
    return F.when(raw.isNotNull(), kept)
