"""Classifications: drug classes, disease codes, observation codes."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.arrays import pack
from refloom.functions.codes import class_parent, code_level, code_range, split_axes
from refloom.functions.text import clean_text, link_target, safe_text, strip_title
from refloom.operators import pages
from refloom.operators.aggregate import attach_parts, build_tree, longest_wins, ordered_text
from refloom.operators.dedup import dedup_last
from refloom.operators.joins import leaf_flag
from refloom.operators.setops import union_levels
from refloom.operators.skew import GROUP_LIMIT
from refloom.session import materialize
from refloom.sources.delimited import fields, split_line

# Drug classes.


def class_links(class_pages: DataFrame) -> DataFrame:
    """Child class codes linked from pages: (page_id, code, level, name); links without a valid code are dropped."""
    links = pages.link_rows(class_pages)
    # Fixed value: the parameter of a class page's address that holds its code.
    code = F.upper(F.trim(F.regexp_extract("href", r"code=([^&]*)", 1)))
    rows = links.select("page_id", "pos", code.alias("code"), F.col("text").alias("name"))
    return rows.withColumn("level", code_level("code")).filter("level is not null")


def child_codes(links: DataFrame, page_codes: DataFrame) -> DataFrame:
    """Direct children named on the page of a class: (code, child)."""
    rows = links.withColumnRenamed("code", "child").join(page_codes.select("page_id", "code"), "page_id")
    direct = F.col("child").startswith(F.col("code")) & (F.col("level") == code_level("code") + 1)
    return rows.filter(direct & (code_level("code") < 4)).select("code", "child").distinct()


def classes(seen: DataFrame, order: str) -> DataFrame:
    """Classes collected from many pages: longest description, first known name, parent by prefix."""
    rows = seen.withColumn("code", F.regexp_replace("code", "[^A-Z0-9]", "")).filter(code_level("code") < 5)
    best = longest_wins(rows, ["code"], "description", "name", order)
    return best.select(
        "code", code_level("code").alias("level"), F.coalesce("name", F.lit("")).alias("name"),
        class_parent("code").alias("parent_code"), F.coalesce("description", F.lit("")).alias("description"),
    )


SUBSTANCE_COLUMNS = ["code", "name", "ddd", "unit", "adm_route", "note"]


def substances(class_pages: DataFrame) -> DataFrame:
    """Rows of substance tables: a full code in the first cell, at least two cells; later pages replace earlier ones."""
    rows = pages.grid_rows(pages.table_rows(class_pages)).filter(F.size("cells") >= 2)
    cells = F.transform("cells", lambda x: F.trim(F.replace(x, F.lit("\u00a0"), F.lit(""))))
    flat = rows.select(*pages.ROW, cells.alias("p")).select(*pages.ROW, *fields("p", SUBSTANCE_COLUMNS))
    flat = flat.filter(code_level("code") == 5).withColumn("parent_code", class_parent("code"))
    return dedup_last(flat, ["code"], pages.ROW).drop(*pages.ROW)


def full_table(known: DataFrame, leaves: DataFrame) -> DataFrame:
    """Classes and substances in one table, columns one side lacks empty."""
    return union_levels(known.withColumn("level", F.col("level").cast("string")), leaves.withColumn("level", F.lit("5")))


def tree(known: DataFrame, leaves: DataFrame) -> DataFrame:
    """Nested JSON of all five levels; a node without its parent is a root."""
    levels = [known.filter(F.col("level") == n).select("code", "parent_code", "name", "level", "description") for n in (1, 2, 3, 4)]
    leaf = leaves.select("code", "parent_code", "name", F.lit(5).alias("level"), "ddd", "unit", "adm_route", "note")
    return build_tree([*levels, leaf])


# Disease codes.


def disease_codes(blocks: DataFrame) -> DataFrame:
    """Codes of nested blocks with parent and leaf flag. ``blocks``: block_info, codes[]."""
    rows = blocks.select(F.col("block_info.id").alias("block_id"), F.col("block_info.chapter_id").alias("chapter_id"), F.explode("codes").alias("c"))
    packed = [pack(f"c.{name}", ";").alias(name) for name in ("inclusions", "exclusions", "hints")]
    flat = rows.select("c.code", F.col("c.title").alias("title"), F.col("c.class_kind").alias("class_kind"), "block_id", "chapter_id", *packed)
    return leaf_flag(flat).withColumn("parent_code", F.coalesce("parent_code", F.lit("")))


def disease_blocks(blocks: DataFrame) -> DataFrame:
    info = F.col("block_info")
    return blocks.select(
        info["id"].alias("block_id"), clean_text(info["title"]).alias("title"), info["code_range"].alias("code_range"),
        info["chapter_id"].alias("chapter_id"), *[pack(info[n], ";").alias(n) for n in ("inclusions", "exclusions", "notes")],
    )


def chapters(chapter_pages: DataFrame) -> DataFrame:
    """Chapter pages: title, code range and packed rubrics; a page with an oversized rubric goes on in further parts."""
    found = pages.rubric_elements(chapter_pages, "h1")
    heads = found.filter("tag = 'h1'").groupBy("page_id").agg(F.min_by("spaced", "seq").alias("title"))
    kinds = pages.rubric_lists(found).groupBy("page_id", "part").agg(
        *[F.max(F.when(F.col("kind") == k, F.col("texts"))).alias(k) for k in ("inclusions", "exclusions", "notes")]
    )
    return attach_parts(heads, ["page_id"], [kinds]).select(
        "page_id", "part", "title", code_range("title").alias("code_range"),
        *[F.coalesce(k, F.lit("")).alias(k) for k in ("inclusions", "exclusions", "notes")],
    )


# Cells of a linearised disease table, by position, and the output order.
LINEAR_CELLS = {
    "foundation_uri": 0, "linearization_uri": 1, "code": 2, "block_id": 3, "title": 4, "class_kind": 5,
    "depth_in_kind": 6, "is_residual": 7, "chapter_no": 8, "browser_link": 9, "is_leaf": 10,
    "coding_note": 17, "parent": 18,
}
LINEAR_COLUMNS = [
    "code", "title", "class_kind", "depth_in_kind", "is_residual", "chapter_no", "block_id", "foundation_uri",
    "linearization_uri", "browser_link", "is_leaf", "coding_note", "parent",
]


def linear_table(lines: DataFrame) -> DataFrame:
    """Tab separated disease table (column ``value``) to 13 columns; rows of fewer than five cells are dropped."""
    rows = lines.select(split_line("value", "\t").alias("p")).filter(F.size("p") >= 5)
    cells = {n: F.coalesce(F.get("p", F.lit(i)), F.lit("")) for n, i in LINEAR_CELLS.items()}
    cells["title"] = strip_title(cells["title"])
    cells["browser_link"] = link_target(cells["browser_link"])
    return rows.select(*[cells[n].alias(n) for n in LINEAR_COLUMNS])


# Observation codes.

# Words in a term, and the column it fills; the first rule that fits counts.
NAME_RULES = {"fully_specified_name": ["fully-specified name"], "short_name": ["short name"], "display_name": ["display name"]}
BASIC_RULES = {
    "class": ["class"], "type": ["type"], "first_released": ["first released"], "last_updated": ["last updated"],
    "order_obs": ["order vs."],
}
IDS = {"loinc-id": "loinc_num", "lcn": "long_common_name", "loinc-status": "status"}


def observations(code_pages: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """Observation code pages: names, axes, attributes, related names and units, by part."""
    once, shared = pages.by_page(code_pages)
    found = _observed(once, limit)
    joined = found if shared is None else found.unionByName(_observed_together(shared, limit).select(*found.columns))
    full = F.trim(F.regexp_replace(F.coalesce("fully_specified_name", F.lit("")), r"\u200b", ""))
    rest = ["short_name", "display_name", *BASIC_RULES, "related_names", "example_units"]
    return joined.select(
        "page_id", "part", *[safe_text(c).alias(c) for c in [*IDS.values(), "description"]], full.alias("fully_specified_name"),
        *split_axes(full), *[F.coalesce(c, F.lit("")).alias(c) for c in rest],
    )


CODE_TAGS = ["section", "span", "dl", "dt", "dd", "li", "tr", "td", "p"]
_TEXTS = pa.list_(pa.string())
_PAIR = pa.struct([("section", pa.string()), ("pos", pa.int32()), ("term", pa.string()), ("definition", pa.string())])


def _code_page(page: int | None, parser) -> Iterator[tuple]:
    """What a code page shows, in its order. A page without an id has its spans alone."""
    found = parser.found
    heads: dict[str, str] = {}
    sections: dict[int, str | None] = {}
    lists: dict[int, tuple[str | None, list[str], list[str]]] = {}
    related, about, units = [], [], {}
    for seq, (parent, tag, attrs, bits, _) in enumerate(found):
        if tag == "section":
            sections[seq] = attrs.get("id")
        elif tag == "dl":
            lists[seq] = sections.get(parent), [], []
        elif tag in ("dt", "dd") and parent in lists:
            lists[parent][1 if tag == "dt" else 2].append("".join(bits))
        elif tag == "span":
            heads.setdefault(attrs.get("id"), "".join(bits))
        elif tag == "tr" and sections.get(parent) == "example-units":
            units[seq] = None
        elif tag == "td" and parent in units:
            if units[parent] is None:
                units[parent] = "".join(bits)
        elif tag == "li" and sections.get(parent) == "related-names":
            related.append("".join(bits))
        elif tag == "p" and sections.get(parent) == "term-description" and attrs.get("itemprop") == "description":
            about.append("".join(bits))
    if not heads:
        return
    pairs = [
        {"section": section, "pos": pos, "term": term, "definition": definition}
        for section, terms, definitions in lists.values() for pos, (term, definition) in enumerate(zip(terms, definitions))
    ]
    rest = [related, about[0] if about else None, [u for u in units.values() if u is not None], pairs] if page is not None else [[], None, [], []]
    yield page, *[heads.get(i) for i in IDS], *rest


def _observed(code_pages: DataFrame, limit: int) -> DataFrame:
    """Observations of pages whose ids differ: all of a page is known where it is parsed."""
    heads = "".join(f"{name} string; " for name in IDS.values())
    ddl = f"page_id long; {heads}related array<string>; description string; units array<string>; pairs array<struct<section: string, pos: int, term: string, definition: string>>"
    kinds = [pa.int64(), *[pa.string()] * len(IDS), _TEXTS, pa.string(), _TEXTS, pa.list_(_PAIR)]
    found = pages.per_page(code_pages, CODE_TAGS, ddl, kinds, _code_page)

    def trimmed(name: str) -> Column:
        return F.filter(F.transform(name, lambda x: F.trim(x)), lambda x: x != "")

    def of_section(section: str, rules: dict[str, Sequence[str]]) -> Column:
        rows = F.filter("pairs", lambda x: x["section"] == section)
        return F.transform(rows, lambda x: F.struct(
            pages.first_rule(x["term"], rules).alias("rule"), x["pos"].alias("pos"), F.trim(x["definition"]).alias("value")
        ))

    found = found.withColumns({
        "related": trimmed("related"), "units": F.array_distinct(trimmed("units")),
        "_names": of_section("additional-names", NAME_RULES), "_basic": of_section("basic", BASIC_RULES),
    })
    parts = F.greatest(F.ceil(F.size("related") / limit), F.ceil(F.size("units") / limit), F.lit(1))
    found = found.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts.cast("long") - 1)))

    def last(rows: str, name: str) -> Column:
        fits = F.filter(rows, lambda x: x["rule"] == name)
        return F.array_max(F.transform(fits, lambda x: F.struct(x["pos"], x["value"])))["value"].alias(name)

    def joined(name: str, out: str) -> Column:
        some = F.slice(name, (F.col("part") * limit + 1).cast("int"), F.lit(limit))
        return F.when(F.size(some) > 0, F.array_join(some, "; ")).alias(out)

    return found.select(
        "page_id", "part", *[F.trim(c).alias(c) for c in IDS.values()], F.trim("description").alias("description"),
        *[last("_names", n) for n in NAME_RULES], *[last("_basic", n) for n in BASIC_RULES],
        joined("related", "related_names"), joined("units", "example_units"),
    )


def _observed_together(code_pages: DataFrame, limit: int) -> DataFrame:
    """The same out of pages that share ids: elements are brought together by page."""
    found = pages.parsed(code_pages, CODE_TAGS, columns=["seq", "parent", "tag", "attrs", "text"])
    spans = found.filter("tag = 'span'").withColumn("id", F.col("attrs")["id"])
    head = spans.groupBy("page_id").agg(*[
        F.min_by(F.trim("text"), F.when(F.col("id") == i, F.col("seq"))).alias(name) for i, name in IDS.items()
    ])
    pairs = materialize(pages.definition_lists(found), "pairs")
    names = pages.labelled_columns(pairs.filter("section = 'additional-names'"), ["page_id"], NAME_RULES, "term", "definition", "pos")
    basic = pages.labelled_columns(pairs.filter("section = 'basic'"), ["page_id"], BASIC_RULES, "term", "definition", "pos")
    sections = found.filter("tag = 'section'").select("page_id", F.col("seq").alias("parent"), F.col("attrs")["id"].alias("section"))
    inside = found.join(sections, ["page_id", "parent"])
    related = inside.filter("tag = 'li' and section = 'related-names' and trim(text) <> ''")
    related = ordered_text(related, ["page_id"], F.trim("text"), "; ", [F.col("seq")], "related_names", limit)
    about = inside.filter((F.col("tag") == "p") & (F.col("attrs")["itemprop"] == "description") & (F.col("section") == "term-description"))
    about = about.groupBy("page_id").agg(F.min_by(F.trim("text"), "seq").alias("description"))
    unit_rows = inside.filter("tag = 'tr' and section = 'example-units'").select("page_id", F.col("seq").alias("parent"))
    units = found.filter("tag = 'td'").join(unit_rows, ["page_id", "parent"])
    units = units.groupBy("page_id", "parent").agg(F.min_by(F.trim("text"), "seq").alias("unit")).filter("unit <> ''")
    units = units.groupBy("page_id", "unit").agg(F.min("parent").alias("at"))
    units = ordered_text(units, ["page_id"], F.col("unit"), "; ", [F.col("at")], "example_units", limit)
    joined = head
    for table in (names, basic, about):
        joined = joined.join(table, "page_id", "left")
    return attach_parts(joined, ["page_id"], [related, units])
