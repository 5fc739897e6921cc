"""Trial registries: XML documents, flattened page records, line records."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refloom.functions.arrays import last_where, pack
from refloom.functions.codes import registration_type
from refloom.functions.text import clean, clean_text, let, safe_text
from refloom.operators import pages
from refloom.operators.aggregate import ordered_list, union_columns
from refloom.operators.dedup import dedup_last, suffix_duplicates
from refloom.operators.records import FIRST_COLUMNS, fields_to_records, lines_to_fields
from refloom.operators.select import LIST_SENTINELS
from refloom.operators.skew import GROUP_LIMIT
from refloom.schemas import (
    REGISTRY_TRIAL_COLUMNS, TRIAL_CONTACT_FIELDS, TRIAL_CRITERIA_FIELDS, TRIAL_ETHICS_FIELDS, TRIAL_MAIN_FIELDS,
)
from refloom.session import materialize


def _struct(fields: list[str]) -> str:
    return "struct<" + ", ".join(f"{f}: string" for f in fields) + ">"


NATIONAL_TRIAL = f"""
    main {_struct(TRIAL_MAIN_FIELDS)},
    contacts struct<contact: array<{_struct(["type", *TRIAL_CONTACT_FIELDS])}>>,
    countries struct<country2: array<string>>, criteria {_struct(TRIAL_CRITERIA_FIELDS)},
    health_condition_code struct<hc_code: string>, health_condition_keyword struct<hc_keyword: array<string>>,
    intervention_code struct<i_code: string>, intervention_keyword struct<i_keyword: array<string>>,
    primary_outcome struct<prim_outcome: string>, secondary_outcome struct<sec_outcome: string>,
    secondary_sponsor struct<sponsor_name: string>, source_support struct<source_name: string>,
    ethics_reviews struct<ethics_review: array<{_struct(TRIAL_ETHICS_FIELDS)}>>
"""
REGISTRY_TRIAL = ", ".join(f"{c} string" for c in REGISTRY_TRIAL_COLUMNS)


def _texts(array: str) -> Column:
    return pack(F.transform(array, lambda x: F.trim(x)), " | ")


def national(raw: DataFrame) -> DataFrame:
    """Flat national trial rows; for each kind of contact the last one counts."""
    def contact(kind: str, field: str) -> Column:
        # A contact that is named for both kinds counts as scientific.
        def fits(c):
            scientific = F.contains(F.lower(c["type"]), F.lit("scientific"))
            return scientific if kind == "scientific" else ~scientific & F.contains(F.lower(c["type"]), F.lit("public"))

        return safe_text(last_where("contacts.contact", fits, field)).alias(f"{kind}_contact_{field}")

    single = {
        "hc_code": "health_condition_code.hc_code", "i_code": "intervention_code.i_code",
        "prim_outcome": "primary_outcome.prim_outcome", "sec_outcome": "secondary_outcome.sec_outcome",
        "secondary_sponsor": "secondary_sponsor.sponsor_name", "source_support": "source_support.source_name",
    }
    review = F.get("ethics_reviews.ethics_review", F.lit(0))
    return raw.select(
        *[safe_text(f"main.{c}").alias(c) for c in TRIAL_MAIN_FIELDS],
        *[contact(kind, c) for kind in ("scientific", "public") for c in TRIAL_CONTACT_FIELDS],
        _texts("countries.country2").alias("countries"),
        *[safe_text(f"criteria.{c}").alias(c) for c in TRIAL_CRITERIA_FIELDS],
        *[safe_text(src).alias(out) for out, src in single.items()],
        _texts("health_condition_keyword.hc_keyword").alias("hc_keyword"),
        _texts("intervention_keyword.i_keyword").alias("i_keyword"),
        *[safe_text(review[c]).alias(f"ethics_{c}") for c in TRIAL_ETHICS_FIELDS],
    )


def registry(raw: DataFrame) -> DataFrame:
    """The declared columns of a multi-country export, trimmed; undeclared tags are dropped."""
    return raw.select(*[safe_text(c).alias(c) if c in raw.columns else F.lit("").alias(c) for c in REGISTRY_TRIAL_COLUMNS])


def line_records(lines: DataFrame) -> DataFrame:
    """Records of label lines as a flat table with one column per label seen."""
    records = fields_to_records(lines_to_fields(lines))
    return union_columns(records, "fields", ["file", "record", "part"], FIRST_COLUMNS)


def grid_records(trial_pages: DataFrame) -> DataFrame:
    """(page_id, label, value) of trial pages made of grids; labels are unique per page.

    Plain labels that come again with another value get a number; of section labels the last counts.
    """
    once, shared = pages.by_page(trial_pages)
    found = pages.page_fields(once)
    return found if shared is None else found.unionByName(_grid_across_pages(shared))


def _grid_across_pages(trial_pages: DataFrame) -> DataFrame:
    """The same out of pages that share ids: rows are brought together by page."""
    fields = materialize(pages.grid_fields(pages.table_rows(trial_pages)), "fields")
    place = ["table_no", "row_no"]
    plain = suffix_duplicates(fields.filter("plain"), ["page_id"], "label", "value", place)
    fixed = dedup_last(fields.filter("not plain"), ["page_id", "label"], place)
    return plain.unionByName(fixed).select("page_id", "label", "value")


# Labels of a trial page by the kind of table they hold.
KEY_VALUE_LABELS = (
    "details_of_principal_investigator_or_overall_trial_coordinator_multicenter_study",
    "details_of_contact_person_scientific_query", "details_of_contact_person_public_query", "primary_sponsor",
    "inclusion_criteria", "exclusion_criteria",
)
HEADER_LABELS = (
    "secondary_ids_if_any", "details_of_secondary_sponsor", "sites_of_study", "details_of_ethics_committee",
    "regulatory_clearance_status_from_dcgi", "intervention_comparator_agent", "primary_outcome", "secondary_outcome",
    "health_condition_problems_studied",
)
LIST_LABELS = ("source_of_monetary_or_material_support",)
TRIAL_NUMBER = r"CTRI/\d{4}/\d{2}/\d+"
REGISTERED_ON = r"\[Registered on:\s*([^\]]+)\]"


def plain_label(label: Column) -> Column:
    """Label of a page row as a name; spellings of one label are brought together."""
    # The name takes several expressions to make; it is made once and then looked at.
    return let(pages.header_name(label), lambda name: (
        F.when(F.contains(name, F.lit("contact_person")) & F.contains(name, F.lit("scientific")), KEY_VALUE_LABELS[1])
        .when(F.contains(name, F.lit("contact_person")) & F.contains(name, F.lit("public")), KEY_VALUE_LABELS[2])
        .when(name == "exclusioncriteria", F.lit("exclusion_criteria"))
        .when(F.contains(name, F.lit("health_condition")), F.lit("health_condition_problems_studied"))
        .when(name == "intervention__comparator_agent", F.lit("intervention_comparator_agent"))
        .otherwise(name)
    ))


def label_name(text: str) -> str:
    """``plain_label`` of one text."""
    name = pages.field_name(text)
    if "contact_person" in name and "scientific" in name:
        return KEY_VALUE_LABELS[1]
    if "contact_person" in name and "public" in name:
        return KEY_VALUE_LABELS[2]
    if name == "exclusioncriteria":
        return "exclusion_criteria"
    if "health_condition" in name:
        return "health_condition_problems_studied"
    return "intervention_comparator_agent" if name == "intervention__comparator_agent" else name


def _valid(trial_pages: DataFrame) -> DataFrame:
    """Pages with content that is not ``INVALID``."""
    return trial_pages.filter(F.trim(F.coalesce("html", F.lit(""))).isin("", "INVALID") == F.lit(False))


def page_tables(trial_pages: DataFrame) -> DataFrame:
    """Tables, rows and cells of trial pages with their grid, parsed once. Pages whose content is ``INVALID`` give none."""
    return pages.parsed(_valid(trial_pages), ["table", "tr", "td", "th"], grid=True)


def page_rows(found: DataFrame) -> DataFrame:
    """Label rows of the main table out of ``page_tables``: (page_id, row_no, label, text, table_no of a nested table)."""
    tables = found.filter("tag = 'table'").select(
        "page_id", "seq", "parent", (F.row_number().over(Window.partitionBy("page_id").orderBy("seq")) - 1).alias("table_no")
    )
    border = F.coalesce(F.col("attrs")["border"], F.lit("")) == "1"
    grey = F.coalesce(F.col("attrs")["bordercolor"], F.lit("")) == "lightgrey"
    mains = found.filter((F.col("tag") == "table") & (border | grey)).groupBy("page_id").agg(
        F.min_by("seq", F.struct((~grey).alias("last"), "seq")).alias("main")
    )
    rows = found.filter("tag = 'tr'").select("page_id", F.col("seq").alias("tr"), F.col("parent").alias("main"))
    rows = rows.join(mains, ["page_id", "main"])
    cells = found.filter("tag = 'td'").select("page_id", F.col("parent").alias("tr"), "seq", "text").join(rows, ["page_id", "tr"])
    pairs = cells.groupBy("page_id", "tr").agg(F.sort_array(F.collect_list(F.struct("seq", "text"))).alias("c")).filter(F.size("c") == 2)
    # A generated row: the filter on the label comes after it is made and does not make it again.
    pairs = pairs.select("page_id", F.col("tr").alias("row_no"), F.explode(F.array(F.struct(
        plain_label(F.col("c")[0]["text"]).alias("label"), clean_text(F.col("c")[1]["text"]).alias("text"), F.col("c")[1]["seq"].alias("parent"),
    ))).alias("r"))
    pairs = pairs.select("page_id", "row_no", "r.*").filter("label <> ''")
    inner = tables.groupBy("page_id", "parent").agg(F.min("table_no").alias("table_no"))
    return pairs.join(inner, ["page_id", "parent"], "left").drop("parent")


def page_records(trial_pages: DataFrame) -> DataFrame:
    """(page_id, label, value) of trial pages: text, or JSON for the tables inside.

    Contact-like tables give an object, tables with a header a list of objects, lists a list of texts.
    """
    found = page_tables(trial_pages)
    rows = materialize(page_rows(found), "rows")
    cells = pages.grid_cells(found)
    at = ["page_id", "table_no"]
    nested = rows.filter("table_no is not null").select(*at, "label")
    listed = F.col("label").isin(*LIST_LABELS)
    headed = F.col("label").isin(*HEADER_LABELS)

    pairs = pages.key_value_rows(cells.join(nested.filter(~listed & ~headed).select(*at), at, "left_semi"))
    pairs = dedup_last(pairs, [*at, "label"], ["row_no"])
    objects = ordered_list(pairs, at, F.struct(F.col("label").alias("key"), "value"), ["row_no"], "kv")
    objects = objects.select(*at, "part", F.to_json(F.map_from_entries("kv")).alias("value"))
    records = pages.table_records(cells.join(nested.filter(headed).select(*at), at, "left_semi"))
    records = ordered_list(records, at, F.to_json("fields"), ["row_no"], "f")
    records = records.select(*at, "part", F.concat(F.lit("["), F.array_join("f", ","), F.lit("]")).alias("value"))
    items = pages.simple_list(cells.join(nested.filter(listed).select(*at), at, "left_semi"), LIST_SENTINELS)
    items = ordered_list(items, at, F.col("text"), ["row_no", "col_no"], "l").select(*at, "part", F.to_json("l").alias("value"))

    inner = nested.join(objects.unionByName(records).unionByName(items), at).select("page_id", "label", "part", "value")
    plain = rows.filter("table_no is null").select("page_id", "label", F.lit(0).cast("long").alias("part"), F.col("text").alias("value"))
    numbers = plain.filter("label = 'ctri_number'")
    text = F.col("value")
    derived = numbers.select("page_id", "part", F.inline(_derived(text))).withColumnRenamed("key", "label").filter("value <> ''")
    return inner.unionByName(plain).unionByName(derived)


def _derived(number: Column) -> Column:
    """What the text of a trial number tells besides: key and value, empty if it doesn't."""
    return F.array(
        F.struct(F.lit("registration_date").alias("key"), F.trim(F.regexp_extract(number, REGISTERED_ON, 1)).alias("value")),
        F.struct(F.lit("registration_type").alias("key"), registration_type(number).alias("value")),
        F.struct(F.lit("ctri_id").alias("key"), F.regexp_extract(number, TRIAL_NUMBER, 0).alias("value")),
    )


#: Characters that Spark's JSON writer escapes.
_ESCAPES = {c: f"\\u{c:04X}" for c in range(32)} | {ord(c): "\\" + e for c, e in zip('"\\\b\t\n\f\r', '"\\btnfr')}


_ESCAPED = re.compile(r'["\\\x00-\x1f]')


def _json(text: str) -> str:
    return '"' + (text.translate(_ESCAPES) if _ESCAPED.search(text) else text) + '"'


def _json_object(fields: Iterable[tuple[str, str]]) -> str:
    return "{" + ",".join([f"{_json(k)}:{_json(v)}" for k, v in fields]) + "}"


def _nested(label: str, rows: Sequence[tuple[int, list[str]]], limit: int) -> Iterator[str]:
    """JSON of a table under a label, in parts of at most ``limit`` items."""
    if label in LIST_LABELS:
        items = [_json(x) for _, cells in rows for cell in cells if (x := clean(cell)) and x not in LIST_SENTINELS]
    elif label in HEADER_LABELS:
        items = [_json_object(fields.items()) for fields in pages.fielded_rows(rows)]
    else:
        pairs = list(pages.key_values(rows).items())
        yield from (_json_object(pairs[at : at + limit]) for at in range(0, len(pairs), limit))
        return
    yield from ("[" + ",".join(items[at : at + limit]) + "]" for at in range(0, len(items), limit))


def _whole_records(trial_pages: DataFrame, limit: int = GROUP_LIMIT) -> DataFrame:
    """(page_id, part, kv) of pages whose ids differ: the last value of each label, in order, all made where a page is parsed."""
    def records(page: int | None, parser) -> Iterator[tuple]:
        found = parser.found
        parts, numbers = defaultdict(list), []
        mains, inner, heads, cells = [], {}, set(), {}
        grids = pages._grids(found)
        for seq, (parent, tag, attrs, _, _) in enumerate(found):
            if tag == "table":
                inner.setdefault(parent, seq)
                grey = attrs.get("bordercolor", "") == "lightgrey"
                if grey or attrs.get("border", "") == "1":
                    mains.append((not grey, seq))
        if not mains:
            return
        main = min(mains)[1]
        for seq, (parent, tag, *_) in enumerate(found):
            if tag == "tr" and parent == main:
                heads.add(seq)
            elif tag == "td" and parent in heads:
                cells.setdefault(parent, []).append(seq)
        for pair in cells.values():
            if len(pair) != 2 or not (label := label_name("".join(found[pair[0]][3]))):
                continue
            if pair[1] in inner:
                rows = pages.filled_rows(found, grids[inner[pair[1]]][1])
                for part, value in enumerate(_nested(label, rows, limit)):
                    parts[part].append({"key": label, "value": value})
            else:
                text = clean("".join(found[pair[1]][3]))
                parts[0].append({"key": label, "value": text})
                if label == "ctri_number":
                    numbers.append(text)
        for part, entries in parts.items():
            yield page, part, entries, [] if part else numbers

    entry = pa.struct([("key", pa.string()), ("value", pa.string())])
    ddl = "page_id long; part long; entries array<struct<key: string, value: string>>; numbers array<string>"
    kinds = [pa.int64(), pa.int64(), pa.list_(entry), pa.list_(pa.string())]
    found = pages.per_page(_valid(trial_pages).filter("page_id is not null"), ["table", "tr", "td", "th"], ddl, kinds, records, ["td", "th"])
    derived = F.filter(F.flatten(F.transform("numbers", _derived)), lambda x: x["value"] != "")
    found = found.select("page_id", "part", F.sort_array(F.concat("entries", derived)).alias("e"))
    # Of equal labels the last value in order stays.
    return found.select("page_id", "part", F.filter("e", lambda x, i: ~F.coalesce(F.get("e", i + 1)["key"] == x["key"], F.lit(False))).alias("kv"))


# Flat columns of a trial record. Plain fields, fields of nested objects, lists kept as JSON.
RECORD_FIELDS = [
    "db_id", "ctri_id", "ctri_number", "registration_date", "registration_type", "last_modified_on",
    "post_graduate_thesis", "type_of_trial", "type_of_study", "study_design", "public_title_of_study",
    "scientific_title_of_study", "trial_acronym", "countries_of_recruitment",
    "method_of_generating_random_sequence", "method_of_concealment", "blindingmasking", "target_sample_size",
]
PERSON = ["name", "designation", "affiliation", "address", "phone", "email"]
RECORD_OBJECTS = {
    "pi": (KEY_VALUE_LABELS[0], PERSON),
    "contact_scientific": (KEY_VALUE_LABELS[1], PERSON),
    "contact_public": (KEY_VALUE_LABELS[2], PERSON),
}
RECORD_OBJECT_FIELDS = {
    "primary_sponsor_name": ("primary_sponsor", "name"),
    "primary_sponsor_address": ("primary_sponsor", "address"),
    "primary_sponsor_type": ("primary_sponsor", "type_of_sponsor"),
    "inclusion_age_from": ("inclusion_criteria", "age_from"),
    "inclusion_age_to": ("inclusion_criteria", "age_to"),
    "inclusion_gender": ("inclusion_criteria", "gender"),
    "inclusion_details": ("inclusion_criteria", "details"),
    "exclusion_details": ("exclusion_criteria", "details"),
}
RECORD_LISTS = {
    "secondary_ids": "secondary_ids_if_any",
    "source_of_monetary_support": "source_of_monetary_or_material_support",
    "secondary_sponsors": "details_of_secondary_sponsor",
    "sites_of_study": "sites_of_study",
    "ethics_committees": "details_of_ethics_committee",
    "regulatory_clearance_status": "regulatory_clearance_status_from_dcgi",
    "health_conditions": "health_condition_problems_studied",
    "interventions": "intervention_comparator_agent",
    "primary_outcomes": "primary_outcome",
    "secondary_outcomes": "secondary_outcome",
}


def flatten_record(record: Column) -> list[Column]:
    """The 54 flat columns of a trial record held as a label to value map (objects and lists as JSON text)."""
    def value(label: str, default: str = "") -> Column:
        return F.coalesce(F.try_element_at(record, F.lit(label)), F.lit(default))

    def member(label: str, field: str) -> Column:
        return F.coalesce(F.get_json_object(value(label), f"$.{field}"), F.lit(""))

    people = {f"{out}_{f}": (label, f) for out, (label, fields) in RECORD_OBJECTS.items() for f in fields}
    return (
        [value(c).alias(c) for c in RECORD_FIELDS]
        + [member(label, f).alias(out) for out, (label, f) in {**people, **RECORD_OBJECT_FIELDS}.items()]
        + [value(label, "[]").alias(out) for out, label in RECORD_LISTS.items()]
    )


def flat_pages(trial_pages: DataFrame) -> DataFrame:
    """Trial pages to flat rows, by part: part 0 has everything, further parts go on with oversized lists."""
    once, shared = pages.by_page(trial_pages)
    maps = _whole_records(once)
    if shared is not None:
        maps = maps.unionByName(_records_across_pages(shared))
    return maps.select("page_id", "part", *flatten_record(F.map_from_entries("kv")))


def _records_across_pages(trial_pages: DataFrame) -> DataFrame:
    """The same as ``_whole_records`` out of pages that share ids: labels are brought together by page."""
    found = dedup_last(materialize(page_records(trial_pages), "records"), ["page_id", "label", "part"], ["value"])
    entries = F.sort_array(F.collect_list(F.struct(F.col("label").alias("key"), "value")))
    return found.groupBy("page_id", "part").agg(entries.alias("kv"))
