"""Approval lists on web pages: tables with a header named by keywords."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.codes import month_year
from refloom.functions.urls import resolve_url
from refloom.operators import pages
from refloom.session import materialize

# Words in a header cell and the column they stand for; the first that fits counts.
HEADER_WORDS = {
    "brand": ["brand"],
    "generic": ["non-proprietary", "term name", "generic"],
    "approved": ["approved in", "approved date"],
    "report": ["english", "report (en)"],
}


def _which(cell: Column) -> Column:
    text = F.lower(F.trim(cell))
    expr = None
    for name, words in HEADER_WORDS.items():
        hit = F.lit(False)
        for word in words:
            hit = hit | F.contains(text, F.lit(word))
        expr = F.when(hit, name) if expr is None else expr.when(hit, name)
    return expr


def approvals(list_pages: DataFrame) -> DataFrame:
    """One row per product: brand, approval type, generic name, approval month and report links.

    A table without a brand header but four columns has them in the usual order; other tables are
    left out. Superscript remarks tell partial changes from first approvals and are cut from the name.
    """
    once, shared = pages.by_page(list_pages)
    found = _of_pages(once)
    return _shaped(found if shared is None else found.unionByName(_across_pages(shared)))


def _marked(page: int | None, parser) -> Iterator[tuple]:
    """Tables of a page, rows by rows: cells without their superscripts, the first superscript, and the links to reports."""
    tables, rows, cells = {}, {}, {}
    for seq, (parent, tag, attrs, text, bare) in enumerate(parser.found):
        if tag == "table":
            tables[seq] = []
        elif tag == "tr" and parent in tables:
            rows[seq] = []
            tables[parent].append(rows[seq])
        elif tag in ("td", "th") and parent in rows:
            cells[seq] = {"text": pages.spaced(bare), "sup": None, "links": None}
            rows[parent].append(cells[seq])
        elif parent in cells and tag == "sup" and cells[parent]["sup"] is None:
            cells[parent]["sup"] = pages.spaced(text)
        elif parent in cells and tag == "a" and (href := attrs.get("href", "")).lower().endswith(".pdf"):
            cells[parent]["links"] = [*(cells[parent]["links"] or ()), href]
    for number, of_table in enumerate(tables.values()):
        if kept := [{"row_no": at, "cells": row} for at, row in enumerate(of_table) if row]:
            yield page, number, kept


def _of_pages(list_pages: DataFrame) -> DataFrame:
    """Rows of tables, out of pages whose ids differ: a table is whole where its page is parsed."""
    cell = pa.struct([("text", pa.string()), ("sup", pa.string()), ("links", pa.list_(pa.string()))])
    row = pa.struct([("row_no", pa.int32()), ("cells", pa.list_(cell))])
    ddl = "page_id long; table_no int; rows array<struct<row_no: int, cells: array<struct<text: string, sup: string, links: array<string>>>>>; url string"
    tables = pages.per_page(
        list_pages.filter("page_id is not null"), ["table", "tr", "th", "td", "sup", "a"], ddl, [pa.int64(), pa.int32(), pa.list_(row), pa.string()], _marked,
        apart=["sup"],
    )
    # A row has cells, so a header is the first row or none.
    heads = tables.filter(F.col("rows")[0]["row_no"] == 0).withColumn("_head", F.col("rows")[0]["cells"])
    heads = heads.withColumn("_which", F.transform("_head", lambda x: _which(x["text"])))

    def last(name: str) -> Column:
        return F.array_max(F.transform("_which", lambda x, i: F.when(x == name, i)))

    at = {n: last(n) for n in HEADER_WORDS}
    usual = at["brand"].isNull() & (F.size("_head") >= 4)
    heads = heads.select("page_id", "table_no", "rows", "url", *[F.when(usual, F.lit(i)).otherwise(at[n]).alias(n) for i, n in enumerate(HEADER_WORDS)])
    body = heads.filter("brand is not null").select("page_id", "table_no", "url", *HEADER_WORDS, F.inline(F.slice("rows", 2, F.size("rows"))))
    return body.select(
        "page_id", "table_no", "row_no", F.get("cells", "brand")["text"].alias("brand_name"), F.get("cells", "brand")["sup"].alias("sup"),
        F.get("cells", "generic")["text"].alias("generic_name"), F.get("cells", "approved")["text"].alias("approval_date_raw"),
        F.transform(F.get("cells", "report")["links"], lambda x: resolve_url(F.col("url"), x)).alias("en_urls"),
        (F.size("cells") - 1).alias("last"), F.greatest("brand", "generic", "approved").alias("needed"),
    )


def _across_pages(list_pages: DataFrame) -> DataFrame:
    """The same out of pages that share ids: elements are brought together by page."""
    # One parse: the text of a cell without its superscripts, the superscripts, and the links in it.
    found = pages.parsed(list_pages, ["table", "tr", "th", "td", "sup", "a"], apart=["sup"], columns=["seq", "parent", "tag", "attrs", "spaced", "bare"])
    placed = _placed(found)
    cells = materialize(placed.join(found.select("page_id", F.col("seq").alias("c"), F.col("bare").alias("text")), ["page_id", "c"]).drop("c"), "cells")
    inner = found.filter("tag in ('sup', 'a')").select(
        "page_id", F.col("parent").alias("c"), "tag", F.col("seq").alias("inner_seq"), F.col("spaced").alias("inner_text"),
        F.coalesce(F.col("attrs")["href"], F.lit("")).alias("href"),
    )
    inner = placed.join(inner, ["page_id", "c"]).drop("c")
    sups = inner.filter("tag = 'sup'").groupBy("page_id", "table_no", "row_no", "col_no").agg(F.min_by("inner_text", "inner_seq").alias("sup"))
    links = inner.filter((F.col("tag") == "a") & F.lower("href").endswith(".pdf"))
    links = links.join(list_pages.select("page_id", "url"), "page_id").withColumn("link", resolve_url("url", "href"))
    at = ["page_id", "table_no", "row_no", "col_no"]
    links = links.groupBy(*at).agg(F.sort_array(F.collect_list(F.struct("inner_seq", "link"))).alias("l"))
    links = links.select(*at, F.transform("l", lambda x: x["link"]).alias("links"))

    heads = cells.filter("row_no = 0").groupBy("page_id", "table_no").agg(
        *[F.max(F.when(_which(F.col("text")) == name, F.col("col_no"))).alias(name) for name in HEADER_WORDS],
        F.count(F.lit(1)).alias("width"),
    )
    usual = F.col("brand").isNull() & (F.col("width") >= 4)
    heads = heads.withColumn("usual", usual)
    heads = heads.select(
        "page_id", "table_no",
        *[F.when(F.col("usual"), F.lit(i)).otherwise(F.col(n)).alias(n) for i, n in enumerate(HEADER_WORDS)],
    ).filter("brand is not null")
    body = cells.filter("row_no > 0").join(sups, at, "left").join(links, at, "left").join(heads, ["page_id", "table_no"])
    def pick(name: str, value: str) -> Column:
        return F.max(F.when(F.col("col_no") == F.col(name), F.col(value)))

    return body.groupBy("page_id", "table_no", "row_no").agg(
        pick("brand", "text").alias("brand_name"), pick("brand", "sup").alias("sup"), pick("generic", "text").alias("generic_name"),
        pick("approved", "text").alias("approval_date_raw"), pick("report", "links").alias("en_urls"),
        F.max("col_no").alias("last"), F.max(F.greatest("brand", "generic", "approved")).alias("needed"),
    )


def _shaped(rows: DataFrame) -> DataFrame:
    """Products out of rows of tables."""
    rows = rows.filter((F.col("last") >= F.col("needed")) & (F.coalesce("brand_name", F.lit("")) != "") & (F.lower("brand_name") != "brand name"))
    partial = F.contains(F.lower("sup"), F.lit("change")) | F.contains(F.lower("sup"), F.lit("partial"))
    raw = F.coalesce("approval_date_raw", F.lit("unknown"))
    return rows.select(
        "page_id", "table_no", "row_no", "brand_name",
        F.when(F.coalesce(partial, F.lit(False)), "Partial Change Approval").otherwise("Initial Approval").alias("approval_type"),
        F.coalesce("generic_name", F.lit("-")).alias("generic_name"), raw.alias("approval_date_raw"),
        month_year(raw).alias("approval_date"), F.coalesce("en_urls", F.array().cast("array<string>")).alias("en_urls"),
    )


def _placed(found: DataFrame) -> DataFrame:
    """Cells by their place: (page_id, table_no, row_no, col_no) and the number ``c`` of their element."""
    def ranked(tags: Sequence[str], out: str) -> DataFrame:
        rows = found.filter(F.col("tag").isin(*tags))
        grouped = rows.groupBy("page_id", F.coalesce("parent", F.lit(-1)).alias("parent")).agg(F.sort_array(F.collect_list("seq")).alias("s"))
        return grouped.select("page_id", "parent", F.posexplode("s").alias(out, "seq"))

    tables = found.filter("tag = 'table'").groupBy("page_id").agg(F.sort_array(F.collect_list("seq")).alias("s"))
    tables = tables.select("page_id", F.posexplode("s").alias("table_no", "t"))
    rows = ranked(["tr"], "row_no").select("page_id", F.col("parent").alias("t"), "row_no", F.col("seq").alias("r"))
    cells = ranked(["td", "th"], "col_no").select("page_id", F.col("parent").alias("r"), "col_no", F.col("seq").alias("c"))
    placed = cells.join(rows, ["page_id", "r"]).join(tables, ["page_id", "t"])
    return placed.select("page_id", "table_no", "row_no", "col_no", "c")
