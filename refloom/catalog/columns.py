"""Projections, filters and scalar functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from refloom.catalog import query
from refloom.functions import arrays, codes, text, urls
from refloom.operators import select
from refloom.operators.aggregate import ordered_list
from refloom.session import spread

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_SQL = ", ".join(LINE_ORDER)


# Projections and filters.


@query("clean_columns", "SELECT p_partkey AS part_key, p_name AS name_text, p_size AS size_cm FROM part")
def clean_columns(t):
    odd = t.part.select("p_partkey", "p_name", "p_size").toDF(" Part--Key ", "Name (Text)", "Size/cm.")
    return select.clean_columns(odd)


@query(
    "pick_column",
    "SELECT s_suppkey, coalesce(nullif(s_name, 'Supplier#000000001'), 'none') AS name, 'n/a' AS absent FROM supplier",
)
def pick_column(t):
    odd = t.supplier.select("s_suppkey", F.nullif("s_name", F.lit("Supplier#000000001")).alias("Ref. Product_Name"))
    return odd.select(
        "s_suppkey",
        select.pick(odd, ["Label", "ref product name"], "none").alias("name"),
        select.pick(odd, ["No Such Column"], "n/a").alias("absent"),
    )


@query(
    "nested_project",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS priority, coalesce(nullif(o_orderstatus, 'P'), '') AS status,
      CASE WHEN o_orderstatus = 'F' THEN '' ELSE CAST(o_custkey AS VARCHAR) END AS customer FROM orders
    """,
)
def nested_project(t):
    inner = F.struct(F.col("o_custkey").alias("customer"))
    nested = t.orders.select(F.struct(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("  "), "o_orderpriority", F.lit("\t")).alias("priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("status"),
        F.when(F.col("o_orderstatus") != "F", inner).alias("source"),
    ).alias("o"))
    return select.nested_project(
        nested, {"id": "o.id", "priority": "o.priority", "status": "o.status", "customer": "o.source.customer"}
    )


@query("require_key", "SELECT page_id, url FROM pages WHERE url NOT LIKE '%#top' AND url NOT LIKE '%.html'")
def require_key(t):
    key = F.when(F.col("url").endswith("#top"), F.lit("  ")).when(~F.col("url").endswith(".html"), F.col("url"))
    return select.require_key(t.pages.select("page_id", key.alias("url")), "url")


@query(
    "search_any",
    "SELECT p_partkey, p_name, p_type FROM part WHERE p_name ILIKE '%RING%' OR p_type ILIKE '%Promo%'",
)
def search_any(t):
    rows = t.part.select("p_partkey", "p_name", "p_type")
    return rows.filter(select.contains_any("ring", ["p_name"]) | select.contains_any("pROmo", ["p_type"]))


@query(
    "search_columns",
    "SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE strpos(lower(c_name), '00') > 0 OR strpos(lower(c_mktsegment), '00') > 0",
)
def search_columns(t):
    return select.search_any(t.customer.select("c_custkey", "c_name", "c_mktsegment"), "00", ["c_name", "c_mktsegment"])


@query(
    "search_nested",
    """
    SELECT o_orderkey FROM orders WHERE o_orderpriority ILIKE '%urgent%'
      OR o_orderkey IN (SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_name ILIKE '%ring%')
    """,
)
def search_nested(t):
    """Orders as products with their parts as ingredients."""
    lines = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).withColumnRenamed("l_orderkey", "o_orderkey")
    products = ordered_list(lines, ["o_orderkey"], F.struct(F.array(F.struct(F.col("p_name").alias("name"))).alias("parts")), LINE_ORDER, "products")
    rows = t.orders.select("o_orderkey", "o_orderpriority").join(products, "o_orderkey", "left")
    found = select.search_nested(rows, "RING", [], {"products": ["parts.name"]}).select("o_orderkey")
    urgent = select.search_nested(rows, "urgent", ["o_orderpriority"], {}).select("o_orderkey")
    return found.union(urgent).distinct()


@query("filter_in", "SELECT doc_id, lang FROM documents WHERE lang IN ('en', 'fr')")
def filter_in(t):
    return select.filter_in(t.documents.select("doc_id", "lang"), "lang", "EN, fr,")


@query(
    "filter_records",
    """
    SELECT p_partkey, p_name, p_size FROM part
    WHERE p_type = 'PROMO' AND p_size >= 20 AND p_name ILIKE '%r%' AND lower(p_brand) IN ('brand#3')
    """,
)
def filter_records(t):
    rows = select.filter_records(t.part, {"p_type": "PROMO"}, {"p_size": 20}, {"p_name": "R"}, {"p_brand": "BRAND#3"})
    return rows.select("p_partkey", "p_name", "p_size")


@query(
    "eligible",
    """
    SELECT o_orderkey, (o_orderstatus <> 'P') AND (o_orderpriority = '1-URGENT' OR o_totalprice > 300000) AS eligible FROM orders
    """,
)
def eligible(t):
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey"))
    flags = [F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") > 300000]
    return t.orders.select("o_orderkey", select.eligible(key, flags).alias("eligible"))


@query(
    "filter_year",
    """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate <= TIMESTAMP '1998-12-31' AND o_orderstatus = 'F'
    """,
)
def filter_year(t):
    rows = select.filter_tokens(
        t.orders, "status:F, from_publication_date:1996-01-01,to_publication_date:1998-12-31",
        {"status": "o_orderstatus", "publication_date": "o_orderdate"},
    )
    return rows.select("o_orderkey", "o_orderstatus")


@query(
    "quality_gate",
    """
    SELECT doc_id, CASE WHEN lang = 'de' THEN 'corrupted' WHEN lang = 'es' AND n_chars < 500 THEN 'empty_text'
      WHEN length(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) < 100 THEN 'short_text' ELSE 'ok' END AS status FROM documents
    """,
)
def quality_gate(t):
    head = F.when(F.col("lang") == "de", F.lit("<html>")).otherwise("%PDF-1.7")
    body = F.when((F.col("lang") == "es") & (F.col("n_chars") < 500), F.lit(" \n")).otherwise(F.col("text"))
    return spread(t.documents).select("doc_id", select.quality_status(head, body).alias("status"))


@query(
    "null_sentinels",
    "SELECT p_partkey, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN NULL ELSE p_type END AS p_type, p_name FROM part",
)
def null_sentinels(t):
    kind = F.when(F.col("p_type") == "PROMO", " N/A ").when(F.col("p_type") == "LARGE", "None").otherwise(F.col("p_type"))
    rows = t.part.select("p_partkey", kind.alias("p_type"), "p_name")
    return select.null_sentinels(rows, ["p_type", "p_name"])


@query(
    "filter_files",
    "SELECT page_id, regexp_extract(url, '^[^?#]*/([^/?#]*)', 1) AS name FROM pages WHERE regexp_matches(url, '^[^?#]*\\.html([?#]|$)') AND url NOT ILIKE '%pills%'",
)
def filter_files(t):
    rows = t.pages.withColumn("name", urls.file_name("url"))
    rows = rows.filter(select.data_file("name", ".html", ()) & select.data_file(F.regexp_replace("url", r"[?#].*$", ""), ".html", ("pills",)))
    return rows.select("page_id", "name")


# Scalar functions.


@query(
    "clean_text",
    "SELECT doc_id, md5(trim(regexp_replace(text, '\\s+', ' ', 'g'))) AS digest FROM documents",
)
def clean_text(t):
    noisy = F.concat(F.lit("  "), F.replace("text", F.lit(" "), F.lit(" \r\n\t ")), F.lit("\n"))
    return spread(t.documents).select("doc_id", F.md5(text.clean_text(noisy)).alias("digest"))


@query(
    "slugify",
    """
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN 'unnamed' ELSE
      substring(regexp_replace(p_name, '\\s+', '_', 'g') || '_' || p_brand || '_' || repeat('x', 80), 1, 80) END AS slug,
      upper(regexp_replace(p_name, '\\s+', '_', 'g')) || '__PL' || p_partkey || '_spc.' || CASE WHEN p_size < 25 THEN 'docx' ELSE 'pdf' END AS file
    FROM part
    """,
)
def slugify(t):
    name = F.concat(F.lit(' <"'), "p_name", F.lit(': ?'), F.lit(" "), "p_brand", F.lit("|  "), F.repeat(F.lit("x"), 80))
    name = F.when(F.col("p_type") == "PROMO", F.lit("")).otherwise(name)
    original = F.when(F.col("p_size") < 25, "leaflet.docx").otherwise("leaflet.exe")
    file = text.document_file_name(
        F.concat("p_name", F.lit(" ®")), F.lit("SPC"), F.concat(F.lit("PL "), F.col("p_partkey").cast("string"), F.lit("/")), original
    )
    return t.part.select("p_partkey", text.slugify(name).alias("slug"), file.alias("file"))


@query(
    "url_lang_type",
    """
    WITH u AS (SELECT page_id, regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS l FROM pages)
    SELECT page_id, l AS by_path, l AS by_suffix, 'unknown' AS by_nothing, 'leaflet' AS kind, 'other' AS no_kind FROM u
    """,
)
def url_lang_type(t):
    """Page URLs turned into document URLs of the three kinds."""
    lang = F.regexp_extract("url", r"^https?://[^/]+/([a-z]{2})/", 1)
    full = F.regexp_replace("url", r"^(https?://[^/]+/[a-z]{2})/.*$", "$1/documents/leaflet/x.pdf")
    named = F.concat(F.lit("https://h.example/files/Y_"), F.upper(lang), F.lit(".PDF"))
    plain = F.lit("https://h.example/files/y.txt")
    return t.pages.select(
        "page_id", urls.url_language(full).alias("by_path"), urls.url_language(named).alias("by_suffix"),
        urls.url_language(plain).alias("by_nothing"), urls.url_kind(full).alias("kind"), urls.url_kind(named).alias("no_kind"),
    )


@query(
    "url_param",
    """
    SELECT page_id, nullif(regexp_extract(url, '[?&]page=([^&#]*)', 1), '') AS page,
      nullif(regexp_extract(url, '[?&]utm_source=([^&#]*)', 1), '') AS source,
      CAST(page_id AS VARCHAR) || ' x/y' AS substance, regexp_replace(url, '([?&]page=)\\d+', '\\199', 'g') AS other_page
    FROM pages
    """,
)
def url_param(t):
    listed = F.concat(F.lit("https://h.example/saw.dll?Dashboard&P3="), F.col("page_id").cast("string"), F.lit("+x%2Fy&z=1"))
    return t.pages.select(
        "page_id", urls.url_param("url", "page").alias("page"), urls.url_param("url", "utm_source").alias("source"),
        urls.url_param(listed, "P3").alias("substance"), urls.replace_param("url", "page", 99).alias("other_page"),
    )


@query(
    "resolve_links",
    """
    WITH b AS (SELECT page_id, regexp_extract(url, '^(https?://[^/?#]+)', 1) AS origin, regexp_replace(url, '#.*$', '') AS bare,
      regexp_replace(url, '[?#].*$', '') AS plain FROM pages)
    SELECT page_id, origin || '/a/b.pdf' AS rooted, regexp_replace(plain, '[^/]*$', '') || 'c.pdf' AS relative,
      'https://x.example/d' AS absolute, regexp_extract(origin, '^(https?:)', 1) || '//y.example/e' AS no_scheme,
      plain || '?p=2' AS query, bare || '#f' AS fragment, origin || '/b/' AS up, origin || '/x?q=../y' AS rooted_up
    FROM b
    """,
)
def resolve_links(t):
    links = {
        "rooted": "/a/b.pdf", "relative": "c.pdf", "absolute": "https://x.example/d", "no_scheme": "//y.example/e",
        "query": "?p=2", "fragment": "#f", "up": "../../../a/./../b/.", "rooted_up": "/c/../x?q=../y",
    }
    return t.pages.select("page_id", *[urls.resolve_url("url", F.lit(v)).alias(k) for k, v in links.items()])


@query("hash_id", "SELECT page_id, substring(md5(url), 1, 8) AS id FROM pages")
def hash_id(t):
    return t.pages.select("page_id", urls.hash_id("url").alias("id"))


@query(
    "iso_date",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS full_date, strftime(o_orderdate, '%Y%m') AS short_date FROM orders",
)
def iso_date(t):
    return t.orders.select(
        "o_orderkey", codes.iso_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("full_date"),
        codes.iso_date(F.date_format("o_orderdate", "yyyyMM")).alias("short_date"),
    )


@query(
    "month_year",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS long_name, strftime(o_orderdate, '%Y-%m') AS short_name,
      strftime(o_orderdate, '%Y-00') AS no_month, 'unknown' AS no_year FROM orders
    """,
)
def month_year(t):
    date = F.col("o_orderdate")
    return spread(t.orders).select(
        "o_orderkey",
        codes.month_year(F.concat(F.date_format(date, "MMMM yyyy"), F.lit(" (Conditional approval)"))).alias("long_name"),
        codes.month_year(F.concat(F.date_format(date, "MMM"), F.lit(". 12, "), F.date_format(date, "yyyy"), F.lit(";"))).alias("short_name"),
        codes.month_year(F.concat(F.lit(" In "), F.date_format(date, "yyyy"))).alias("no_month"),
        codes.month_year(F.date_format(date, "MMMM")).alias("no_year"),
    )


def _class_code(t):
    """Classification codes of all levels out of part attributes."""
    letter = F.char(F.lit(65) + F.col("p_size") % 26)
    full = F.concat(
        letter, F.lpad((F.col("p_size") % 100).cast("string"), 2, "0"), F.substring("p_type", 1, 2),
        F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0"),
    )
    width = (
        F.when(F.col("p_type") == "PROMO", 1).when(F.col("p_type") == "LARGE", 3).when(F.col("p_type") == "SMALL", 4)
        .when(F.col("p_type") == "MEDIUM", 5).when(F.col("p_type") == "ECONOMY", 6).otherwise(7)
    )
    return t.part.select("p_partkey", F.substring(full, F.lit(1), width).alias("code"))


CLASS_SQL = """
    c AS (SELECT p_partkey, substring(chr(65 + p_size % 26) || lpad(CAST(p_size % 100 AS VARCHAR), 2, '0') || substring(p_type, 1, 2)
      || lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0'), 1,
      CASE p_type WHEN 'PROMO' THEN 1 WHEN 'LARGE' THEN 3 WHEN 'SMALL' THEN 4 WHEN 'MEDIUM' THEN 5 WHEN 'ECONOMY' THEN 6 ELSE 7 END) AS code FROM part)
"""


@query(
    "code_level",
    f"WITH {CLASS_SQL} SELECT p_partkey, code, CASE length(code) WHEN 1 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 WHEN 5 THEN 4 WHEN 7 THEN 5 END AS level FROM c",
)
def code_level(t):
    return _class_code(t).select("p_partkey", "code", codes.code_level("code").alias("level"))


@query(
    "parent_code",
    f"""
    WITH {CLASS_SQL},
    d AS (SELECT p_partkey, p_size, 'A' || lpad(CAST(p_size AS VARCHAR), 2, '0') || CASE p_type WHEN 'PROMO' THEN '' WHEN 'LARGE' THEN '.1' ELSE '.' || p_partkey END AS dotted,
      p_type FROM part)
    SELECT c.p_partkey, code, CASE length(code) WHEN 1 THEN '' WHEN 3 THEN substring(code, 1, 1) WHEN 4 THEN substring(code, 1, 3)
        WHEN 5 THEN substring(code, 1, 4) WHEN 7 THEN substring(code, 1, 5) END AS class_parent,
      CASE WHEN strpos(dotted, '.') = 0 THEN NULL WHEN length(split_part(dotted, '.', 2)) = 1 THEN split_part(dotted, '.', 1)
        ELSE substring(dotted, 1, length(dotted) - 1) END AS dotted_parent
    FROM c JOIN d ON c.p_partkey = d.p_partkey
    """,
)
def parent_code(t):
    stem = F.concat(F.lit("A"), F.lpad(F.col("p_size").cast("string"), 2, "0"))
    dotted = F.when(F.col("p_type") == "PROMO", stem).when(F.col("p_type") == "LARGE", F.concat(stem, F.lit(".1"))).otherwise(
        F.concat(stem, F.lit("."), F.col("p_partkey").cast("string"))
    )
    rows = _class_code(t).join(t.part.select("p_partkey", dotted.alias("dotted")), "p_partkey")
    return rows.select("p_partkey", "code", codes.class_parent("code").alias("class_parent"), codes.dotted_parent("dotted").alias("dotted_parent"))


@query(
    "split_axes",
    """
    SELECT o_orderkey, o_orderpriority AS component, strftime(o_orderdate, '%Y') AS property, strftime(o_orderdate, '%m') AS time_aspect,
      CASE WHEN o_orderstatus = 'F' THEN '' ELSE o_orderstatus END AS system, '' AS scale_type, '' AS method_type FROM orders
    """,
)
def split_axes(t):
    date = F.date_format("o_orderdate", "yyyy:MM")
    name = F.concat("o_orderpriority", F.lit("\u200b: "), date, F.when(F.col("o_orderstatus") == "F", "").otherwise(F.concat(F.lit(": "), "o_orderstatus")))
    return t.orders.select("o_orderkey", *codes.split_axes(name))


@query(
    "format_detail",
    """
    SELECT l_orderkey, l_linenumber, 'part ' || l_partkey || CASE WHEN l_returnflag = 'N' THEN '' ELSE ' (' || l_returnflag || ')' END AS ingredient,
      'Patent ' || l_partkey || ' (Exp: ' || strftime(l_shipdate, '%b %d, %Y') || ')' || CASE WHEN l_linestatus = 'F' THEN '' ELSE ' [Use: U-' || l_suppkey || ' - use]' END AS patent,
      CASE WHEN l_returnflag = 'A' THEN 'Unknown Agency' ELSE 'Agency ' || l_suppkey END
        || CASE WHEN l_linestatus = 'F' THEN '' ELSE ' (ID: ' || l_partkey || CASE WHEN l_returnflag = 'R' THEN ', Acronym: RR' ELSE '' END || ')' END AS funding
    FROM lineitem
    """,
)
def format_detail(t):
    flag, state = F.col("l_returnflag"), F.col("l_linestatus")
    open_line = state != "F"
    name = F.concat(F.lit("part "), F.col("l_partkey").cast("string"))
    agency = F.when(flag != "A", F.concat(F.lit("Agency "), F.col("l_suppkey").cast("string")))
    use = F.when(open_line, F.concat(F.lit("U-"), F.col("l_suppkey").cast("string")))
    grant_id = F.when(open_line, F.col("l_partkey").cast("string"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", text.with_detail(name, F.nullif(flag, F.lit("N"))).alias("ingredient"),
        text.patent_detail(F.col("l_partkey"), F.date_format("l_shipdate", "MMM dd, yyyy"), use, F.lit("use")).alias("patent"),
        text.grant_detail(agency, grant_id, F.when(flag == "R", "RR")).alias("funding"),
    )


@query("strip_zeros", "SELECT c_custkey, ltrim(substring(c_name, 10), '0') AS number FROM customer")
def strip_zeros(t):
    return t.customer.select("c_custkey", text.strip_zeros(F.concat(F.lit(" "), F.substring("c_name", 10, 20))).alias("number"))


@query(
    "pack_list",
    "SELECT p_partkey, p_name || '|' || p_type AS packed, CAST(2 AS BIGINT) AS n, '' AS nothing FROM part",
)
def pack_list(t):
    items = arrays.unpack(F.concat_ws(" | ", "p_name", F.lit(""), F.concat(F.lit(" "), "p_type")), "|")
    rows = t.part.select("p_partkey", items.alias("items"), arrays.unpack(F.concat(F.lit("; ;"), F.lit(" ")), ";").alias("none"))
    return rows.select(
        "p_partkey", arrays.pack("items", "|").alias("packed"), F.size("items").cast("long").alias("n"), arrays.pack("none", "|").alias("nothing")
    )


@query(
    "synonyms",
    """
    WITH l AS MATERIALIZED (SELECT doc_id, string_split(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS l FROM documents),
    f AS MATERIALIZED (SELECT doc_id, lower(trim(l[1])) AS f FROM l),
    u AS MATERIALIZED (SELECT DISTINCT doc_id, x FROM (SELECT doc_id, trim(unnest(l)) AS x FROM l)),
    w AS (SELECT u.doc_id, x, f FROM u JOIN f ON u.doc_id = f.doc_id)
    SELECT d.doc_id, count(x) AS n, md5(coalesce(string_agg(x, ';' ORDER BY x), '')) AS digest
    FROM documents d LEFT JOIN w ON d.doc_id = w.doc_id AND x <> '' AND lower(x) <> f GROUP BY d.doc_id
    """,
)
def synonyms(t):
    """Words of a text as names, the first word as the preferred one."""
    words = F.split(F.regexp_replace("text", r"[\t\n\f\r ]+", " "), " ")
    rows = spread(t.documents).select("doc_id", words.alias("w"))
    rows = rows.select("doc_id", arrays.synonyms("w", F.get("w", F.lit(0))).alias("s"))
    return rows.select("doc_id", F.size("s").cast("long").alias("n"), F.md5(arrays.pack("s", ";")).alias("digest"))


@query(
    "filter_structs",
    f"""
    SELECT l_orderkey, CAST(0 AS BIGINT) AS part, coalesce(string_agg(CAST(l_partkey AS VARCHAR), '|' ORDER BY {LINE_SQL}) FILTER (WHERE l_returnflag = 'A'), '') AS parts,
      first(l_suppkey ORDER BY {LINE_SQL}) FILTER (WHERE l_returnflag = 'R') AS first_returned,
      last(l_suppkey ORDER BY {LINE_SQL}) FILTER (WHERE l_returnflag = 'R') AS last_returned
    FROM lineitem GROUP BY l_orderkey
    """,
)
def filter_structs(t):
    entry = F.struct(F.col("l_returnflag").alias("system"), F.col("l_partkey").cast("string").alias("code"), "l_suppkey")
    rows = ordered_list(t.lineitem, ["l_orderkey"], entry, LINE_ORDER, "codes")
    return rows.select(
        "l_orderkey", "part", arrays.pack(arrays.where("codes", lambda x: x["system"] == "A", "code"), "|").alias("parts"),
        arrays.first_where("codes", lambda x: x["system"] == "R", "l_suppkey").alias("first_returned"),
        arrays.last_where("codes", lambda x: x["system"] == "R", "l_suppkey").alias("last_returned"),
    )


@query(
    "heading_terms",
    f"""
    WITH x AS (
      SELECT l_orderkey, l_returnflag || CASE WHEN l_linestatus = 'F' THEN '' ELSE '/' || l_linestatus END AS term, l_linenumber <= 2 AS major,
        row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) AS i FROM lineitem WHERE l_returnflag <> 'N'),
    a AS (SELECT l_orderkey, term, min(i) AS i FROM x GROUP BY 1, 2),
    m AS (SELECT l_orderkey, term, min(i) AS i FROM x WHERE major GROUP BY 1, 2)
    SELECT o.l_orderkey, CAST(0 AS BIGINT) AS part, coalesce((SELECT string_agg(term, '; ' ORDER BY i) FROM a WHERE a.l_orderkey = o.l_orderkey), '') AS terms,
      coalesce((SELECT string_agg(term, '; ' ORDER BY i) FROM m WHERE m.l_orderkey = o.l_orderkey), '') AS major_terms
    FROM (SELECT DISTINCT l_orderkey FROM lineitem) o
    """,
)
def heading_terms(t):
    entry = F.struct(
        F.nullif("l_returnflag", F.lit("N")).alias("descriptor_name"), F.nullif("l_linestatus", F.lit("F")).alias("qualifier_name"),
        (F.col("l_linenumber") <= 2).alias("is_major_topic"),
    )
    rows = ordered_list(t.lineitem, ["l_orderkey"], entry, LINE_ORDER, "mesh")
    return rows.select(
        "l_orderkey", "part", arrays.pack(arrays.heading_terms("mesh"), "; ").alias("terms"),
        arrays.pack(arrays.heading_terms("mesh", True), "; ").alias("major_terms"),
    )


@query(
    "extract_json",
    """
    SELECT event_id, CASE WHEN event_type IN ('error', 'view') THEN NULL ELSE CAST(json_extract(props, '$.k') AS BIGINT) END AS k,
      CASE WHEN event_type IN ('error', 'view') THEN 'failed' ELSE 'completed' END AS status FROM events
    """,
)
def extract_json(t):
    """Model replies around the property text: reasoning, code fences, no object at all, a broken object."""
    kind = F.col("event_type")
    reply = (
        F.when(kind == "error", F.lit("<think>{}</think> nothing found"))
        .when(kind == "view", F.concat(F.lit('{"k": '), F.col("user_id").cast("string")))
        .when(kind == "click", F.concat(F.lit("<think>{maybe\n}</think>\n```json\n"), "props", F.lit("\n```")))
        .otherwise(F.concat(F.lit("Here it is: "), "props", F.lit(" as asked.")))
    )
    rows = t.events.select("event_id", reply.alias("reply"))
    return rows.select("event_id", F.from_json(text.reply_json("reply"), "k long")["k"].alias("k"), text.reply_status("reply").alias("status"))


@query(
    "extract_ids",
    """
    SELECT doc_id, array_to_string(regexp_extract_all(text, '[A-Z][a-z]{8,}'), ',') AS ids,
      CASE lang WHEN 'en' THEN 'Prospective' WHEN 'fr' THEN 'Retrospective' ELSE 'Unknown' END AS kind,
      'CTRI/2020/01/' || doc_id AS trial
    FROM documents
    """,
)
def extract_ids(t):
    note = (
        F.when(F.col("lang") == "en", "Trial Registered Prospectively").when(F.col("lang") == "fr", "trial registered retrospectively")
        .otherwise("not stated")
    )
    number = F.concat(F.lit("CTRI/2020/01/"), F.col("doc_id").cast("string"), F.lit(" [Registered on: 01/01/2020]"))
    return spread(t.documents).select(
        "doc_id", F.array_join(codes.all_matches("text", "[A-Z][a-z]{8,}"), ",").alias("ids"),
        codes.registration_type(note).alias("kind"), F.get(codes.all_matches(number, r"CTRI/\d{4}/\d{2}/\d+"), F.lit(0)).alias("trial"),
    )


@query(
    "strip_title",
    "SELECT p_partkey, p_name AS title, 'https://h.example/' || p_partkey AS link, p_name AS plain_link, 'A00-B99' AS code_range FROM part",
)
def strip_title(t):
    cell = F.concat(F.lit('=hyperlink("https://h.example/'), F.col("p_partkey").cast("string"), F.lit('","open")'))
    return t.part.select(
        "p_partkey", text.strip_title(F.concat(F.lit("- - - "), "p_name")).alias("title"), text.link_target(cell).alias("link"),
        text.link_target(F.concat(F.lit(" "), "p_name")).alias("plain_link"),
        codes.code_range(F.concat("p_name", F.lit(" (A00-B99)"))).alias("code_range"),
    )


@query(
    "code_label",
    """
    SELECT l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'Suspect' WHEN 'R' THEN 'Concomitant' ELSE 'Unknown' END AS role,
      CASE WHEN l_linestatus = 'F' THEN 'Descriptor' ELSE 'Supplemental' END AS kind FROM lineitem
    """,
)
def code_label(t):
    number = F.when(F.col("l_returnflag") == "A", "1").when(F.col("l_returnflag") == "R", "2").otherwise("9")
    record = F.concat(F.when(F.col("l_linestatus") == "F", "D").otherwise("C"), F.col("l_partkey").cast("string"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", codes.code_label(number, codes.ROLE_LABELS).alias("role"), codes.record_kind(record).alias("kind")
    )


@query(
    "truncate_text",
    """
    SELECT doc_id, md5(substring(text, 1, 200)) AS digest, least(n, CASE lang WHEN 'en' THEN 15 WHEN 'fr' THEN 30 WHEN 'de' THEN 10 ELSE n END) AS pages
    FROM (SELECT *, len(string_split(text, '.')) AS n FROM documents)
    """,
)
def truncate_text(t):
    kind = (
        F.when(F.col("lang") == "en", "product-information").when(F.col("lang") == "fr", "assessment-report")
        .when(F.col("lang") == "de", "procedural-steps").otherwise("overview")
    )
    pages = text.page_budget(kind, F.split("text", r"\."))
    return spread(t.documents).select("doc_id", F.md5(text.truncate("text", 200)).alias("digest"), F.size(pages).cast("long").alias("pages"))


@query(
    "numeric_ids",
    "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS number FROM orders",
)
def numeric_ids(t):
    raw = F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).when(
        F.col("o_orderstatus") == "O", F.concat(F.lit("CID"), F.col("o_custkey").cast("string"))
    ).otherwise("12.5")
    return t.orders.select("o_orderkey", codes.numeric_id(raw).alias("number"))


@query(
    "glossary_terms",
    """
    SELECT conv_id, role || ' ' || turn AS term, regexp_replace(trim(replace(text, '"', '')), '\\s+', ' ', 'g') AS definition
    FROM conversations
    """,
)
def glossary_terms(t):
    """Turns written as entries of a script object, then read back as terms and definitions."""
    from refloom.functions.scripts import glossary_entries

    body = F.regexp_replace(F.trim(F.regexp_replace(F.replace("text", F.lit('"'), F.lit("")), r"[\t\n\f\r ]+", " ")), r"([\\`])", "")
    key = F.concat("role", F.lit(" "), F.col("turn").cast("string"))
    quoted = F.concat(F.lit('"'), key, F.lit('": "'), body, F.lit('"'))
    ticked = F.concat(F.lit('"'), key, F.lit('" : `\n   '), body, F.lit("\n\n`"))
    entry = F.when(F.col("role") == "user", quoted).otherwise(ticked)
    script = F.concat(F.lit("const glossaryData = {\n"), entry, F.lit(",\n};\nvar x = 1;"))
    return glossary_entries(t.conversations.select("conv_id", script.alias("script")), "script", ["conv_id"])
