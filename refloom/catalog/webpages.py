"""Page jobs over the driver pages and over pages Spark builds from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from refloom.catalog import query
from refloom.functions.text import fill
from refloom.operators import aggregate as agg
from refloom.operators import pages
from refloom.plans import approvals, classes, concepts, trials
from refloom.session import materialize, spread

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_SQL = ", ".join(LINE_ORDER)


def text(name):
    return F.col(name).cast("string")


def order_pages(t, row, head="", tail=""):
    """A page per order: ``row`` for each line item between ``head`` and ``tail``."""
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    rows = agg.nested_master(spread(t.orders), ["o_orderkey"], [agg.Child("rows", lines, row, LINE_ORDER)])
    html = F.concat(F.lit(head) if isinstance(head, str) else head, F.array_join("rows", "\n"), F.lit(tail))
    built = rows.select(F.col("o_orderkey").alias("page_id"), F.lit("https://h.example/list").alias("url"), html.alias("html"))
    return spread(materialize(built, "pages"))


@query(
    "page_links",
    """
    WITH a AS (SELECT page_id, url, unnest(regexp_extract_all(html, '<a href="[^"]+">[^<]*</a>')) AS a FROM pages)
    SELECT page_id, replace(regexp_extract(a, '<a href="([^"]+)">', 1), '&amp;', '&') AS href, trim(replace(regexp_extract(a, '>([^<]*)</a>', 1), '&amp;', '&')) AS text,
      regexp_extract(url, '^(https?://[^/?#]+)', 1) || replace(regexp_extract(a, '<a href="([^"]+)">', 1), '&amp;', '&') AS absolute_url
    FROM a
    """,
)
def page_links(t):
    return pages.page_links(spread(t.pages)).select("page_id", "href", "text", "absolute_url")


@query(
    "article_text",
    """
    WITH b AS (SELECT page_id, regexp_replace(regexp_replace(html, '(?s)^.*?<body', ''), '(?s)<script.*?</script>', '', 'g') AS b FROM pages),
    p AS (SELECT page_id, unnest(string_split(b, '<p>')[2:]) AS p, generate_subscripts(string_split(b, '<p>')[2:], 1) AS i FROM b),
    x AS (SELECT page_id, i, regexp_replace(regexp_replace(p, '(?s)(</p>|</article>|</div>).*$', ''), '<[^>]*>', '', 'g') AS x FROM p),
    c AS (SELECT page_id, i, trim(regexp_replace(replace(replace(replace(replace(replace(replace(x, '&quot;', '"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\\s+', ' ', 'g')) AS x FROM x)
    SELECT page_id, CAST(0 AS BIGINT) AS part, count(*) AS n_paragraphs, md5(string_agg(x, chr(10) || chr(10) ORDER BY i)) AS digest FROM c WHERE x <> '' GROUP BY page_id
    """,
)
def article_text(t):
    texts = pages.article_text(spread(t.pages))
    return texts.select(
        "page_id", "part", F.size(F.split("body", "\n\n")).cast("long").alias("n_paragraphs"), F.md5("body").alias("digest")
    )


@query(
    "document_links",
    """
    SELECT DISTINCT 'https://h.example/en/documents/leaflet/p' || l_partkey || '.pdf' AS absolute_url, 'en' AS lang, 'leaflet' AS kind
    FROM lineitem WHERE l_returnflag = 'A'
    """,
)
def document_links(t):
    """Order pages with document links in two languages and other links; English ones, each once."""
    link = (
        F.when(F.col("l_returnflag") == "A", fill('<a href="/en/documents/leaflet/p%s.pdf">Leaflet</a>', text("l_partkey")))
        .when(F.col("l_returnflag") == "R", fill('<a href="/fr/documents/leaflet/p%s.pdf">Notice</a>', text("l_partkey")))
        .otherwise(fill('<a href="/en/p%s.html">Page</a>', text("l_partkey")))
    )
    return pages.document_links(order_pages(t, link), "EN").select("absolute_url", "lang", "kind")


@query(
    "table_cells",
    f"""
    WITH x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)
    SELECT l_orderkey AS page_id, CAST(i - 1 AS INTEGER) AS row_no, c.col_no, c.text FROM x, LATERAL (
      SELECT 0 AS col_no, 'all of ' || n AS text UNION ALL SELECT 1, 'part ' || l_partkey UNION ALL SELECT 2, 'part ' || l_partkey
      UNION ALL SELECT 3, l_returnflag || ' & ' || l_linestatus) c
    """,
)
def table_cells(t):
    """A table per order: the first cell spans all rows, the second spans two columns."""
    counts = t.lineitem.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    rows = agg.ordered_list(
        t.lineitem, ["l_orderkey"],
        fill('<td colspan="2"> part %s </td><td><b>%s</b> &amp; %s</td>', text("l_partkey"), F.col("l_returnflag"), F.col("l_linestatus")),
        LINE_ORDER, "rows",
    ).join(counts, "l_orderkey")
    top = fill('<td rowspan="%s">all of %s</td>', text("n"), text("n"))
    html = F.concat(F.lit("<table><tr>"), top, F.array_join("rows", "</tr>\n<tr>"), F.lit("</tr></table>"))
    found = pages.table_cells(spread(materialize(rows.select(F.col("l_orderkey").alias("page_id"), html.alias("html")))))
    return found.select("page_id", "row_no", "col_no", "text")


def _grid_pages(t):
    row = F.concat(
        fill("<tr><td>Status %s</td><td>%s</td></tr>", F.col("l_linestatus"), F.col("l_returnflag")),
        fill("<tr><td>Part</td><td>Part</td><td>%s</td></tr>", text("l_partkey")),
        fill("<tr><td>Supplier</td><td>Key</td><td>%s</td></tr>", text("l_linenumber")),
        fill("<tr><td>A</td><td>B</td><td>C%s</td><td>x</td><td>%s</td></tr>", text("l_linenumber"), F.col("l_returnflag")),
    )
    head = F.concat(
        F.lit("<table><tr><td>No</td><td>Publication date</td></tr><tr><td>1</td><td>2020</td></tr></table><table>"),
        fill("<tr><td>Name of Certified Review Board</td><td>Board %s</td></tr>", F.col("o_orderstatus")),
        fill("<tr><td>Address</td><td>%s</td></tr>", F.col("o_orderpriority")),
    )
    return order_pages(t, row, head, "</table>")


GRID_SQL = f"""
    x AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {LINE_SQL}) AS i FROM lineitem)
"""


@query(
    "grid_fields",
    f"""
    WITH {GRID_SQL},
    s AS (SELECT l_orderkey, l_linestatus, l_returnflag, i, first_value(l_returnflag) OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY i) AS f0,
        row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY i) AS r FROM x),
    k AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus ORDER BY i) AS n FROM s WHERE r = 1 OR l_returnflag <> f0)
    SELECT l_orderkey AS page_id, 'Status ' || l_linestatus || CASE WHEN n = 1 THEN '' ELSE ' (' || n || ')' END AS label, l_returnflag AS value FROM k
    UNION ALL SELECT l_orderkey, 'Part', CAST(l_partkey AS VARCHAR) FROM x QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY i DESC) = 1
    UNION ALL SELECT l_orderkey, 'Supplier - Key', CAST(l_linenumber AS VARCHAR) FROM x QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY i DESC) = 1
    UNION ALL SELECT l_orderkey, 'A - B - C' || l_linenumber, 'x ' || l_returnflag FROM x QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY i DESC) = 1
    UNION ALL SELECT o_orderkey, 'Certified Review Board - Name', 'Board ' || o_orderstatus FROM orders
    UNION ALL SELECT o_orderkey, 'Certified Review Board - Address', o_orderpriority FROM orders
    """,
)
def grid_fields(t):
    """Grids of two, three and five columns with a section and labels that repeat."""
    return trials.grid_records(_grid_pages(t))


@query(
    "table_records",
    f"""
    WITH {GRID_SQL}
    SELECT l_orderkey AS page_id, CAST(i + 1 AS INTEGER) AS row_no, CASE WHEN l_returnflag = 'R' THEN 'part ' || l_partkey || ' | ' || l_suppkey || ' | extra' END AS raw_row,
      CASE WHEN l_returnflag <> 'R' THEN 'part ' || l_partkey END AS site_name, CASE WHEN l_returnflag <> 'R' THEN CAST(l_suppkey AS VARCHAR) END AS no_of_sites
    FROM x WHERE l_returnflag <> 'N'
    """,
)
def table_records(t):
    """A title row above the header, dividers of one cell, and rows that are too long."""
    row = (
        F.when(F.col("l_returnflag") == "N", F.lit("<tr><td>divider</td></tr>"))
        .when(F.col("l_returnflag") == "R", fill("<tr><td>part %s</td><td>%s</td><td>extra</td></tr>", text("l_partkey"), text("l_suppkey")))
        .otherwise(fill("<tr><td> part\n%s</td><td>%s</td></tr>", text("l_partkey"), text("l_suppkey")))
    )
    head = "<table><tr><td>No of Sites = 9</td></tr><tr><th>Site (Name)</th><th>No. of Sites</th></tr>"
    found = pages.page_records(order_pages(t, row, head, "</table>"))
    return found.select("page_id", "row_no", *[F.try_element_at("fields", F.lit(c)).alias(c) for c in ("raw_row", "site_name", "no_of_sites")])


def _code_pages(t):
    axes = fill("%s\u200b: %s:%s", F.col("o_orderpriority"), F.col("o_orderstatus"), text("o_custkey"))
    head = F.concat(
        fill('<h2><span id="loinc-id"> %s </span><span id="lcn">Order %s</span></h2>', text("o_orderkey"), text("o_orderkey")),
        F.lit('<section id="term-description"><p itemprop="description"> About it </p></section>'),
        F.lit('<section id="additional-names"><dl><dt>Fully-Specified Name</dt><dd>'), axes,
        F.lit("</dd><dt>Short Name</dt><dd>"), F.col("o_orderstatus"), F.lit("</dd><dt>Other</dt></dl></section>"),
        F.lit('<section id="basic"><dl><dt>Class / Type</dt><dd>'), F.col("o_orderpriority"),
        F.lit("</dd><dt>Order vs. Observation</dt><dd>Both</dd></dl></section><section id='related-names'><ul>"),
    )
    row = fill("<li>part %s</li>", text("l_partkey"))
    return order_pages(t, row, head, "</ul></section>")


@query(
    "definition_lists",
    f"""
    WITH r AS (SELECT l_orderkey, string_agg('part ' || l_partkey, '; ' ORDER BY {LINE_SQL}) AS related FROM lineitem GROUP BY 1)
    SELECT CAST(o_orderkey AS VARCHAR) AS loinc_num, 'Order ' || o_orderkey AS long_common_name, 'About it' AS description,
      o_orderpriority || ': ' || o_orderstatus || ':' || o_custkey AS fully_specified_name, o_orderpriority AS component, o_orderstatus AS property,
      CAST(o_custkey AS VARCHAR) AS time_aspect, '' AS system, o_orderstatus AS short_name, '' AS display_name, o_orderpriority AS class, '' AS type,
      'Both' AS order_obs, coalesce(related, '') AS related_names
    FROM orders LEFT JOIN r ON l_orderkey = o_orderkey
    """,
)
def definition_lists(t):
    """Code pages with name and attribute lists, related names and a description."""
    return classes.observations(_code_pages(t)).select(
        "loinc_num", "long_common_name", "description", "fully_specified_name", "component", "property", "time_aspect", "system",
        "short_name", "display_name", "class", "type", "order_obs", "related_names",
    )


@query(
    "chapters",
    f"""
    WITH k AS (SELECT l_orderkey, l_returnflag, string_agg('part ' || l_partkey, ';' ORDER BY {LINE_SQL}) AS x FROM lineitem GROUP BY 1, 2)
    SELECT o_orderkey AS page_id, CAST(0 AS BIGINT) AS part, 'Chapter ' || o_custkey || ' (A00-B99)' AS title, 'A00-B99' AS code_range,
      coalesce(a.x, '') AS inclusions, coalesce(r.x, '') AS exclusions, coalesce(n.x, '') AS notes
    FROM orders LEFT JOIN k a ON a.l_orderkey = o_orderkey AND a.l_returnflag = 'A' LEFT JOIN k r ON r.l_orderkey = o_orderkey AND r.l_returnflag = 'R'
      LEFT JOIN k n ON n.l_orderkey = o_orderkey AND n.l_returnflag = 'N'
    """,
)
def chapters(t):
    """Chapter pages with a heading and rubrics of three kinds."""
    kind = F.when(F.col("l_returnflag") == "A", "Rubric-inclusion-l1").when(F.col("l_returnflag") == "R", "Rubric-exclusion").otherwise("Rubric-note")
    row = fill('<dl class="%s"><dt>x</dt><dd>part\n <a>%s</a></dd></dl>', kind, text("l_partkey"))
    head = fill('<div id="classicont"><h1>Chapter %s (A00-B99)</h1>', text("o_custkey"))
    return classes.chapters(order_pages(t, row, head, "</div>"))


@query(
    "rubrics",
    f"""
    SELECT l_orderkey AS page_id, CASE l_returnflag WHEN 'A' THEN 'inclusions' WHEN 'R' THEN 'exclusions' ELSE 'notes' END AS kind, CAST(0 AS BIGINT) AS part,
      string_agg('part ' || l_partkey, ';' ORDER BY {LINE_SQL}) AS texts FROM lineitem GROUP BY 1, 2
    """,
)
def rubrics(t):
    kind = (
        F.when(F.col("l_returnflag") == "A", "Rubric-inclusion-l1").when(F.col("l_returnflag") == "R", "Rubric-exclusion")
        .when(F.col("l_linestatus") == "F", "Rubric-note").otherwise("x Rubric-coding-hint")
    )
    row = fill('<dl class="%s"><dt>x</dt><dd>part\n <a>%s</a></dd></dl>', kind, text("l_partkey"))
    found = pages.rubric_elements(order_pages(t, row, '<div id="classicont"><dl><dd>other</dd></dl>', "</div>"))
    return pages.rubric_lists(found)


CODE_SQL = """
    p AS (SELECT p_partkey, chr(65 + p_size % 26) || lpad(CAST(p_size AS VARCHAR), 2, '0') || substring(p_type, 1, 2) AS class_code,
      lpad(CAST(p_partkey % 100 AS VARCHAR), 2, '0') AS tail, p_name, p_brand, p_type FROM part)
"""


def _class_pages(t):
    """A page per part: links to its class and its three parents, and a substance table."""
    code = F.concat(F.char(F.lit(65) + F.col("p_size") % 26), F.lpad(text("p_size"), 2, "0"), F.substring("p_type", 1, 2))
    links = [
        fill('<b>%s&nbsp;<a href="./?code=%s&amp;showdescription=no">%s</a></b>', c, c, n)
        for c, n in (
            (F.substring(code, 1, 1), F.lit("Group")), (F.substring(code, 1, 3), F.lit("Size")), (F.substring(code, 1, 4), F.lit("Kind")), (code, F.col("p_type")),
        )
    ]
    table = fill(
        "<table><tr><td>ATC code</td><td>Name</td></tr><tr><td>%s%s</td><td><a>%s</a></td><td>1&nbsp;</td><td>g</td></tr></table>",
        code, F.lpad((F.col("p_partkey") % 100).cast("string"), 2, "0"), F.col("p_name"),
    )
    html = F.concat(F.lit("<div id=content>"), *links, F.lit('<a href="./?code=no">x</a>'), table)
    return spread(t.part).select(F.col("p_partkey").alias("page_id"), F.lit("https://h.example/list/").alias("url"), html.alias("html"))


@query(
    "class_pages",
    f"""
    WITH {CODE_SQL}
    SELECT code, CASE length(code) WHEN 1 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN 3 ELSE 4 END AS level, first(name ORDER BY p_partkey) AS name,
      CASE length(code) WHEN 1 THEN '' WHEN 3 THEN substring(code, 1, 1) WHEN 4 THEN substring(code, 1, 3) ELSE substring(code, 1, 4) END AS parent_code,
      first(description ORDER BY length(description) DESC, p_partkey) AS description
    FROM (SELECT p_partkey, substring(class_code, 1, w.n) AS code, CASE w.n WHEN 1 THEN 'Group' WHEN 3 THEN 'Size' WHEN 4 THEN 'Kind' ELSE p_type END AS name, p_name AS description
      FROM p, (VALUES (1), (3), (4), (5)) w(n)) GROUP BY code
    """,
)
def class_pages(t):
    """Classes seen on many pages, the longest description of each kept."""
    links = classes.class_links(_class_pages(t))
    about = t.part.select(F.col("p_partkey").alias("page_id"), F.col("p_name").alias("description"))
    return classes.classes(links.join(about, "page_id"), "page_id")


@query(
    "class_children",
    f"""
    WITH {CODE_SQL}
    SELECT DISTINCT substring(class_code, 1, 1) AS code, substring(class_code, 1, 3) AS child FROM p
    """,
)
def class_children(t):
    """Pages stand for the top class of their part."""
    shown = t.part.select(F.col("p_partkey").alias("page_id"), F.char(F.lit(65) + F.col("p_size") % 26).alias("code"))
    return classes.child_codes(classes.class_links(_class_pages(t)), shown)


@query(
    "class_substances",
    f"""
    WITH {CODE_SQL}
    SELECT class_code || tail AS code, first(p_name ORDER BY p_partkey DESC) AS name, '1' AS ddd, 'g' AS unit, '' AS note, class_code AS parent_code FROM p GROUP BY class_code, tail
    """,
)
def class_substances(t):
    return classes.substances(_class_pages(t)).select("code", "name", "ddd", "unit", "note", "parent_code")


@query(
    "approval_tables",
    f"""
    WITH {GRID_SQL}
    SELECT l_orderkey AS page_id, 'Brand ' || l_partkey AS brand_name, CASE WHEN l_returnflag = 'R' THEN 'Partial Change Approval' ELSE 'Initial Approval' END AS approval_type,
      'supplier ' || l_suppkey AS generic_name, strftime(l_shipdate, '%Y-%m') AS approval_date,
      CASE WHEN l_linestatus = 'F' THEN 'https://h.example/r/' || l_partkey || '.pdf' ELSE '' END AS urls
    FROM x WHERE l_returnflag <> 'N'
    """,
)
def approval_tables(t):
    """Approval tables with superscript remarks, short rows and report links."""
    mark = F.when(F.col("l_returnflag") == "R", F.lit("<sup>partial change</sup>")).otherwise("")
    link = F.when(F.col("l_linestatus") == "F", fill('<a href="/r/%s.pdf">PDF</a><a href="/x.html">more</a>', text("l_partkey"))).otherwise("")
    row = F.when(F.col("l_returnflag") == "N", F.lit("<tr><td>note</td></tr>")).otherwise(fill(
        "<tr><td>Brand %s%s</td><td>supplier %s</td><td>%s</td><td>%s</td></tr>", text("l_partkey"), mark, text("l_suppkey"),
        F.date_format("l_shipdate", "MMMM yyyy"), link,
    ))
    head = "<table><tr><td><a href='#a'>A</a></td></tr></table><table><tr><th>Brand Name</th><th>Non-proprietary Name</th><th>Approved in</th><th>Review Report (English)</th></tr>"
    found = approvals.approvals(order_pages(t, row, head, "</table>"))
    return found.select("page_id", "brand_name", "approval_type", "generic_name", "approval_date", F.array_join("en_urls", ";").alias("urls"))


#: Fields of a trial page: plain rows, and tables of pairs under a label, by the columns that they become.
_PLAIN_FIELDS = trials.RECORD_FIELDS[5:]
_PAIRS = {
    "Details of Principal Investigator or overall Trial Coordinator (multi-center study)": {f"pi_{f}": f for f in trials.PERSON},
    "Details of Contact Person (Scientific Query)": {f"contact_scientific_{f}": f for f in trials.PERSON[:4]},
    "Details of Contact Person (Public Query)": {f"contact_public_{f}": f for f in trials.PERSON[1:]},
} | {
    label: {out: f for out, (of, f) in trials.RECORD_OBJECT_FIELDS.items() if of == name}
    for label, name in (("Primary Sponsor", "primary_sponsor"), ("Inclusion Criteria", "inclusion_criteria"), ("ExclusionCriteria", "exclusion_criteria"))
}
_MISSING = ["contact_scientific_phone", "contact_scientific_email", "contact_public_name", "db_id"]
_EMPTY_LISTS = [c for c in trials.RECORD_LISTS if c not in ("source_of_monetary_support", "sites_of_study")]


@query(
    "trial_pages",
    f"""
    WITH {GRID_SQL},
    s AS (SELECT l_orderkey, string_agg('{{"name_of_site":"S' || l_suppkey || '","city":"' || l_linestatus || '"}}', ',' ORDER BY i) AS sites FROM x GROUP BY 1)
    SELECT o_orderkey AS page_id, CAST(0 AS BIGINT) AS part, 'CTRI/2020/01/' || o_orderkey AS ctri_id, strftime(o_orderdate, '%d/%m/%Y') AS registration_date,
      CASE WHEN o_orderstatus = 'F' THEN 'Prospective' ELSE 'Retrospective' END AS registration_type,
      'CTRI/2020/01/' || o_orderkey || ' [Registered on: ' || strftime(o_orderdate, '%d/%m/%Y') || '] Trial Registered ' ||
        CASE WHEN o_orderstatus = 'F' THEN 'Prospectively' ELSE 'Retrospectively' END AS ctri_number,
      {", ".join(f"'{c} ' || o_custkey AS {c}" for c in _PLAIN_FIELDS)},
      {", ".join(f"'{out} ' || o_orderpriority AS {out}" for pairs in _PAIRS.values() for out in pairs)},
      {", ".join(f"'' AS {c}" for c in _MISSING)}, {", ".join(f"'[]' AS {c}" for c in _EMPTY_LISTS)},
      '["Funder ' || o_custkey || '"]' AS source_of_monetary_support, '[' || coalesce(sites, '') || ']' AS sites_of_study
    FROM orders LEFT JOIN s ON l_orderkey = o_orderkey WHERE o_orderstatus <> 'P'
    """,
)
def trial_pages(t):
    """Trial pages with plain rows, objects, a list and a table of sites: all columns; pages of status P are invalid."""
    site = fill("<tr><td>S%s</td><td>%s</td></tr>", text("l_suppkey"), F.col("l_linestatus"))
    kind = F.when(F.col("o_orderstatus") == "F", "Trial Registered Prospectively").otherwise("Trial Registered Retrospectively")

    def pairs(label: str, fields: dict[str, str]):
        rows = [F.concat(F.lit(f"<tr><td>{f.replace('_', ' ').title()} :</td><td>{out} "), F.col("o_orderpriority"), F.lit("</td></tr>")) for out, f in fields.items()]
        return F.concat(F.lit(f"<tr><td>{label}</td><td><table>"), *rows, F.lit("<tr><td>one cell</td></tr></table></td></tr>"))

    plain = [F.concat(F.lit(f"<tr><td>{c.replace('_', ' ').title()}</td><td> {c} "), text("o_custkey"), F.lit("</td></tr>")) for c in _PLAIN_FIELDS]
    head = F.concat(
        F.lit("<table border='1'><tr><td>CTRI Number</td><td>CTRI/2020/01/"), text("o_orderkey"), F.lit(" [Registered on: "),
        F.date_format("o_orderdate", "dd/MM/yyyy"), F.lit("] "), kind, F.lit("</td></tr>"), *plain, *[pairs(*p) for p in _PAIRS.items()],
        F.lit("<tr><td>Source of Monetary or Material Support</td><td><table><tr><td>Funder "), text("o_custkey"), F.lit("</td></tr><tr><td>NIL</td></tr></table></td></tr>"),
        F.lit("<tr><td>Sites of Study</td><td><table><tr><td>No of Sites = 2</td></tr><tr><th>Name of Site</th><th>City</th></tr>"),
    )
    found = order_pages(t, site, head, "</table></td></tr></table>")
    status = t.orders.select(F.col("o_orderkey").alias("page_id"), "o_orderstatus")
    found = found.join(status, "page_id").withColumn("html", F.when(F.col("o_orderstatus") == "P", " INVALID ").otherwise(F.col("html")))
    sites = F.expr("from_json(sites_of_study, 'array<struct<name_of_site:string,city:string>>')")
    return trials.flat_pages(found).withColumn("sites_of_study", F.to_json(sites))


@query(
    "substance_index",
    """
    SELECT 'part ' || p_partkey AS substance_name, '1 ' || p_size AS substance_code, 'https://dap.ema.europa.eu/saw.dll?P3=1+' || p_size || '&x=1' AS dap_url FROM part WHERE p_type <> 'PROMO'
    """,
)
def substance_index(t):
    host = F.when(F.col("p_type") == "PROMO", F.lit("https://h.example/")).otherwise("https://dap.ema.europa.eu/")
    link = fill('<a href="%ssaw.dll?P3=1+%s&amp;x=1">part %s</a>', host, text("p_size"), text("p_partkey"))
    link = F.when(F.col("p_type") == "PROMO", F.replace(link, F.lit("saw.dll"), F.lit("other"))).otherwise(F.concat(link, link))
    listed = t.part.select(F.col("p_partkey").alias("page_id"), F.lit("https://h.example/").alias("url"), link.alias("html"))
    return concepts.index_substances(pages.page_links(listed))
