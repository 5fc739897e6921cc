"""Readers and writers over files and documents that Spark writes from the driver tables."""

from __future__ import annotations


from pyspark.sql import functions as F

from refloom.catalog import query
from refloom.functions.text import fill
from refloom.functions.arrays import lookup
from refloom.schemas import DRUG_PRODUCT_FILES
from refloom.session import scratch_path, spread
from refloom.sources import archives, delimited, documents, sinks


def _text(df, line, t, name):
    """Write lines as text files, in parallel, and give the path."""
    path = scratch_path(t.spark, name)
    df.select(line.alias("value")).write.text(path)
    return path


@query(
    "read_positional",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS drug_code, o_orderpriority || ', listed' AS schedule_en,
      CASE WHEN o_orderstatus = 'F' THEN NULL ELSE 'cl ' || o_custkey END AS schedule_fr,
      CASE o_orderstatus WHEN 'F' THEN 'cancelled' WHEN 'O' THEN 'marketed' ELSE 'approved' END AS status_category
    FROM orders
    """,
)
def read_positional(t):
    """Header-less files in one folder per status: short rows for F, exact rows for O, long rows for P."""
    folders = {}
    for code, status, suffix in (("F", "cancelled", "_ia"), ("O", "marketed", ""), ("P", "approved", "_ap")):
        quoted = fill(
            '"%s","%s, listed"', F.col("o_orderkey").cast("string"), F.col("o_orderpriority")
        )
        french = fill(',"cl %s"', F.col("o_custkey").cast("string"))
        line = {"F": quoted, "O": F.concat(quoted, french), "P": F.concat(quoted, french, F.lit(',"x","y"'))}[code]
        folders[status] = scratch_path(t.spark, status)
        rows = t.orders.filter(F.col("o_orderstatus") == code).select(line.alias("value"))
        rows.write.text(f"{folders[status]}/schedule{suffix}.txt")
    return delimited.read_positional(t.spark, folders, "schedule", DRUG_PRODUCT_FILES, tag="status_category")


@query(
    "scan_split",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS "key", p_name AS "name",
      CASE WHEN p_type = 'PROMO' THEN '' ELSE p_brand END AS brand FROM part
    """,
)
def scan_split(t):
    """Tilde separated files with a header in each, short rows for one type, long rows for another."""
    name, brand = F.concat(F.lit("  "), "p_name", F.lit(" ")), F.col("p_brand")
    line = (
        F.when(F.col("p_type") == "PROMO", F.concat_ws("~", "p_partkey", name))
        .when(F.col("p_type") == "LARGE", F.concat_ws("~", "p_partkey", name, brand, F.lit("surplus")))
        .otherwise(F.concat_ws("~", "p_partkey", name, brand))
    )
    path = scratch_path(t.spark, "tilde")
    t.part.select(line.alias("key~name~brand")).write.options(header=True, quote="", sep="\t").csv(path)
    return delimited.read_delimited(t.spark, path, "~")


@query(
    "fold_columns",
    """
    WITH p AS (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
    SELECT doc_id, trim(w[1]) AS first_word, coalesce(trim(w[3]), '') AS third_word,
      md5(coalesce(trim(array_to_string(w[9:], '|')), '')) AS folded
    FROM p
    """,
)
def fold_columns(t):
    rows = spread(t.documents).select("doc_id", F.split("text", " ").alias("w"))
    rows = rows.select("doc_id", delimited.fold_fields("w", 9).alias("p"))
    cells = delimited.fields("p", [f"c{i}" for i in range(9)])
    flat = rows.select("doc_id", *cells)
    return flat.select(
        "doc_id", F.trim("c0").alias("first_word"), F.trim("c2").alias("third_word"), F.md5(F.trim("c8")).alias("folded")
    )


@query(
    "read_mapping",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS code, c_name AS cui FROM customer
    WHERE c_mktsegment NOT IN ('MACHINERY', 'BUILDING')
    """,
)
def read_mapping(t):
    """Map files with comment lines, blank lines, one-part lines and a trailing separator."""
    segment = F.col("c_mktsegment")
    line = (
        F.when(segment == "MACHINERY", F.concat(F.lit("# "), "c_name", F.lit("|x")))
        .when(segment == "BUILDING", F.concat(F.lit("|"), "c_name", F.lit("|")))
        .otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit("| "), "c_name", F.lit(" |")))
    )
    path = _text(t.customer, F.explode(F.array(line, F.lit(""))), t, "map")
    return delimited.read_mapping(t.spark, path, "|", ["code", "cui"])


@query(
    "read_maybe_header",
    """
    SELECT 'S' || s_suppkey AS ncit_code, s_name AS preferred_name,
      CASE WHEN s_nationkey < 10 THEN '' ELSE CAST(s_nationkey AS VARCHAR) END AS column_3 FROM supplier
    """,
)
def read_maybe_header(t):
    """Rows of two and three cells, without a header."""
    code = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    line = F.when(F.col("s_nationkey") < 10, F.concat_ws("\t", code, "s_name")).otherwise(
        F.concat_ws("\t", code, "s_name", "s_nationkey")
    )
    return delimited.read_maybe_header(t.spark, _text(t.supplier, line, t, "agents"))


@query(
    "read_sections",
    """
    SELECT strftime(o_orderdate, '%Y-%m-%d') AS file,
      CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS section,
      o_orderkey || ',' || o_custkey AS line
    FROM orders WHERE o_orderstatus <> 'P'
    """,
)
def read_sections(t):
    """A file per order day with two tables in it, each below its header line, and noise around them."""
    rank = F.when(F.col("o_orderstatus") == "F", 1).when(F.col("o_orderstatus") == "O", 3).otherwise(-1)
    file = F.date_format("o_orderdate", "yyyy-MM-dd").alias("file")
    data = t.orders.select(
        file, rank.alias("block"), F.col("o_orderkey").alias("seq"),
        F.concat_ws(",", "o_orderkey", F.when(rank > 0, F.col("o_custkey"))).alias("line"),
    )
    days = data.select("file").distinct()
    extra = F.explode(F.array(
        F.struct(F.lit(0).alias("block"), F.lit("Applicant,BLA Number").alias("line")),
        F.struct(F.lit(1).alias("block"), F.lit(" ,,").alias("line")),
        F.struct(F.lit(2).alias("block"), F.lit("BLA Number,Proprietary Name").alias("line")),
    ))
    marks = days.select("file", extra.alias("x")).select("file", "x.block", F.lit(-1).cast("long").alias("seq"), "x.line")
    header = F.contains("line", F.lit("Applicant,BLA Number")) | F.contains("line", F.lit("BLA Number,Proprietary Name"))
    rows = delimited.number_sections(data.unionByName(marks), header)
    return rows.filter("not is_header").select("file", F.col("section").cast("int").alias("section"), "line")


@query(
    "sink_roundtrip",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name || chr(10) || '"' || p_size || '",' || chr(10) AS p_name,
      coalesce(nullif(p_brand, 'Brand#1'), '') AS p_brand, p_type || '; ' || p_name AS tags, '' AS missing
    FROM part
    """,
)
def sink_roundtrip(t):
    """CSV and back: line breaks and quotes stay, NULL becomes empty, a list its packed text, an undeclared column is dropped."""
    rows = t.part.select(
        "p_partkey", F.concat("p_name", F.lit('\n"'), F.col("p_size").cast("string"), F.lit('",\n')).alias("p_name"), F.nullif("p_brand", F.lit("Brand#1")).alias("p_brand"),
        F.array("p_type", "p_name").alias("tags"), "p_size",
    )
    columns = ["p_partkey", "p_name", "p_brand", "tags", "missing"]
    path = scratch_path(t.spark, "csv")
    sinks.write_dataset(rows, path, "csv", columns, {"tags": "; "})
    return sinks.read_written(t.spark, path, columns)


@query(
    "scan_two_headers",
    """
    SELECT CAST(p_partkey AS VARCHAR) AS key, p_name AS name, CASE WHEN p_size < 25 THEN p_brand ELSE '' END AS brand,
      CASE WHEN p_size < 25 THEN '' ELSE p_type END AS kind FROM part
    UNION ALL SELECT 'key', 'name', 'brand', '' FROM region
    """,
)
def scan_two_headers(t):
    """Files with other columns in another order, and rows below the first line that look like a header."""
    path = scratch_path(t.spark, "tilde")
    small = t.part.filter("p_size < 25").select(F.concat_ws("~", "p_partkey", "p_name", "p_brand").alias("key~name~brand"))
    fake = t.region.select(F.lit("key~name~brand").alias("key~name~brand"))
    large = t.part.filter("p_size >= 25").select(F.concat_ws("~", "p_type", "p_partkey", "p_name").alias("kind~key~name"))
    options = {"header": True, "quote": "", "sep": "\t"}
    small.unionByName(fake).write.options(**options).csv(f"{path}/a")
    large.write.options(**options).csv(f"{path}/b")
    return delimited.read_delimited(t.spark, [f"{path}/a", f"{path}/b"], "~")


@query(
    "read_results_files",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS report, o_orderpriority AS kind, o_custkey % 7 AS n FROM orders
    """,
)
def read_results_files(t):
    """One payload file per order status and priority, each a single document with all its records."""
    path = scratch_path(t.spark, "payloads")
    record = F.to_json(F.struct(F.col("o_orderkey").cast("string").alias("report"), F.col("o_orderpriority").alias("kind"), (F.col("o_custkey") % 7).alias("n")))
    body = F.concat(F.lit('{"meta": {"n": 1},\n "results": [\n'), F.array_join(F.collect_list(record), ",\n"), F.lit("]}"))
    files = t.orders.groupBy("o_orderstatus", "o_orderpriority").agg(body.alias("value"))
    files.repartition(15, "o_orderstatus", "o_orderpriority").write.partitionBy("o_orderstatus", "o_orderpriority").text(path)
    return documents.read_results_json(t.spark, f"{path}/*/*", "report string, kind string, n long")


@query(
    "read_header_table",
    "SELECT 'S' || s_suppkey AS \"Concept Code\", s_name AS col_2, CASE WHEN s_nationkey < 10 THEN '' ELSE 'x' END AS column_3 FROM supplier",
)
def read_header_table(t):
    """A header line in every file, with an empty cell, narrower than some rows."""
    code = F.concat(F.lit("S"), F.col("s_suppkey").cast("string"))
    line = F.concat_ws("\t", code, "s_name", F.when(F.col("s_nationkey") >= 10, F.lit("x")))
    path = scratch_path(t.spark, "titled")
    rows = t.supplier.select(line.alias("Concept Code\t"))
    rows.repartition(3).write.options(header=True, quote="", sep="\u0001", ignoreTrailingWhiteSpace=False).csv(path)
    return delimited.read_maybe_header(t.spark, path)


@query(
    "section_tables",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS "BLA Number", c_name AS "Proprietary Name", CASE WHEN c_nationkey < 12 THEN c_mktsegment END AS "License Type"
    FROM customer
    """,
)
def section_tables(t):
    """Files of two tables; the second one's columns come in another order, and one less, in some of them."""
    path = scratch_path(t.spark, "sections")

    def folder(name, rows, header, line):
        text = F.concat_ws("\n", F.lit("Applicant,Product"), F.lit("a,b"), F.lit(header), F.array_join(F.sort_array(F.collect_list(line)), "\n"))
        rows.groupBy("c_nationkey").agg(text.alias("value")).select("value").repartition(4).write.text(f"{path}/{name}")

    early, late = t.customer.filter("c_nationkey < 12"), t.customer.filter("c_nationkey >= 12")
    folder("a", early, "BLA Number,Proprietary Name,License Type", F.concat_ws(",", "c_custkey", "c_name", "c_mktsegment"))
    folder("b", late, "Proprietary Name,BLA Number", F.concat(F.lit('"'), "c_name", F.lit('",'), F.col("c_custkey").cast("string")))
    header = F.col("line").startswith("Applicant,") | F.contains("line", F.lit("BLA Number"))
    found = delimited.read_sections(t.spark, [f"{path}/a", f"{path}/b"], header)
    # Several tables stand below each other in a file: all even sections have the same kind of table.
    return delimited.section_table(found.withColumn("section", (F.col("section") - 1) % 2), 1)


@query("sink_json", "SELECT o_orderkey, o_orderpriority, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders")
def sink_json(t):
    """Arrays of records, one in each file, and back."""
    path = scratch_path(t.spark, "json")
    rows = t.orders.select("o_orderkey", "o_orderpriority", F.nullif("o_orderstatus", F.lit("P")).alias("o_orderstatus"))
    sinks.write_dataset(rows, path, "json")
    return t.spark.read.schema("o_orderkey long, o_orderpriority string, o_orderstatus string").json(path, multiLine=True)


@query(
    "sink_jsonl",
    "SELECT o_orderkey, o_orderpriority, nullif(o_orderstatus, 'P') AS o_orderstatus FROM orders",
)
def sink_jsonl(t):
    path = scratch_path(t.spark, "jsonl")
    rows = t.orders.withColumn("o_orderstatus", F.nullif("o_orderstatus", F.lit("P")))
    sinks.write_dataset(rows, path, "jsonl", ["o_orderkey", "o_orderpriority", "o_orderstatus"])
    return documents.read_json_lines(t.spark, path, "o_orderkey long, o_orderpriority string, o_orderstatus string")


@query("json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_props(t):
    return t.events.select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@query(
    "results_json",
    "SELECT o_orderkey AS id, o_orderstatus AS status FROM orders",
)
def results_json(t):
    """A payload per customer and slice with its orders under ``results``."""
    from refloom.operators.aggregate import ordered_list

    record = F.struct(F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"))
    payloads = ordered_list(t.orders, ["o_custkey"], record, ["o_orderkey"], "results")
    payloads = payloads.select(F.to_json(F.struct("results")).alias("payload"))
    return documents.parse_results(payloads, "payload", "id long, status string")


@query(
    "xml_records",
    """
    SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer WHERE c_mktsegment <> 'BUILDING'
    """,
)
def xml_records(t):
    """XML files with one row tag; records without a name are skipped."""
    path = scratch_path(t.spark, "xml")
    rows = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("name"),
        F.struct(F.col("c_mktsegment").alias("segment")).alias("details"),
    )
    rows.write.format("xml").options(rootTag="Customers", rowTag="Customer").save(path)
    schema = "id long, name string, details struct<segment: string>"
    read = documents.read_xml_records(t.spark, path, "Customer", schema, ("id", "name"))
    return read.select("id", "name", "details.segment")


@query(
    "zip_members",
    """
    SELECT doc_id, i - 1 AS pos, md5(lines[i]) AS digest
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents), LATERAL (SELECT unnest(range(1, len(lines) + 1)) AS i)
    WHERE NOT (i = len(lines) AND lines[i] = '')
    """,
)
def zip_members(t):
    """Documents written into archives, each next to a note, then read back from the files line by line."""
    path = scratch_path(t.spark, "archives")
    name = F.concat(F.lit("texts/"), F.col("doc_id").cast("string"))
    members = t.documents.select(F.explode(F.array(
        F.struct(F.concat(name, F.lit(".TXT")).alias("name"), F.col("text").alias("content")),
        F.struct(F.concat(name, F.lit(".md")).alias("name"), F.lit("not data").alias("content")),
    )).alias("m")).select("m.*")
    archives.write_archives(spread(members), path, "name", "content")
    lines = archives.read_zip_members(t.spark, f"{path}/*.zip", ".txt", partition_bytes=1 << 20)
    doc_id = F.regexp_extract("member", r"(\d+)\.TXT$", 1).cast("long")
    return lines.select(doc_id.alias("doc_id"), "pos", F.md5("line").alias("digest"))


@query(
    "decode_fallback",
    """
    SELECT doc_id, md5(text) AS from_utf8,
      md5(regexp_replace(text, '[^\\x{00}-\\x{ff}]', '?', 'g')) AS from_latin1
    FROM documents
    """,
)
def decode_fallback(t):
    latin = F.encode(F.regexp_replace("text", r"[^\x00-\xff]", "?"), "ISO-8859-1")
    return t.documents.select(
        "doc_id",
        F.md5(documents.decode_fallback(F.encode("text", "UTF-8"))).alias("from_utf8"),
        F.md5(documents.decode_fallback(latin)).alias("from_latin1"),
    )


@query(
    "consolidate_union",
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), s_name, '' FROM supplier
    """,
)
def consolidate_union(t):
    """Two partition folders of one dataset, one without a column, read as one table."""
    columns = ["id", "name", "segment"]
    first, second = scratch_path(t.spark, "part"), scratch_path(t.spark, "part")
    customers = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    sinks.write_dataset(customers, first, "csv", columns)
    sinks.write_dataset(suppliers, second, "csv", columns)
    return sinks.consolidate(t.spark, [first, second], columns)


@query(
    "json_flat",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, props AS payload,
      event_type || ';' || user_id AS tags, coalesce(nullif(event_type, 'view'), '') AS kind
    FROM events
    """,
)
def json_flat(t):
    """Lists joined, structs kept as JSON, missing values empty, columns by name."""
    payload = F.from_json("props", "k long")
    rows = t.events.select(
        "event_id", F.nullif("event_type", F.lit("view")).alias("kind"),
        F.array("event_type", F.col("user_id").cast("string")).alias("tags"), payload.alias("payload"),
    )
    flat = sinks.json_to_flat(rows)
    return flat.withColumn("payload", F.replace("payload", F.lit(":"), F.lit(": ")))


@query(
    "property_lookup",
    """
    SELECT l_orderkey, coalesce(max(l_partkey) FILTER (WHERE l_returnflag = 'A' AND l_linestatus = 'F' AND l_linenumber > 2),
      min(l_suppkey) FILTER (WHERE l_returnflag = 'A' AND l_suppkey % 3 <> 0)) AS found
    FROM lineitem GROUP BY l_orderkey
    """,
)
def property_lookup(t):
    """Kind to value lists: the last calculated value, else the first experimental one that is not empty; NULL without any."""
    from refloom.operators.aggregate import ordered_list

    def listed(value, kind, known, out):
        shown = F.when(known, F.col(value).cast("string")).otherwise("")
        return ordered_list(t.lineitem, ["l_orderkey"], F.struct(kind.alias("kind"), shown.alias("value")), [value], out)

    late = (F.col("l_linestatus") == "F") & (F.col("l_linenumber") > 2)
    kind = F.when(late, F.col("l_returnflag")).otherwise("other")
    calculated = listed("l_partkey", kind, F.lit(True), "calculated")
    measured = listed("l_suppkey", F.col("l_returnflag"), F.col("l_suppkey") % 3 != 0, "experimental")
    found = lookup([F.col("calculated"), F.col("experimental")], "A")
    rows = calculated.join(measured, ["l_orderkey", "part"])
    return rows.select("l_orderkey", F.nullif(found, F.lit("")).cast("long").alias("found"))
