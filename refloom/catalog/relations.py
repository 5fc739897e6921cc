"""Joins, set operations, sorting and limits over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from refloom.catalog import query
from refloom.operators import joins, order, setops
from refloom.operators.select import contains_any
from refloom.operators.similarity import similar
from refloom.session import scratch_path

LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_SQL = ", ".join(LINE_ORDER)


@query(
    "left_join_master",
    """
    SELECT o_orderkey, o_orderstatus, l_linenumber, l_partkey, l_returnflag
    FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey
    """,
)
def left_join_master(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", "l_returnflag")
    return joins.left_attach(t.orders.select("o_orderkey", "o_orderstatus"), lines, ["o_orderkey"])


@query(
    "left_join_lookup",
    """
    SELECT l_orderkey, l_linenumber, l_partkey, p_name FROM lineitem
    LEFT JOIN (SELECT * FROM part WHERE p_type <> 'PROMO') ON l_partkey = p_partkey
    """,
)
def left_join_lookup(t):
    parts = t.part.filter("p_type <> 'PROMO'").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return joins.left_attach(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), parts, ["l_partkey"])


@query(
    "left_join_status",
    """
    SELECT d.doc_id, lang, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    WHERE source IN ('src1', 'src2', 'src3')
    """,
)
def left_join_status(t):
    rows = joins.left_attach(t.documents, t.labels, ["doc_id"])
    return rows.filter(F.col("source").isin("src1", "src2", "src3")).select("doc_id", "lang", "quality")


@query(
    "inner_chain",
    """
    SELECT c_custkey, n_name, r_name FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey WHERE c_mktsegment = 'BUILDING'
    """,
)
def inner_chain(t):
    customers = t.customer.filter("c_mktsegment = 'BUILDING'").withColumnRenamed("c_nationkey", "n_nationkey")
    regions = t.region.withColumnRenamed("r_regionkey", "n_regionkey")
    return joins.chain(customers, ["n_nationkey"], t.nation, ["n_regionkey"], regions).select("c_custkey", "n_name", "r_name")


@query(
    "pending_anti",
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)",
)
def pending_anti(t):
    done = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return joins.pending(t.orders.select("o_orderkey", "o_orderstatus"), done, ["o_orderkey"])


@query(
    "enrich_codes",
    """
    SELECT c_custkey, c_nationkey, coalesce(n_name, '') AS definition FROM customer
    LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 2) ON c_nationkey = n_nationkey
    """,
)
def enrich_codes(t):
    codes = t.nation.filter("n_regionkey <> 2").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("definition"))
    return joins.enrich_codes(t.customer.select("c_custkey", "c_nationkey"), codes, ["c_nationkey"], "definition")


@query(
    "resolve_reference",
    """
    WITH p AS (SELECT *, CASE WHEN p_type IN ('PROMO', 'LARGE') THEN '351(a)' ELSE '351(k)' END AS licence FROM part),
    o AS (SELECT lower(p_brand) AS brand, max(p_partkey) AS number FROM p WHERE licence = '351(a)' AND p_partkey > 0 AND p_brand <> 'Brand#7' GROUP BY 1),
    x AS (SELECT l_partkey, count(*) AS n,
        string_agg(CAST(l_orderkey AS VARCHAR), '; ' ORDER BY l_orderkey, strftime(l_shipdate, '%Y-%m-%d')) AS numbers,
        string_agg(strftime(l_shipdate, '%Y-%m-%d'), '; ' ORDER BY l_orderkey, strftime(l_shipdate, '%Y-%m-%d')) AS dates
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1)
    SELECT p_partkey, CAST(0 AS BIGINT) AS part, coalesce(CAST(o.number AS VARCHAR), 'N/A') AS resolved_reference_number,
      coalesce(n, 0) AS associated_patents_count, coalesce(numbers, '') AS patent_numbers, coalesce(dates, '') AS patent_expirations
    FROM p LEFT JOIN o ON lower(p_brand) = o.brand AND p_size < 40
    LEFT JOIN x ON l_partkey = CASE WHEN licence = '351(a)' THEN nullif(p_partkey, 0) ELSE o.number END
    """,
)
def resolve_reference(t):
    """Parts as products: brand as name, type as licence; returned lines as patents."""
    licence = F.when(F.col("p_type").isin("PROMO", "LARGE"), "351(a)").otherwise("351(k)")
    name = F.when(F.col("p_brand") != "Brand#7", F.concat(F.col("p_brand"), F.lit(" "))).otherwise("N/A")
    products = t.part.select(
        "p_partkey", F.lpad(F.col("p_partkey").cast("string"), 9, "0").alias("number"), name.alias("name"), licence.alias("licence"),
        F.when(F.col("p_size") < 40, F.upper("p_brand")).otherwise("None").alias("reference_name"),
    )
    patents = t.lineitem.filter("l_returnflag = 'R'").select(
        F.col("l_partkey").cast("string").alias("number"), F.col("l_orderkey").alias("patent_number"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("expires"),
    )
    return joins.resolve_reference(products, patents, ["p_partkey"]).select(
        "p_partkey", "part", "resolved_reference_number", "associated_patents_count", "patent_numbers", "patent_expirations"
    )


@query(
    "merge_overwrite",
    """
    SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'second' ELSE 'first' END AS list,
      CASE WHEN c_mktsegment = 'BUILDING' THEN upper(c_name) ELSE c_name END AS c_name
    FROM customer WHERE c_nationkey < 15 OR c_mktsegment = 'BUILDING'
    """,
)
def merge_overwrite(t):
    rows = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    first = rows.filter("c_nationkey < 15").select("c_custkey", F.lit("first").alias("list"), "c_name")
    second = rows.filter("c_mktsegment = 'BUILDING'").select("c_custkey", F.lit("second").alias("list"), F.upper("c_name").alias("c_name"))
    return joins.merge_lists([first, second], ["c_custkey"], ["c_name"])


@query(
    "search_joined",
    """
    SELECT p_partkey, p_name, p_brand FROM part WHERE p_name ILIKE '%ring%'
      OR p_partkey IN (SELECT l_partkey FROM lineitem JOIN supplier ON l_suppkey = s_suppkey WHERE s_name ILIKE '%0009%')
    """,
)
def search_joined(t):
    suppliers = t.supplier.filter(contains_any("0009", ["s_name"])).select("s_suppkey", "s_name")
    lines = t.lineitem.select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")).join(suppliers, "s_suppkey")
    named = joins.search_joined(t.part.select("p_partkey", "p_name", "p_brand"), lines, "p_partkey", "ring", ["p_name"], [])
    by_supplier = joins.search_joined(t.part.select("p_partkey", "p_name", "p_brand"), lines, "p_partkey", "0009", [], ["s_name"])
    return named.union(by_supplier).distinct()


@query(
    "leaf_flag",
    """
    WITH c AS (SELECT DISTINCT 'A' || lpad(CAST(p_size AS VARCHAR), 2, '0') || CASE WHEN p_partkey < 100 THEN '' ELSE '.' || p_partkey // 10 END AS code FROM part),
    p AS (SELECT code, CASE WHEN strpos(code, '.') = 0 THEN NULL WHEN length(split_part(code, '.', 2)) = 1 THEN split_part(code, '.', 1)
      ELSE substring(code, 1, length(code) - 1) END AS parent_code FROM c)
    SELECT code, parent_code, code NOT IN (SELECT parent_code FROM p WHERE parent_code IS NOT NULL) AS is_leaf FROM p
    """,
)
def leaf_flag(t):
    stem = F.concat(F.lit("A"), F.lpad(F.col("p_size").cast("string"), 2, "0"))
    tail = F.when(F.col("p_partkey") < 100, "").otherwise(F.concat(F.lit("."), F.floor(F.col("p_partkey") / 10).cast("string")))
    return joins.leaf_flag(t.part.select(F.concat(stem, tail).alias("code")).distinct())


@query(
    "case_bundle",
    f"""
    WITH ids AS (
      SELECT o_orderkey AS id FROM orders WHERE o_orderpriority ILIKE '%urgent%'
      UNION SELECT l_orderkey FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_name ILIKE '%ring%'),
    top AS (SELECT id FROM ids WHERE id IN (SELECT o_orderkey FROM orders) ORDER BY id LIMIT 5)
    SELECT o_orderkey, o_orderpriority, CAST(0 AS BIGINT) AS part,
      '[' || coalesce((SELECT string_agg('{{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || '}}', ',' ORDER BY l_linenumber, l_partkey)
        FROM lineitem WHERE l_orderkey = o_orderkey), '') || ']' AS drugs,
      '[' || coalesce((SELECT string_agg('{{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || '}}', ',' ORDER BY l_linenumber, l_partkey)
        FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R'), '') || ']' AS reactions
    FROM orders WHERE o_orderkey IN (SELECT id FROM top)
    """,
)
def case_bundle(t):
    reports = t.orders.select("o_orderkey", "o_orderpriority")
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    rings = t.part.filter(contains_any("ring", ["p_name"])).select(F.col("p_partkey").alias("l_partkey"))
    fields = ["o_orderkey", "l_linenumber", "l_partkey"]
    return joins.case_bundle(
        reports,
        {"drugs": lines.select(*fields), "reactions": lines.filter("l_returnflag = 'R'").select(*fields)},
        "o_orderkey",
        [reports.filter(contains_any("urgent", ["o_orderpriority"])), lines.join(rings, "l_partkey", "left_semi")],
        ["l_linenumber", "l_partkey"],
    )


@query("order_export", "SELECT s_suppkey, s_name, s_nationkey FROM supplier ORDER BY s_name DESC, s_suppkey")
def order_export(t):
    return order.order_export(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), F.col("s_name").desc(), "s_suppkey")


@query("top_k", "SELECT o_orderkey, o_custkey FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def top_k(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_totalprice")
    return order.limit_ordered(rows, 20, F.col("o_totalprice").desc(), "o_orderkey").select("o_orderkey", "o_custkey")


@query("page_slice", "SELECT c_custkey, c_name FROM customer ORDER BY c_name, c_custkey LIMIT 50 OFFSET 100")
def page_slice(t):
    return order.page(t.customer.select("c_custkey", "c_name"), 3, 50, ["c_name", "c_custkey"])


@query(
    "page_directory",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS placed FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 700 OFFSET 1400
    """,
)
def page_directory(t):
    """The third page of orders by date, read from a table that was sorted once."""
    path = scratch_path(t.spark, "pages")
    order.write_pages(t.orders.select("o_orderkey", "o_orderdate"), path, ["o_orderdate", "o_orderkey"])
    return order.read_page(t.spark, path, 3, 700).select("o_orderkey", F.year("o_orderdate").alias("placed"))


@query(
    "page_slices",
    "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1) // 50 + 1 AS page FROM orders",
)
def page_slices(t):
    """Every row with its page number: positions come from sorted ranges, not from one window."""
    rows = order.page_slices(t.orders.select("o_orderkey", "o_orderdate"), 50, ["o_orderdate", "o_orderkey"])
    return rows.select("o_orderkey", "page")


@query(
    "limit_per_partition",
    """
    SELECT o_orderpriority, o_orderkey FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) <= 1000 // 5
    """,
)
def limit_per_partition(t):
    return order.limit_per_partition(t.orders.select("o_orderpriority", "o_orderkey"), "o_orderpriority", 1000, 5, ["o_orderkey"])


@query("union_tagged", "SELECT event_id, user_id, event_type AS variant FROM events")
def union_tagged(t):
    rows = t.events.select("event_id", "user_id", "event_type")
    kinds = [r[0] for r in rows.select("event_type").distinct().collect()]
    return setops.union_tagged({k: rows.filter(F.col("event_type") == k).drop("event_type") for k in kinds}, "variant")


@query(
    "union_levels",
    """
    SELECT 'N' || n_nationkey AS code, n_name AS name, 'R' || n_regionkey AS parent_code FROM nation
    UNION ALL SELECT 'R' || r_regionkey, r_name, '' FROM region
    """,
)
def union_levels(t):
    def coded(prefix, name):
        return F.concat(F.lit(prefix), F.col(name).cast("string"))

    nations = t.nation.select(coded("N", "n_nationkey").alias("code"), F.col("n_name").alias("name"), coded("R", "n_regionkey").alias("parent_code"))
    return setops.union_levels(nations, t.region.select(coded("R", "r_regionkey").alias("code"), F.col("r_name").alias("name")))


@query("id_difference", "SELECT o_orderkey AS id FROM orders EXCEPT SELECT l_orderkey FROM lineitem")
def id_difference(t):
    return setops.id_difference(t.orders, t.lineitem, "o_orderkey", "l_orderkey")


@query(
    "id_union",
    "SELECT o_orderkey AS id FROM orders WHERE o_orderstatus = 'F' UNION SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R'",
)
def id_union(t):
    return setops.id_union(
        t.orders.filter("o_orderstatus = 'F'").select("o_orderkey"), t.lineitem.filter("l_returnflag = 'R'").select("l_orderkey")
    )


@query(
    "similarity_threshold",
    """
    WITH v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
    q AS (SELECT label, first(vec_id ORDER BY vec_id) AS query_id FROM v GROUP BY label),
    s AS (
      SELECT v.vec_id, q.query_id, list_inner_product(v.e, w.e) AS d, list_inner_product(v.e, v.e) AS a, list_inner_product(w.e, w.e) AS b
      FROM q JOIN v w ON w.vec_id = q.query_id, v)
    SELECT vec_id, query_id, round(d / (a + b - d), 6) AS score FROM s WHERE d / (a + b - d) >= 0.05
    """,
)
def similarity_threshold(t):
    """One query vector per label (its first), searched in the whole table."""
    from refloom.operators.dedup import dedup_first

    chosen = dedup_first(t.embeddings, ["label"], ["vec_id"])
    chosen = chosen.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vec"))
    hits = similar(t.embeddings, chosen, "embedding", 0.05, ["vec_id"])
    return hits.select("vec_id", "query_id", F.round("score", 6).alias("score"))
