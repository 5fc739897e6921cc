"""Grouped text, lists, deduplication and windows over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from refloom.catalog import REGISTRY, query
from refloom.functions.arrays import distinct_ordered, rebuild_text
from refloom.functions.arrays import first_of_first as first_institution
from refloom.functions.text import exclusivity_detail, patent_detail
from refloom.operators import aggregate as agg
from refloom.operators import dedup, joins
from refloom.operators.records import lines_to_fields
from refloom.operators.skew import number_rows
from refloom.session import materialize, scratch_path, spread

# All columns of a line item: (l_orderkey, l_linenumber) is not unique.
LINE_ORDER = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]
LINE_SQL = ", ".join(LINE_ORDER)


def cents(name: str):
    return F.round(F.col(name) * 100).cast("long")


@query(
    "group_concat_master",
    """
    WITH c AS (
      SELECT l_orderkey,
        string_agg('part ' || l_partkey || ' (' || CAST(l_quantity AS BIGINT) || ' ' || nullif(l_returnflag, 'N') || ')', '; '
          ORDER BY 'part ' || l_partkey || ' (' || CAST(l_quantity AS BIGINT) || ' ' || nullif(l_returnflag, 'N') || ')') AS items,
        string_agg('supplier ' || l_suppkey, '; ' ORDER BY 'supplier ' || l_suppkey) AS suppliers,
        string_agg(l_linestatus, '; ' ORDER BY l_linestatus) AS states
      FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(0 AS BIGINT) AS part, items, suppliers, states
    FROM orders LEFT JOIN c ON o_orderkey = l_orderkey
    """,
)
def group_concat_master(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    # A NULL part makes the whole text NULL, and a NULL text is skipped.
    item = F.concat(
        F.lit("part "), F.col("l_partkey").cast("string"), F.lit(" ("),
        F.col("l_quantity").cast("long").cast("string"), F.lit(" "), F.nullif("l_returnflag", F.lit("N")), F.lit(")"),
    )
    supplier = F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string"))
    return agg.text_master(
        t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"),
        ["o_orderkey"],
        [
            agg.Child("items", lines, item),
            agg.Child("suppliers", lines, supplier),
            agg.Child("states", lines, F.col("l_linestatus")),
        ],
    )


@query(
    "group_concat_parts",
    """
    WITH r AS (
      SELECT o_orderpriority, o_orderkey, (row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) - 1) // 500 AS part
      FROM orders)
    SELECT o_orderpriority, part, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS ids
    FROM r GROUP BY o_orderpriority, part
    """,
)
def group_concat_parts(t):
    """Groups far over the size limit: the same text, in slices, without one task per group."""
    return agg.ordered_text(
        t.orders, ["o_orderpriority"], F.col("o_orderkey").cast("string"), ",", [F.col("o_orderkey")], "ids", limit=500
    )


@query(
    "nested_master",
    f"""
    WITH c AS (
      SELECT l_orderkey,
        string_agg('{{"l_linenumber":' || l_linenumber || ',"l_partkey":' || l_partkey || ',"l_suppkey":' || l_suppkey
          || ',"l_returnflag":"' || l_returnflag || '"}}', ',' ORDER BY {LINE_SQL}) AS items
      FROM lineitem GROUP BY l_orderkey)
    SELECT o_orderkey, CAST(0 AS BIGINT) AS part, o_orderstatus, '[' || coalesce(items, '') || ']' AS items
    FROM orders LEFT JOIN c ON o_orderkey = l_orderkey
    """,
)
def nested_master(t):
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")
    item = F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    rows = agg.nested_master(
        t.orders.select("o_orderkey", "o_orderstatus"), ["o_orderkey"], [agg.Child("items", lines, item, LINE_ORDER)]
    )
    return rows.withColumn("items", F.to_json("items"))


@query(
    "first_non_null",
    f"""
    SELECT l_orderkey,
      first(nullif(l_returnflag, 'N') ORDER BY {LINE_SQL}) FILTER (WHERE l_returnflag <> 'N') AS l_returnflag,
      first(CASE WHEN l_discount > 0.05 THEN '' ELSE l_linestatus END ORDER BY {LINE_SQL})
        FILTER (WHERE NOT l_discount > 0.05) AS l_linestatus,
      first(l_partkey ORDER BY {LINE_SQL}) AS l_partkey
    FROM lineitem GROUP BY l_orderkey
    """,
)
def first_non_null(t):
    rows = t.lineitem.withColumns({
        "flag": F.nullif("l_returnflag", F.lit("N")),
        "state": F.when(F.col("l_discount") > 0.05, "").otherwise(F.col("l_linestatus")),
    })
    first = agg.first_non_null(rows, ["l_orderkey"], ["flag", "state", "l_partkey"], LINE_ORDER)
    return first.withColumnsRenamed({"flag": "l_returnflag", "state": "l_linestatus"})


@query(
    "union_lists",
    """
    WITH i AS (
      SELECT DISTINCT lang, trim(x) AS item
      FROM (SELECT lang, unnest(string_split(source || ', ' || source || ',,' || lang, ',')) AS x FROM documents)
      WHERE trim(x) <> '')
    SELECT lang, CAST(0 AS BIGINT) AS part, string_agg(item, ',' ORDER BY item) AS sources FROM i GROUP BY lang
    """,
)
def union_lists(t):
    packed = t.documents.select(
        "lang", F.concat("source", F.lit(", "), "source", F.lit(",,"), "lang").alias("packed")
    )
    return agg.union_lists(packed, ["lang"], "packed", ",", "sources")


@query(
    "dataset_stats",
    """
    SELECT l_returnflag, count(*) AS n_rows, count(DISTINCT l_orderkey) AS n_l_orderkey,
      count(DISTINCT l_partkey) AS n_l_partkey, CAST(sum(l_linenumber) AS BIGINT) AS sum_l_linenumber
    FROM lineitem GROUP BY l_returnflag
    """,
)
def dataset_stats(t):
    return agg.dataset_stats(t.lineitem, ["l_returnflag"], ["l_orderkey", "l_partkey"], ["l_linenumber"])


@query("status_counts", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def status_counts(t):
    return agg.status_counts(t.orders, "o_orderstatus")


@query(
    "longest_wins",
    """
    SELECT source, first(lang ORDER BY doc_id) FILTER (WHERE lang <> 'en') AS lang,
      first(md5(text) ORDER BY length(text) DESC, doc_id) AS digest
    FROM documents GROUP BY source
    """,
)
def longest_wins(t):
    rows = t.documents.withColumn("lang", F.when(F.col("lang") != "en", F.col("lang")).otherwise(""))
    return agg.longest_wins(rows, ["source"], "text", "lang", "doc_id").select("source", "lang", F.md5("text").alias("digest"))


@query(
    "union_columns",
    """
    SELECT event_id, CAST(json_extract(props, '$.k') AS VARCHAR) AS k,
      CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS click,
      CASE WHEN event_type = 'error' THEN CAST(user_id AS VARCHAR) END AS error,
      CASE WHEN event_type = 'purchase' THEN CAST(user_id AS VARCHAR) END AS purchase,
      CASE WHEN event_type = 'signup' THEN CAST(user_id AS VARCHAR) END AS signup,
      CASE WHEN event_type = 'view' THEN CAST(user_id AS VARCHAR) END AS "view"
    FROM events
    """,
)
def union_columns(t):
    props = F.from_json("props", "map<string,string>")
    record = F.map_concat(props, F.create_map("event_type", F.col("user_id").cast("string")))
    return agg.union_columns(t.events.select("event_id", record.alias("record")), "record", ["event_id"], ["k"])


@query("distinct_ids", "SELECT DISTINCT l_partkey FROM lineitem")
def distinct_ids(t):
    return agg.distinct_ids(t.lineitem, "l_partkey")


@query(
    "build_tree",
    """
    WITH c AS (
      SELECT c_nationkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY 'C' || c_custkey) - 1) // 1000 AS part,
        'C' || c_custkey AS code, c_name FROM customer),
    n AS (
      SELECT n_nationkey, n_name, n_regionkey, coalesce(part, 0) AS part,
        '{"code":"N' || n_nationkey || '","name":"' || n_name || '","children":[' ||
        coalesce(string_agg('{"code":"' || code || '","name":"' || c_name || '"}', ',' ORDER BY code), '') || ']}' AS node
      FROM nation LEFT JOIN c ON n_nationkey = c_nationkey GROUP BY n_nationkey, n_name, n_regionkey, part),
    r AS (
      SELECT 'R' || r_regionkey AS code, '{"code":"R' || r_regionkey || '","name":"' || r_name || '","children":[' ||
        coalesce(string_agg(node, ',' ORDER BY 'N' || n_nationkey, part), '') || ']}' AS node
      FROM region LEFT JOIN n ON r_regionkey = n_regionkey AND n_regionkey > 0 GROUP BY r_regionkey, r_name),
    orphans AS (SELECT 'N' || n_nationkey AS code, node, part FROM n WHERE n_regionkey = 0)
    SELECT code, CAST(0 AS BIGINT) AS part, node FROM r UNION ALL SELECT code, part, node FROM orphans
    """,
)
def build_tree(t):
    """Three levels; the nations of region 0 name a parent that does not exist and become roots."""
    return agg.build_tree(_tree_levels(t), limit=1000)


def _tree_levels(t):
    def coded(prefix, col):
        return F.concat(F.lit(prefix), F.col(col).cast("string"))

    regions = t.region.select(coded("R", "r_regionkey").alias("code"), F.lit("").alias("parent_code"), F.col("r_name").alias("name"))
    parent = F.when(F.col("n_regionkey") > 0, coded("R", "n_regionkey")).otherwise("gone")
    nations = t.nation.select(coded("N", "n_nationkey").alias("code"), parent.alias("parent_code"), F.col("n_name").alias("name"))
    customers = t.customer.select(
        coded("C", "c_custkey").alias("code"), coded("N", "c_nationkey").alias("parent_code"), F.col("c_name").alias("name")
    )
    return [regions, nations, customers]


@query(
    "tree_lines",
    """
    WITH nodes AS (
      SELECT ['R' || r_regionkey] AS path, '{"code":"R' || r_regionkey || '","name":"' || r_name || '"' AS own, false AS leaf FROM region
      UNION ALL SELECT CASE WHEN n_regionkey > 0 THEN ['R' || n_regionkey, 'N' || n_nationkey] ELSE ['N' || n_nationkey] END,
        '{"code":"N' || n_nationkey || '","name":"' || n_name || '"', false FROM nation
      UNION ALL SELECT CASE WHEN n_regionkey > 0 THEN ['R' || n_regionkey] ELSE [] END || ['N' || c_nationkey, 'C' || c_custkey],
        '{"code":"C' || c_custkey || '","name":"' || c_name || '"', true FROM customer JOIN nation ON c_nationkey = n_nationkey),
    placed AS (
      SELECT path[1] AS root, row_number() OVER w AS pos, own, leaf, len(path) AS depth, lead(len(path)) OVER w AS after
      FROM nodes WINDOW w AS (PARTITION BY path[1] ORDER BY path))
    SELECT root, pos, own || CASE WHEN after > depth THEN ',"children":[' ELSE
      CASE WHEN leaf THEN '}' ELSE ',"children":[]}' END || repeat(']}', (depth - coalesce(after, 1))::INT) || CASE WHEN after IS NULL THEN '' ELSE ',' END END AS text
    FROM placed
    """,
)
def tree_lines(t):
    """The trees of ``build_tree`` as text in pieces, in pre-order."""
    return agg.tree_lines(_tree_levels(t))


@query(
    "partition_stats",
    """
    SELECT count(*) AS n_rows, CAST(sum(user_id) AS BIGINT) AS sum_user_id, true AS users_near, true AS types_near, 2 AS n_parts FROM events
    """,
)
def partition_stats(t):
    """Two partitions of events, counted at different times; distinct counts are merged from sketches and held against exact ones."""
    path = scratch_path(t.spark, "stats")
    rows = t.events.withColumn("half", (F.col("event_id") % 2).cast("string"))
    for half in ("0", "1"):
        stats = agg.add_partitions(rows.filter(F.col("half") == half), path, "half", ["user_id", "event_type"], ["user_id"])
    merged = agg.merge_stats(stats)
    exact = t.events.agg(F.countDistinct("user_id").alias("users"), F.countDistinct("event_type").alias("types"))
    parts = stats.agg(F.countDistinct("half").cast("int").alias("n_parts"))

    def near(found, true):
        return (F.abs(F.col(found) - F.col(true)) <= 0.04 * F.col(true))

    joined = merged.withColumn("_one", F.lit(1)).join(exact.withColumn("_one", F.lit(1)), "_one").join(parts.withColumn("_one", F.lit(1)), "_one")
    return joined.select("n_rows", "sum_user_id", near("n_user_id", "users").alias("users_near"), near("n_event_type", "types").alias("types_near"), "n_parts")


@query(
    "flat_profile",
    f"""
    WITH p AS (
      SELECT l_orderkey,
        first(l_returnflag ORDER BY {LINE_SQL}) FILTER (WHERE l_returnflag <> 'N') AS flag,
        first(l_linestatus ORDER BY {LINE_SQL}) AS state
      FROM lineitem GROUP BY l_orderkey),
    s AS (SELECT l_orderkey, string_agg(x, ',' ORDER BY x) AS suppliers
          FROM (SELECT DISTINCT l_orderkey, CAST(l_suppkey AS VARCHAR) AS x FROM lineitem) GROUP BY l_orderkey),
    d AS (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R')
    SELECT o_orderkey, o_orderstatus, flag, state, CAST(0 AS BIGINT) AS part, suppliers, l_partkey
    FROM orders LEFT JOIN p ON o_orderkey = p.l_orderkey LEFT JOIN s ON o_orderkey = s.l_orderkey
      LEFT JOIN d ON o_orderkey = d.l_orderkey
    """,
)
def flat_profile(t):
    """Order facts merged from its lines, then one row per returned part, or one row when there is none."""
    lines = t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey").withColumn("flag", F.nullif("l_returnflag", F.lit("N")))
    facts = agg.first_non_null(lines, ["o_orderkey"], ["flag", "l_linestatus"], LINE_ORDER).withColumnRenamed("l_linestatus", "state")
    packed = lines.select("o_orderkey", F.col("l_suppkey").cast("string").alias("suppliers"))
    suppliers = agg.union_lists(packed, ["o_orderkey"], "suppliers")
    returned = lines.filter("l_returnflag = 'R'").select("o_orderkey", "l_partkey").distinct()
    base = t.orders.select("o_orderkey", "o_orderstatus").join(facts, "o_orderkey", "left")
    returned = returned.withColumn("part", F.lit(0).cast("long"))
    return agg.attach_parts(base, ["o_orderkey"], [suppliers]).join(returned, ["o_orderkey", "part"], "left")


@query(
    "cogroup_unify",
    """
    WITH a AS (
      SELECT l_partkey, count(*) AS patents_count,
        string_agg('Patent ' || l_orderkey || ' (Exp: ' || strftime(l_shipdate, '%Y-%m-%d') || ')'
          || CASE WHEN l_linestatus = 'O' THEN ' [Use: O - open]' ELSE '' END, ' | '
          ORDER BY 'Patent ' || l_orderkey || ' (Exp: ' || strftime(l_shipdate, '%Y-%m-%d') || ')'
          || CASE WHEN l_linestatus = 'O' THEN ' [Use: O - open]' ELSE '' END) AS patents_list
      FROM lineitem WHERE l_returnflag = 'A' GROUP BY l_partkey),
    b AS (
      SELECT l_partkey, count(*) AS exclusivities_count,
        string_agg('Exclusivity ' || l_linestatus || ' (Exp: ' || strftime(l_shipdate, '%Y-%m-%d') || ') [tier ' || l_linenumber || ']', ' | '
          ORDER BY 'Exclusivity ' || l_linestatus || ' (Exp: ' || strftime(l_shipdate, '%Y-%m-%d') || ') [tier ' || l_linenumber || ']') AS exclusivities_list
      FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_partkey)
    SELECT p_partkey, p_name, CAST(0 AS BIGINT) AS part, coalesce(patents_list, '') AS patents_list,
      coalesce(exclusivities_list, '') AS exclusivities_list,
      coalesce(patents_count, 0) AS patents_count, coalesce(exclusivities_count, 0) AS exclusivities_count
    FROM part LEFT JOIN a ON p_partkey = a.l_partkey LEFT JOIN b ON p_partkey = b.l_partkey
    """,
)
def cogroup_unify(t):
    lines = t.lineitem.withColumnRenamed("l_partkey", "p_partkey").withColumn("expires", F.date_format("l_shipdate", "yyyy-MM-dd"))
    open_use = F.when(F.col("l_linestatus") == "O", F.lit("O"))
    patents = patent_detail(F.col("l_orderkey"), F.col("expires"), open_use, F.lit("open"))
    exclusive = exclusivity_detail(
        F.col("l_linestatus"), F.col("expires"), F.concat(F.lit("tier "), F.col("l_linenumber").cast("string"))
    )
    return joins.cogroup_details(
        t.part.select("p_partkey", "p_name"),
        ["p_partkey"],
        [
            ("patents", lines.filter("l_returnflag = 'A'"), patents),
            ("exclusivities", lines.filter("l_returnflag = 'R'"), exclusive),
        ],
    )


@query(
    "dedup_first",
    f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity, l_returnflag
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {LINE_SQL}) = 1
    """,
)
def dedup_first(t):
    rows = dedup.dedup_first(t.lineitem, ["l_orderkey", "l_linenumber"], LINE_ORDER)
    return rows.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("quantity"), "l_returnflag"
    )


@query(
    "dedup_last",
    """
    SELECT user_id, event_type, event_id FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1
    """,
)
def dedup_last(t):
    return dedup.dedup_last(t.events.select("user_id", "event_type", "event_id"), ["user_id", "event_type"], ["event_id"])


@query(
    "upsert_latest",
    """
    WITH delta AS (
      SELECT o_orderkey, o_custkey, 'Z' AS o_orderstatus, o_orderpriority || ' revised' AS o_orderpriority FROM orders
      WHERE o_orderstatus = 'P'
      UNION ALL SELECT -1 - o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus = 'F'),
    base AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders)
    SELECT coalesce(d.o_orderkey, b.o_orderkey) AS o_orderkey, coalesce(d.o_custkey, b.o_custkey) AS o_custkey,
      coalesce(d.o_orderstatus, b.o_orderstatus) AS o_orderstatus, coalesce(b.o_orderpriority, d.o_orderpriority) AS o_orderpriority
    FROM base b FULL JOIN delta d ON b.o_orderkey = d.o_orderkey
    """,
)
def upsert_latest(t):
    """Changed rows replace, new ones are added; the priority stays as first seen."""
    base = t.orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    changed = base.filter("o_orderstatus = 'P'").withColumns(
        {"o_orderstatus": F.lit("Z"), "o_orderpriority": F.concat("o_orderpriority", F.lit(" revised"))}
    )
    added = base.filter("o_orderstatus = 'F'").withColumn("o_orderkey", F.lit(-1).cast("long") - F.col("o_orderkey"))
    return dedup.upsert(base, changed.unionByName(added), ["o_orderkey"], ["o_custkey"], keep=["o_orderpriority"])


@query(
    "array_distinct",
    """
    WITH w AS (
      SELECT doc_id, word, min(i) AS i FROM (
        SELECT doc_id, unnest(string_split(text, ' ')) AS word, generate_subscripts(string_split(text, ' '), 1) AS i FROM documents)
      GROUP BY doc_id, word)
    SELECT doc_id, count(*) AS n_words, md5(string_agg(word, ' ' ORDER BY i)) AS digest FROM w GROUP BY doc_id
    """,
)
def array_distinct(t):
    words = distinct_ordered(F.split("text", " "))
    rows = spread(t.documents).select("doc_id", words.alias("words"))
    return rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.md5(F.array_join("words", " ")).alias("digest"))


@query(
    "suffix_duplicates",
    """
    WITH f AS (SELECT conv_id, turn, role, text, first_value(text) OVER (PARTITION BY conv_id, role ORDER BY turn) AS t0,
                 row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS r FROM conversations),
    k AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY turn) AS n FROM f WHERE r = 1 OR text <> t0)
    SELECT conv_id, turn, CASE WHEN n = 1 THEN role ELSE role || ' (' || n || ')' END AS label, md5(text) AS digest FROM k
    """,
)
def suffix_duplicates(t):
    rows = t.conversations.select("conv_id", "turn", F.col("role").alias("label"), "text")
    rows = dedup.suffix_duplicates(rows, ["conv_id"], "label", "text", ["turn"])
    return rows.select("conv_id", "turn", "label", F.md5("text").alias("digest"))


@query(
    "number_rows_hot",
    "SELECT o_orderstatus, o_orderkey, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey DESC) AS rn FROM orders",
)
def number_rows_hot(t):
    """Row numbers of groups far over the size limit, by sorted ranges."""
    rows = t.orders.select("o_orderstatus", "o_orderkey")
    return number_rows(rows, ["o_orderstatus"], [F.col("o_orderkey").desc()], limit=1000)


EITHER_SQL = """
    WITH RECURSIVE e AS (
      SELECT event_type, event_id, CAST(nullif(user_id, 0) AS VARCHAR) AS "user", json_extract_string(props, '$.k') AS k,
        row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events),
    r AS (
      SELECT DISTINCT event_type, CAST(0 AS BIGINT) AS n, false AS ok, CAST([] AS VARCHAR[]) AS us, CAST([] AS VARCHAR[]) AS ks FROM e
      UNION ALL
      SELECT event_type, n, ok, CASE WHEN ok AND "user" IS NOT NULL THEN list_append(us, "user") ELSE us END,
        CASE WHEN ok AND k IS NOT NULL THEN list_append(ks, k) ELSE ks END
      FROM (
        SELECT e.event_type, e.n, us, ks, "user", k, coalesce(NOT list_contains(us, "user"), true) AND coalesce(NOT list_contains(ks, k), true) AS ok
        FROM r JOIN e ON e.event_type = r.event_type AND e.n = r.n + 1))
    SELECT e.event_type, event_id, "user", k FROM e JOIN r ON e.event_type = r.event_type AND e.n = r.n WHERE ok
    """


@query("dedup_either", EITHER_SQL)
def dedup_either(t):
    """Per event type: drop an event whose user or whose property was already accepted."""
    rows = t.events.select(
        "event_type", "event_id", F.nullif(F.col("user_id"), F.lit(0)).cast("string").alias("user"),
        F.get_json_object("props", "$.k").alias("k"),
    )
    return dedup.dedup_either(rows, ["event_type"], "user", "k", ["event_id"])


@query("dedup_either_rounds", EITHER_SQL)
def dedup_either_rounds(t):
    """The same where hardly anything is walked through: rounds of joins and chains decide nearly all rows."""
    rows = t.events.select(
        "event_type", "event_id", F.nullif(F.col("user_id"), F.lit(0)).cast("string").alias("user"),
        F.get_json_object("props", "$.k").alias("k"),
    )
    return dedup.dedup_either(rows, ["event_type"], "user", "k", ["event_id"], walk=16)


@query(
    "first_of_first",
    f"""
    SELECT l_orderkey, coalesce(first(nullif(l_returnflag, 'N') ORDER BY {LINE_SQL})
      FILTER (WHERE l_returnflag <> 'N' AND l_linenumber = m), '') AS first_flag
    FROM (SELECT *, min(l_linenumber) OVER (PARTITION BY l_orderkey) AS m FROM lineitem) GROUP BY l_orderkey
    """,
)
def first_of_first(t):
    """Orders as works, line numbers as authors, return flags as institutions. The first author and their names begin part 0."""
    inst = agg.ordered_list(
        t.lineitem, ["l_orderkey", "l_linenumber"], F.struct(F.nullif("l_returnflag", F.lit("N")).alias("display_name")),
        LINE_ORDER, "institutions",
    ).filter("part = 0")
    works = agg.ordered_list(inst, ["l_orderkey"], F.struct("institutions"), ["l_linenumber", "part"], "authorships")
    return works.filter("part = 0").select("l_orderkey", first_institution("authorships").alias("first_flag"))


@query("rebuild_text", "SELECT doc_id, md5(regexp_replace(text, '^\\s+|\\s+$', '', 'g')) AS digest FROM documents")
def rebuild(t):
    """Texts inverted to word positions, then put together again."""
    # Texts move once, by document; both groupings find their words in place.
    words = t.documents.select("doc_id", "text").repartition("doc_id").select("doc_id", F.posexplode(F.split("text", " ")).alias("pos", "word"))
    entries = words.groupBy("doc_id", "word").agg(F.collect_list("pos").alias("positions"))
    index = entries.groupBy("doc_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "positions"))).alias("index"))
    return spread(materialize(index, "index")).select("doc_id", F.md5(rebuild_text("index")).alias("digest"))


def _trial_lines(t):
    """Order pages as label lines: a file per order day, a block per 50 orders, so files span blocks."""
    orders = spread(t.orders).select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("file"),
        F.floor(F.col("o_orderkey") / 50).alias("block"),
        F.col("o_orderkey").alias("id"),
        F.array(
            F.lit("Summary"),
            F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("EudraCT Number: "), F.col("o_orderkey").cast("string"))),
            F.concat(F.lit("Trial Status: "), "o_orderpriority"),
            F.lit("A. Protocol"),
            F.concat(F.lit("A.1 Member State: "), F.col("o_custkey").cast("string")),
            F.when(F.col("o_orderstatus") == "O", F.lit("continued text")),
            F.lit("Sponsor 2"),
            F.concat(F.lit("B.1.1 Name: "), "o_orderstatus"),
            F.lit("Note: free text"),
            F.lit("D.IMP: 3"),
            F.concat(F.lit("D.2.1 Trade name: "), "o_orderpriority"),
            F.concat(F.lit("D.2.1 Trade name: "), "o_orderstatus"),
        ).alias("lines"),
    )
    rows = orders.select("file", "block", "id", F.posexplode("lines").alias("pos", "line")).filter("line is not null")
    return rows.select("file", "block", (F.col("id") * 100 + F.col("pos")).alias("seq"), "line")


@query(
    "lines_to_records",
    """
    WITH o AS (
      SELECT *, strftime(o_orderdate, '%Y-%m-%d') AS file,
        coalesce(sum(CASE WHEN o_orderstatus <> 'P' THEN 1 ELSE 0 END) OVER
          (PARTITION BY strftime(o_orderdate, '%Y-%m-%d') ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS record,
        lag(o_orderstatus) OVER (PARTITION BY strftime(o_orderdate, '%Y-%m-%d') ORDER BY o_orderkey) AS before_status
      FROM orders),
    r AS (
      SELECT *,
        row_number() OVER (PARTITION BY file, record ORDER BY o_orderkey DESC) AS back,
        bool_or(o_orderstatus <> 'P') OVER (PARTITION BY file, record) AS numbered
      FROM o)
    SELECT file, CAST(record AS BIGINT) AS record, f.label, CAST(0 AS BIGINT) AS part, f.value
    FROM r, LATERAL (
      SELECT 'EudraCT Number' AS label, CAST(o_orderkey AS VARCHAR) AS value
      UNION ALL SELECT 'Trial Status', o_orderpriority || ' A. Protocol'
      UNION ALL SELECT 'A.1 Member State', o_custkey || CASE WHEN o_orderstatus = 'O' THEN ' continued text' ELSE '' END
      UNION ALL SELECT 'Sponsor 2 - B.1.1 Name', o_orderstatus || ' Note: free text'
      UNION ALL SELECT 'IMP 3 - D.IMP', '3'
      UNION ALL SELECT 'IMP 3 - D.2.1 Trade name', o_orderstatus) f
    WHERE back = 1 AND numbered
    """,
)
def lines_to_records(t):
    return lines_to_fields(_trial_lines(t))


@query("lines_to_records_blocks", REGISTRY["lines_to_records"].sql)
def lines_to_records_blocks(t):
    """The same with every file taken for a large one: state is carried from block to block."""
    return lines_to_fields(_trial_lines(t), line_limit=0)
