"""Incremental operators over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from refloom.catalog import query
from refloom.session import scratch_path
from refloom.streaming import incremental as inc


@query("stream_dedup", "SELECT DISTINCT user_id, event_type FROM events")
def stream_dedup(t):
    """Files of events as a stream: two runs over one checkpoint, each (user, type) once."""
    source, target, state = (scratch_path(t.spark, n) for n in ("arrived", "kept", "state"))
    rows = t.events.select("user_id", "event_type")
    early = F.col("event_type").isin("click", "view")
    for arrived in (rows.filter(early), rows):
        arrived.write.mode("append").parquet(source)
        inc.stream_once(t.spark, source, rows.schema, ["user_id", "event_type"], ["user_id"], target, state)
    return t.spark.read.parquet(target).select("user_id", "event_type")


@query(
    "latest_state",
    """
    SELECT user_id, first(event_type ORDER BY event_id DESC) AS state,
      count(*) FILTER (WHERE event_type = 'error') AS retries, count(*) AS n_entries FROM events GROUP BY user_id
    """,
)
def latest_state(t):
    return inc.latest_state(t.events, "user_id", "event_type", ["event_id"], failed="error")


@query(
    "work_states",
    """
    SELECT user_id, first(event_type ORDER BY event_id DESC) AS state, count(*) FILTER (WHERE event_type = 'error') AS retries,
      count(*) FILTER (WHERE event_type = 'click') AS claims, count(*) AS n_entries, max(event_id) AS last_id FROM events GROUP BY user_id
    """,
)
def work_states(t):
    """Events as a status log that arrives in two parts: states after the second run, which reads new rows only."""
    source, target, state = (scratch_path(t.spark, n) for n in ("log", "states", "state"))
    log = t.events.select("user_id", "event_type", "event_id")
    for early in (True, False):
        log.filter((F.col("event_id") % 3 == 0) == F.lit(early)).write.mode("append").parquet(source)
        inc.stream_states(t.spark, source, log.schema, "user_id", "event_type", ["event_id"], target, state, failed="error", claimed="click")
    states = inc.read_states(t.spark, target, "user_id")
    return states.select("user_id", "state", "retries", "claims", "n_entries", F.col("last.event_id").alias("last_id"))


@query(
    "retry_queue",
    """
    SELECT user_id, CASE state WHEN 'purchase' THEN 'completed' ELSE state END AS state, retries FROM (
      SELECT user_id, first(event_type ORDER BY event_id DESC) AS state, count(*) FILTER (WHERE event_type = 'error') AS retries
      FROM events GROUP BY user_id)
    WHERE state <> 'purchase' AND retries < 12
    """,
)
def retry_queue(t):
    kind = F.when(F.col("event_type") == "purchase", "completed").otherwise(F.col("event_type"))
    states = inc.latest_state(t.events.withColumn("event_type", kind), "user_id", "event_type", ["event_id"], failed="error")
    return inc.retry_queue(states, 12).select("user_id", "state", "retries")


@query(
    "partition_progress",
    """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS "partition", count(*) AS n_wanted, count(l) AS n_done, count(*) = count(l) AS complete
    FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey AS l FROM lineitem) ON o_orderkey = l GROUP BY 1
    """,
)
def partition_progress(t):
    done = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return inc.partition_progress(t.orders, done, "o_orderkey", F.year("o_orderdate"))


@query(
    "partition_harvest",
    "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1997",
)
def partition_harvest(t):
    """Written by year, then read back for some years: only their folders are read."""
    path = scratch_path(t.spark, "years")
    inc.write_partitions(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), path, F.year("o_orderdate"), "year")
    return t.spark.read.parquet(path).filter("year between 1996 and 1997").select("o_orderkey", "o_custkey")


@query(
    "changed_files",
    """
    SELECT s_name AS file_key, s_suppkey AS last_modified FROM supplier
    WHERE s_nationkey < 5 OR s_nationkey BETWEEN 10 AND 12 OR s_nationkey > 20
    """,
)
def changed_files(t):
    """Suppliers as files: some not known, some with another stamp, some that failed last time."""
    files = t.supplier.select(F.col("s_name").alias("file_key"), F.col("s_suppkey").alias("last_modified"))
    nation = F.col("s_nationkey")
    manifest = t.supplier.filter(nation >= 5).select(
        F.col("s_name").alias("file_key"),
        F.when(nation.between(10, 12), F.col("s_suppkey") + 1).otherwise(F.col("s_suppkey")).alias("last_modified"),
        F.when(nation > 20, "failed").otherwise("completed").alias("status"),
    )
    return inc.changed_files(files, manifest)


@query(
    "replace_files",
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS file_key, 'old' AS run FROM orders
    WHERE strftime(o_orderdate, '%Y-%m') NOT IN (SELECT strftime(o_orderdate, '%Y-%m') FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'P')
    UNION ALL SELECT o_orderkey, strftime(o_orderdate, '%Y-%m'), 'new' FROM orders WHERE year(o_orderdate) = 1997 AND o_orderstatus = 'P'
    """,
)
def replace_files(t):
    """Months as files: those of one year come again with fewer rows."""
    rows = t.orders.select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM").alias("file_key"), "o_orderstatus")
    again = rows.filter("file_key like '1997-%' and o_orderstatus = 'P'").withColumn("run", F.lit("new"))
    return inc.replace_files(rows.withColumn("run", F.lit("old")), again).drop("o_orderstatus")


@query(
    "update_manifest",
    """
    SELECT user_id AS file_key, max(event_id) AS last_modified, first(event_type ORDER BY event_id DESC) AS status FROM events GROUP BY user_id
    """,
)
def update_manifest(t):
    log = t.events.select(F.col("user_id").alias("file_key"), F.col("event_id").alias("last_modified"), F.col("event_type").alias("status"))
    half = F.col("last_modified") < log.agg(F.avg("last_modified")).head()[0]
    return inc.update_manifest(log.filter(half), log.filter(~half))
