"""Re-runs, changed files and streams."""

import os

from conftest import rows
from pyspark.sql import functions as F

from refloom.operators.dedup import dedup_first
from refloom.session import scratch_path
from refloom.streaming import incremental as inc


def test_stream_equals_batch(spark, tmp_path):
    schema = "id long, v string"
    source, target, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    arrived = [[(1, "a"), (2, "b"), (1, "c")], [(2, "x"), (3, "d")], [(3, "y"), (1, "z")]]
    for batch in arrived:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(source)
        inc.stream_once(spark, source, spark.createDataFrame([], schema).schema, ["id"], ["v"], target, state)
    inc.stream_once(spark, source, spark.createDataFrame([], schema).schema, ["id"], ["v"], target, state)
    whole = dedup_first(spark.createDataFrame([r for b in arrived for r in b], schema), ["id"], ["v"])
    assert rows(spark.read.parquet(target), "id", "v") == rows(whole)


def test_stream_reads_only_what_arrived(spark, tmp_path):
    schema = spark.createDataFrame([], "id long, v string, extra string").schema
    source, target, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    seen = []
    for k in range(3):
        rows_in = [(i % 400, f"{k}-{i}", None) for i in range(k * 100, k * 100 + 300)] + [(None, f"{k}", "x")]
        spark.createDataFrame(rows_in, schema).repartition(2).write.mode("append").parquet(source)
        progress = inc.stream_once(spark, source, schema, ["id"], [F.col("v")], target, state)
        seen += [(p["numInputRows"], [s["description"].split("[")[0] for s in p["sources"]]) for p in progress if p["numInputRows"]]
    # Every run reads its 301 rows and nothing else; the target is no source.
    assert [n for n, _ in seen] == [301, 301, 301] and all(len(s) == 1 for _, s in seen)
    got = {r.id: (r.v, r.extra, r.batch) for r in spark.read.parquet(target).collect()}
    assert len(got) == 401 and got[None] == ("0", "x", 0) and got[350][0] == "1-350" and got[250][0] == "0-250"
    # Rows of one run compete in the order given; later runs do not.
    assert got[5][0] == "0-5"


def test_work_states_from_new_rows(spark, tmp_path):
    source, target, state = str(tmp_path / "log"), str(tmp_path / "states"), str(tmp_path / "state")
    schema = spark.createDataFrame([], "id string, at long, status string, error string").schema
    log = [
        [("a", 1, "pending", None), ("b", 1, "pending", None), ("a", 2, "claimed", None), ("c", 1, "pending", None), ("d", 1, "pending", None)],
        [("a", 3, "failed", "e1"), ("b", 2, "claimed", None), ("a", 4, "claimed", None), ("a", 5, "completed", None), ("d", 2, "failed", "e2")],
        [("b", 3, "failed", "e3"), ("d", 3, "failed", "e4")],
    ]
    for k, arrived in enumerate(log):
        spark.createDataFrame(arrived, schema).coalesce(1).write.mode("append").parquet(source)
        progress = inc.stream_states(spark, source, schema, "id", "status", ["at"], target, state, note="error")
        assert sum(p["numInputRows"] for p in progress) == len(arrived)
        whole = spark.createDataFrame([r for part in log[: k + 1] for r in part], schema)
        states = inc.read_states(spark, target, "id")
        assert rows(states, "id", "state", "retries", "n_entries") == rows(inc.latest_state(whole, "id", "status", ["at"]))
    assert rows(states, "id", "claims", "error") == [("a", 2, None), ("b", 1, "e3"), ("c", 0, None), ("d", 0, "e4")]
    assert rows(inc.claim(states, 2, "id", ["retries"], most=2), "id", "status") == [("b", "claimed"), ("c", "claimed")]
    inc.compact_states(spark, target, "id", str(tmp_path / "compact"))
    assert rows(inc.read_states(spark, str(tmp_path / "compact"), "id")) == rows(states)


def test_changed_files(spark, tmp_path):
    for name in ("a.txt", "b.txt", "c.txt"):
        (tmp_path / name).write_text("x")
    files = inc.list_files(spark, str(tmp_path))
    loads = files.selectExpr("file_key", "last_modified", "'completed' as status")
    first = scratch_path(spark, "manifest")
    loads.filter("file_key not like '%c.txt'").write.parquet(first)
    os.utime(tmp_path / "b.txt", (1, 1))
    changed = inc.changed_files(inc.list_files(spark, str(tmp_path)), spark.read.parquet(first))
    assert [r.file_key[-5:] for r in changed.orderBy("file_key").collect()] == ["b.txt", "c.txt"]
    manifest = inc.update_manifest(spark.read.parquet(first), changed.selectExpr("file_key", "last_modified", "'failed' as status"))
    assert [(r.file_key[-5:], r.status) for r in manifest.orderBy("file_key").collect()] == [("a.txt", "completed"), ("b.txt", "failed"), ("c.txt", "failed")]


def test_reloaded_file_replaces_its_rows(spark):
    base = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "file_key string, v int")
    again = spark.createDataFrame([("a", 9)], "file_key string, v int")
    assert rows(inc.replace_files(base, again)) == [("a", 9), ("b", 3)]


def test_states(spark):
    log = spark.createDataFrame([("x", 1, "pending"), ("x", 2, "failed"), ("x", 3, "failed"), ("y", 1, "completed")], "id string, at int, status string")
    states = inc.latest_state(log, "id", "status", ["at"])
    assert rows(states) == [("x", "failed", 2, 3), ("y", "completed", 0, 1)]
    assert rows(inc.retry_queue(states, 3), "id") == [("x",)] and inc.retry_queue(states, 2).count() == 0
