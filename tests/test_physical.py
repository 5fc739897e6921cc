"""Plans: no cross joins, no row-at-a-time Python, pushed filters, pruned columns, early limits."""

import os
import subprocess
import sys

import pytest
from conftest import SF_DIR
from pyspark.sql import functions as F

import __spark_entry__ as entry
from refloom.operators.dedup import dedup_first
from refloom.operators.joins import enrich_codes
from refloom.operators.order import limit_per_partition
from refloom.session import Tables, shared_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


SAMPLE = (
    "group_concat_master", "nested_master", "cogroup_unify", "resolve_reference", "search_joined", "pending_anti", "leaf_flag",
    "lines_to_records", "flat_works", "star_split", "explode_outer_flatten", "dossier", "case_bundle", "similarity_threshold",
    "suffix_duplicates", "drug_product_master", "biologics", "label_concepts",
)


@pytest.mark.parametrize("name", SAMPLE)
def test_no_slow_operators(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for bad in ("CartesianProduct", "BatchEvalPython", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_dedup_keeps_one_row_per_key_and_task_before_the_shuffle(spark):
    text = plan(dedup_first(Tables(spark, SF_DIR).lineitem, ["l_returnflag"], ["l_orderkey", "l_partkey"]))
    assert "WindowGroupLimit" in text and text.index("Final") < text.index("Partial")
    text = plan(limit_per_partition(Tables(spark, SF_DIR).orders, "o_orderstatus", 30, 3, ["o_orderkey"]))
    assert "WindowGroupLimit" in text


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(entry.queries()["filter_year"](spark, SF_DIR))
    assert "PushedFilters: [IsNotNull" in text and "o_totalprice" not in text.split("ReadSchema")[1]
    text = plan(entry.queries()["status_counts"](spark, SF_DIR))
    assert "ReadSchema: struct<o_orderstatus:string>" in text


def test_code_map_join_is_left_to_run_time(spark):
    t = Tables(spark, SF_DIR)
    codes = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("d"))
    assert "strategy=broadcast" not in enrich_codes(t.customer, codes, ["c_nationkey"], "d")._jdf.queryExecution().logical().toString()


def test_executors_get_the_package(tmp_path):
    """Page jobs, archives and either-key deduplication from another folder, without PYTHONPATH."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = f"""
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from refloom.session import get_session
spark = get_session("other", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": {str(tmp_path / "shared")!r}}})
print("ROWS", [entry.queries()[n](spark, {SF_DIR!r}).count() for n in ("page_links", "zip_members", "dedup_either")])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
    assert not any(os.listdir(tmp_path / "shared" / "refloom"))  # what the queries wrote is removed at the end


def test_shared_folder_is_the_one_the_session_names(spark):
    folder = shared_dir(spark)
    assert folder and shared_dir(spark) == folder
    assert spark.sparkContext.getCheckpointDir()
