"""Trees in pieces, page directories and mergeable statistics."""

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from refloom.operators.aggregate import add_partitions, build_tree, dataset_stats, merge_stats, tree_lines, write_tree
from refloom.operators.order import page, read_page, write_pages


@pytest.fixture
def levels(spark):
    ddl = "code string, parent_code string, name string"
    top = spark.createDataFrame([("A", "", "a"), ("B", "", 'b "q"'), ("C", None, None)], ddl)
    middle = spark.createDataFrame([("A1", "A", "x"), ("A2", "A", "y"), ("B1", "B", "z"), ("X1", "X", "orphan")], ddl)
    leaves = spark.createDataFrame([(f"A1-{k:03d}", "A1", f"leaf {k}") for k in range(50)] + [("X1-1", "X1", "ä"), ("Q", "none", "q")], ddl)
    return [top, middle, leaves]


def test_tree_in_pieces_is_the_tree(spark, levels, tmp_path):
    want = {r.code: r.node for r in build_tree(levels).collect()}
    got = {}
    for r in tree_lines(levels).orderBy("root", "pos").collect():
        got[r.root] = got.get(r.root, "") + r.text
    assert got == want and {json.loads(x)["code"] for x in got.values()} == {"A", "B", "C", "X1", "Q"}
    write_tree(tree_lines(levels), str(tmp_path / "t"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part-*"))).replace("\n", "")
    assert text == "".join(want[k] for k in sorted(want))


def test_pages_of_a_directory(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "id % 7 as k", "'x' as _c").repartition(5)
    write_pages(df, str(tmp_path / "p"), [F.col("k").desc(), "id"])
    for number, size in ((1, 10), (3, 300), (10, 100), (11, 100), (4, 333)):
        found = read_page(spark, str(tmp_path / "p"), number, size)
        assert [tuple(r) for r in found.collect()] == [tuple(r) for r in page(df, number, size, [F.col("k").desc(), "id"]).collect()]
    found = read_page(spark, str(tmp_path / "p"), 2, 10)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "rangepartitioning(k" not in plan
    assert len(set(found.inputFiles())) >= 1 and found.select(F.input_file_name().alias("f")).distinct().count() == 1


def test_statistics_merge(spark, tmp_path):
    path = str(tmp_path / "s")
    df = spark.range(60_000).selectExpr("id % 3 as part", "id % 20011 as user", "id as n", "if(id % 5 = 0, null, id) as some")
    for k in range(3):
        stats = add_partitions(df.filter(F.col("part") == k), path, "part", ["user", "some"], ["n"])
    # A partition that comes again replaces its row.
    stats = add_partitions(df.filter("part = 1"), path, "part", ["user", "some"], ["n"])
    assert stats.count() == 3 and [r.n_rows for r in stats.collect()] == [20_000] * 3
    got, exact = merge_stats(stats).head(), dataset_stats(df, (), ["user", "some"], ["n"]).head()
    assert (got.n_rows, got.sum_n) == (exact.n_rows, exact.sum_n)
    assert abs(got.n_user / exact.n_user - 1) < 0.03 and abs(got.n_some / exact.n_some - 1) < 0.03
    assert rows(merge_stats(stats, ["part"]), "part", "n_rows") == [(0, 20_000), (1, 20_000), (2, 20_000)]
