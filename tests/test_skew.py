"""Numbering, slicing and scans give the same result for ordinary and oversized keys."""

import json
import random

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from refloom.operators import aggregate as agg
from refloom.operators import joins
from refloom.operators.order import limit_per_partition, page, page_slices
from refloom.operators.scans import scan
from refloom.operators.skew import number_ranges, number_rows, split_groups


def skewed(spark, n=3000):
    """A third of all rows under one key, a NULL key, and small keys."""
    rnd = random.Random(7)
    data = [(i, "hot" if i % 3 == 0 else (None if i % 11 == 0 else f"k{i % 50}"), rnd.randint(0, 400)) for i in range(n)]
    return spark.createDataFrame(data, "id int, k string, v int").repartition(7)


def test_number_ranges_equals_window(spark):
    df = skewed(spark)
    want = df.withColumn("rn", F.row_number().over(Window.partitionBy("k").orderBy("v", "id")).cast("long"))
    assert rows(number_ranges(df, ["v", "id"], ["k"])) == rows(want)
    assert rows(number_rows(df, ["k"], ["v", "id"], limit=100)) == rows(want)
    assert rows(number_rows(df, ["k"], ["v", "id"])) == rows(want)


def test_split_groups_slices(spark):
    got = split_groups(skewed(spark), ["k"], ["v", "id"], limit=100)
    sizes = got.groupBy("k", "part").count().collect()
    assert max(r["count"] for r in sizes) <= 100
    assert got.count() == 3000
    hot = sorted((r.part, r["count"]) for r in sizes if r.k == "hot")
    assert hot == [(i, 100) for i in range(10)]


def test_ordered_text_parts_follow_each_other(spark):
    df = skewed(spark)
    parts = agg.ordered_text(df, ["k"], F.col("id").cast("string"), ",", ["v", "id"], limit=64)
    whole = agg.ordered_text(df, ["k"], F.col("id").cast("string"), ",", ["v", "id"])
    joined = {}
    for r in sorted(parts.collect(), key=lambda r: (r.k or "", r.part)):
        joined.setdefault(r.k, []).append(r.text)
    assert {k: ",".join(v) for k, v in joined.items()} == {r.k: r.text for r in whole.collect()}


def test_master_with_oversized_child_keeps_all(spark):
    df = skewed(spark)
    parents = spark.createDataFrame([("hot", 1), ("k1", 2), ("none", 3)], "k string, p int")
    kids = [agg.Child("ids", df, F.struct("id"), ["id"]), agg.Child("vs", df, F.struct("v"), ["v", "id"])]
    got = agg.nested_master(parents, ["k"], kids, limit=300).collect()
    assert sum(len(r["ids"]) for r in got if r.k == "hot") == 1000
    assert sum(len(r["vs"]) for r in got if r.k == "hot") == 1000
    assert [len(r["ids"]) for r in got if r.k == "none"] == [0]


def test_pages_and_limits(spark):
    df = skewed(spark)
    order = sorted((tuple(r) for r in df.select("v", "id").collect()))
    got = {r.id: r.page for r in page_slices(df, 100, ["v", "id"]).collect()}
    assert got == {i: n // 100 + 1 for n, (_, i) in enumerate(order)}
    assert [r.id for r in page(df, 3, 50, ["v", "id"]).orderBy("v", "id").collect()] == [i for _, i in order[100:150]]
    few = limit_per_partition(df, "k", 100, 10, ["v", "id"])
    many = limit_per_partition(df, "k", 20_000, 10, ["v", "id"], limit=100)
    assert few.filter("k = 'hot'").count() == 10
    assert many.filter("k = 'hot'").count() == 1000


def test_scan_in_blocks_equals_one_window(spark):
    rnd = random.Random(3)
    data = [(f"f{i % 2}", i // 40, i, rnd.choice([None, None, "a", "b", ""]), rnd.random() < 0.2) for i in range(1000)]
    df = spark.createDataFrame(data, "file string, block long, seq long, mark string, flag boolean").repartition(5)
    values = dict(sums={"n": F.col("flag").cast("long")}, lasts={"m": F.col("mark")}, before={"p": F.col("mark")})
    one = scan(df, ["file"], "block", ["seq"], blocks=False, **values)
    two = scan(df, ["file"], "block", ["seq"], blocks=True, **values)
    assert rows(one) == rows(two)


def test_parts_follow_one_rule(spark):
    """A key's parts depend on its own rows only, not on other keys or the length of values."""
    small = [("a", i, "x" * 90) for i in range(50)]
    alone = spark.createDataFrame(small, "k string, i int, t string")
    beside = spark.createDataFrame(small + [("b", i, "y") for i in range(500)], "k string, i int, t string")
    got = [rows(agg.ordered_text(df, ["k"], F.col("t"), "", ["i"], limit=20).filter("k = 'a'")) for df in (alone, beside)]
    assert got[0] == got[1] and sorted(r[1] for r in got[0]) == [0, 1, 2]
    assert rows(agg.ordered_text(beside, ["k"], F.col("t"), "", ["i"]).filter("k = 'a'")) == [("a", 0, "x" * 4500)]


def test_pages_over_ties_are_disjoint(spark, monkeypatch):
    import refloom.operators.order as order

    df = spark.createDataFrame([(i, i % 3) for i in range(1000)], "id int, v int").repartition(7)
    monkeypatch.setattr(order, "GROUP_LIMIT", 300)
    shown = [r.id for n in range(1, 11) for r in order.page(df, n, 100, ["v"]).collect()]
    assert sorted(shown) == list(range(1000))
    numbered = {r.id: r.page for r in order.page_slices(df, 100, ["v"]).collect()}
    assert all(numbered[i] == n // 100 + 1 for n, i in enumerate(shown))
    monkeypatch.setattr(order, "WINDOW_LIMIT", 5)
    ways = [rows(order.limit_per_partition(df.withColumn("p", F.lit(1)), "p", 50, 1, ["v"], limit=n)) for n in (10, 100_000)]
    monkeypatch.setattr(order, "WINDOW_LIMIT", 1000)
    assert ways[0] == ways[1] == rows(order.limit_per_partition(df.withColumn("p", F.lit(1)), "p", 50, 1, ["v"]))


# Every consumer of parts, over the limit: the content of all parts together is that of the whole.


def test_consumers_of_parts_keep_everything(spark, monkeypatch):
    from refloom.plans import classes, medicines, trials

    for f in (agg.ordered_text, agg.ordered_list, agg.text_master, agg.nested_master, agg.union_lists):
        monkeypatch.setattr(f, "__defaults__", tuple(7 if d == agg.GROUP_LIMIT else d for d in f.__defaults__))
    names = "".join(f"<li>n{i:02d}</li>" for i in range(30))
    html = f"<span id='loinc-id'>1-8</span><section id='related-names'><ul>{names}</ul></section>"
    page = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    parts = sorted((r.part, r.related_names, r.loinc_num) for r in classes.observations(page).collect())
    assert "; ".join(p[1] for p in parts).split("; ") == [f"n{i:02d}" for i in range(30)] and {p[2] for p in parts} == {"1-8"}
    sites = "".join(f"<tr><td>S{i}</td><td>c</td></tr>" for i in range(30))
    html = (
        "<table border='1'><tr><td>CTRI Number</td><td>CTRI/2021/05/033 [Registered on: 03/05/2021] Trial Registered Prospectively</td></tr><tr><td>Phase</td><td>3</td></tr><tr><td>Sites of Study</td><td><table>"
        f"<tr><td>No of Sites = 30</td></tr><tr><th>Name of Site</th><th>City</th></tr>{sites}</table></td></tr></table>"
    )
    page = spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")
    got = sorted(trials.flat_pages(page).collect(), key=lambda r: r.part)
    found = [x["name_of_site"] for r in got for x in json.loads(r.sites_of_study)]
    assert found == [f"S{i}" for i in range(30)] and [r.ctri_id for r in got] == ["CTRI/2021/05/033"] + [""] * (len(got) - 1)
    base = spark.createDataFrame(
        [("m", "7", f"d{i:02d}", f"N{i:02d}", json.dumps([{"nct_id": f"T{i}", "brief_title": f"B{i}"}])) for i in range(30)],
        "medicine_name string, ema_product_number string, document_url string, nct_numbers string, clinical_trials_json string",
    )
    missing = [c for c in [*medicines.DOSSIER_MASTER_COLUMNS, *medicines.DOSSIER_TEXT_COLUMNS, "document_type"] if c not in base.columns]
    base = base.select("*", *[F.lit("x").alias(c) for c in missing])
    got = medicines.dossier(base).collect()
    assert sorted(r.nct_id for r in got if r.nct_id) == sorted(f"T{i}" for i in range(30))
    numbers = {r.part: r.nct_numbers for r in got}
    assert ",".join(numbers[p] for p in sorted(numbers)).split(",") == [f"N{i:02d}" for i in range(30)]


def test_counts_come_with_the_lists(spark):
    """Counts of all rows, also of those without a value, with and without keys in parts; lists in the order of the file."""
    parent = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    one = spark.createDataFrame([("a", 3, "x"), ("a", 1, "z"), ("a", 2, None), ("b", 1, None)], "k string, at int, v string")
    two = spark.createDataFrame([("a", i, f"t{9 - i}") for i in range(6)], "k string, at int, v string")
    children = [("one", one, F.col("v")), ("two", two, F.col("v"))]
    whole = joins.cogroup_details(parent, ["k"], children, ",", order=["at"])
    assert rows(whole) == [("a", 0, "z,x", "t9,t8,t7,t6,t5,t4", 3, 6), ("b", 0, "", "", 1, 0), ("c", 0, "", "", 0, 0)]
    parts = joins.cogroup_details(parent, ["k"], children, ",", limit=4, order=["at"])
    want = [("a", 0, "z,x", "t9,t8,t7,t6", 3, 6), ("a", 1, "", "t5,t4", 3, 6), ("b", 0, "", "", 1, 0), ("c", 0, "", "", 0, 0)]
    assert rows(parts.select(whole.columns)) == want
