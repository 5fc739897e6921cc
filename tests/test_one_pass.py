"""Steps that large tables pass once: the parse of XML, the shuffle of child rows, the words of a text."""

from __future__ import annotations

from pyspark.sql import functions as F

from refloom.operators import aggregate as agg
from refloom.operators import pages
from refloom.plans import classes, descriptors, trials
from refloom.sources.documents import xml_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_on_a_record_do_not_repeat_its_parse(spark):
    texts = ["<DescriptorRecord><DescriptorUI>D1</DescriptorUI><DescriptorName><String>n</String></DescriptorName></DescriptorRecord>", "<DescriptorRecord/>", None]
    raw = xml_rows(spark.createDataFrame([(x,) for x in texts], "x string"), "x", descriptors.DESCRIPTOR)
    got = descriptors.descriptors(raw).select("descriptor_ui", "name", "synonyms")
    assert plan(got).count("from_xml(") == 1
    assert [tuple(r) for r in got.collect()] == [("D1", "n", "")]


def test_children_move_once(spark):
    parents = spark.createDataFrame([(1,), (2,), (None,), (1,)], "k long")
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "c"), (None, 1, "n"), (3, 1, "x"), (1, 1, "c")], "k long, o int, v string")
    children = [agg.Child("a", rows, F.concat("v", F.lit("!")), ["o"]), agg.Child("b", rows, F.when(F.col("o") > 1, F.col("v")), ["o"])]
    got = agg.nested_master(parents, ["k"], children)
    assert sorted(((r.k, r.part, r.a, r.b) for r in got.collect()), key=str) == sorted(
        [(1, 0, ["c!", "c!", "b!"], ["b"])] * 2 + [(2, 0, [], []), (None, 0, ["n!"], [])], key=str
    )
    # The lists are not moved once more to be joined; only rows without a key, which are few, are joined apart.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = plan(got).splitlines()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    at = lines[next(i for i, x in enumerate(lines) if x.strip().endswith("Union")) + 1].index(":")
    first = [x for x in lines if x[at : at + 1] == ":"]
    assert any("collect_list(" in x for x in first) and sum("Exchange hashpartitioning(" in x for x in first) == 2


def test_labels_of_trial_pages_are_made_once(spark):
    label = trials.plain_label(F.col("x"))
    names = ["Contact Person (Scientific Query)", "Public Contact Person", "ExclusionCriteria", "Health Condition / x", "Intervention / Comparator Agent", "Plain Text", None]
    got = spark.createDataFrame([(x,) for x in names], "x string").select(label.alias("n"))
    # A function that makes the name once has its three replacements once.
    assert got._jdf.queryExecution().analyzed().toString().count("[^a-zA-Z0-9_") == 1
    assert [r.n for r in got.collect()] == [
        "details_of_contact_person_scientific_query", "details_of_contact_person_public_query", "exclusion_criteria",
        "health_condition_problems_studied", "intervention_comparator_agent", "plain_text", None,
    ]


def test_chapters_parse_their_pages_once(spark, monkeypatch):
    parsed = []
    real = pages.elements
    monkeypatch.setattr(pages, "elements", lambda *a, **k: parsed.append(a) or real(*a, **k))
    html = '<h1>One (A00-B99)</h1><dl class="Rubric-note"><dt>x</dt><h1><dd>a<dd>b</dl>'
    got = classes.chapters(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string")).collect()
    # A heading inside a list is not what is around its items.
    assert len(parsed) == 1 and [(r.title, r.code_range, r.notes) for r in got] == [("One (A00-B99)", "A00-B99", "a;b")]
