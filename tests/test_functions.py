"""Column functions on edge values."""

import random
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from refloom.functions import arrays, codes, text, urls


def one(spark, expr):
    return spark.range(1).select(expr.alias("x")).head()[0]


@pytest.mark.parametrize("raw, want", [
    ("September 2019", "2019-09"), ("July 2024 (Conditional and Time-limited)", "2024-07"), ("Sep. 2020", "2020-09"),
    ("2021", "2021-00"), ("May", "unknown"), ("", "unknown"), (None, "unknown"), ("approved 12 2018-05 Mar 2017", "2017-03"),
    ("Dec 2015 after January", "2015-01"), ("(2016) June", "2016-06"), ("20190 March", "unknown"),
])
def test_month_year(spark, raw, want):
    assert one(spark, codes.month_year(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize("raw, want", [("20200131", "2020-01-31"), ("202001", "202001"), ("", ""), (None, None)])
def test_iso_date(spark, raw, want):
    assert one(spark, codes.iso_date(F.lit(raw).cast("string"))) == want


def test_text(spark):
    lit = F.lit
    assert one(spark, text.clean_text(lit(" a  b\r\n  c\t"))) == "a b c"
    assert one(spark, text.strip_space(lit(" \n a b 　"))) == "a b"
    assert one(spark, text.slugify(lit(' a<b>:  c?/"x" '))) == "ab_cx"
    assert one(spark, text.slugify(lit(""))) == "unnamed"
    assert one(spark, text.strip_zeros(lit(" 00120"))) == "120"
    assert text.clean_name(" Name of (Thing)/No. ") == "name_of_thing_no"
    assert one(spark, text.reply_json(lit("<think>{a}</think> x {\"a\": {\"b\": 1}} y"))) == '{"a": {"b": 1}}'
    assert one(spark, text.reply_status(lit("no braces"))) == "failed"
    assert one(spark, text.link_target(lit('=hyperlink("https://a.b/c","d")'))) == "https://a.b/c"
    assert one(spark, text.strip_title(lit("- - - Cholera - all"))) == "Cholera - all"


@pytest.mark.parametrize("code, level, parent", [
    ("A", 1, ""), ("A01", 2, "A"), ("A01B", 3, "A01"), ("A01BC", 4, "A01B"), ("A01BC02", 5, "A01BC"), ("A1", None, None), ("a", None, None),
])
def test_class_codes(spark, code, level, parent):
    assert one(spark, codes.code_level(F.lit(code))) == level
    assert one(spark, codes.class_parent(F.lit(code))) == parent


@pytest.mark.parametrize("code, parent", [("A00", None), ("A00.0", "A00"), ("A00.01", "A00.0"), ("A00.", None)])
def test_dotted_parent(spark, code, parent):
    assert one(spark, codes.dotted_parent(F.lit(code))) == parent


@pytest.mark.parametrize("index, want", [
    ({"the": [0, 2], "cat": [1], "mat": [5]}, "the cat the   mat"), ({}, ""), ({"a": []}, ""), ({"b": [3]}, "b"),
    ({"x": [0], "y": [0, 1]}, "y y"), ({"n": [-1, 0]}, "n"),
])
def test_rebuild_text(spark, index, want):
    df = spark.createDataFrame([(index,)], "m map<string,array<int>>")
    assert df.select(arrays.rebuild_text("m")).head()[0] == want


def test_rebuild_text_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "m map<string,array<int>>")
    assert df.select(arrays.rebuild_text("m")).head()[0] == ""


def test_text_list(spark):
    df = spark.createDataFrame([('["a"," ","b "]',), ("plain",), ("[odd",), (None,)], "x string")
    got = [r[0] for r in df.select(F.coalesce(arrays.text_list("x"), F.array())).collect()]
    assert got == [["a", "b"], ["plain"], ["[odd"], []]


def test_lookup_last_of_first_list(spark):
    ddl = "c array<struct<kind:string,value:string>>, e array<struct<kind:string,value:string>>"
    df = spark.createDataFrame([([("S", "1"), ("S", "2")], [("S", "9")]), (None, [("S", "9")]), ([("T", "x")], None)], ddl)
    got = [r[0] for r in df.select(arrays.lookup([F.col("c"), F.col("e")], "S")).collect()]
    assert got == ["2", "9", ""]


@pytest.mark.parametrize("base, href, want", [
    ("https://h/a/b?x=1#f", "c", "https://h/a/c"), ("https://h", "c", "https://h/c"), ("https://h/a/", "/z", "https://h/z"),
    ("https://h/a/b", "?q", "https://h/a/b?q"), ("https://h/a/b?x#f", "#g", "https://h/a/b?x#g"), ("https://h/a", "mailto:x", "mailto:x"),
    ("http://h/a", "//k/z", "http://k/z"), ("https://h/a", "https://k", "https://k"),
    ("https://h/a/b/c", "../d", "https://h/a/d"), ("https://h/a/b/c", "../../../d?x=../y", "https://h/d?x=../y"), ("https://h/a/b/", "./", "https://h/a/b/"),
    ("https://h/a/b", "..", "https://h/"), ("https://h/a", "/x/./y/../z#..", "https://h/x/z#.."), ("https://h/a/b", "c/..", "https://h/a/"),
])
def test_resolve_url(spark, base, href, want):
    assert want == urljoin(base, href)
    assert one(spark, urls.resolve_url(F.lit(base), F.lit(href))) == want


def test_url_parts(spark):
    url = "https://h/en/documents/overview/x_fr.pdf"
    assert one(spark, urls.url_language(F.lit(url))) == "en"
    assert one(spark, urls.url_language(F.lit("https://h/x_FR.PDF"))) == "fr"
    assert one(spark, urls.url_kind(F.lit(url))) == "overview"
    assert one(spark, urls.url_param(F.lit("https://h/?P3=1+18853&z"), "P3")) == "1 18853"


def test_similar_bands(spark):
    from refloom.operators.similarity import similar

    rnd = random.Random(2)
    vectors = [(i, [rnd.choice([0.01, 0.5, 1.0, 30.0]) * rnd.random() for _ in range(4)]) for i in range(120)] + [(500, [0.0] * 4)]
    df = spark.createDataFrame(vectors, "id int, v array<double>")
    queries = df.filter("id % 10 = 0").selectExpr("id as query_id", "v as query_vec")
    for cutoff in (1.0, 0.9, 0.5, 0.1, 0.0):
        want = set()
        for i, a in vectors:
            for q, b in vectors:
                if q % 10 == 0:
                    d, n = sum(x * y for x, y in zip(a, b)), sum(x * x for x in a) + sum(x * x for x in b)
                    if n - d > 0 and d / (n - d) >= cutoff:
                        want.add((i, q))
        got = {(r.id, r.query_id) for r in similar(df, queries, "v", cutoff - 1e-12 if cutoff == 1 else cutoff, ["id"]).collect()}
        assert got == want, cutoff


def test_similar_rings(spark):
    """Unit vectors around some directions: no single cell, far fewer products than pairs, and the full result."""
    from refloom.operators.similarity import candidates, similar

    rnd = random.Random(7)

    def unit(v):
        n = sum(x * x for x in v) ** 0.5
        return [x / n for x in v]

    centres = [unit([rnd.gauss(0, 1) for _ in range(16)]) for _ in range(12)]
    vectors = [(i, unit([x + rnd.gauss(0, 0.08) for x in centres[i % 12]])) for i in range(360)]
    df = spark.createDataFrame(vectors, "id int, v array<double>")
    queries = df.filter("id % 10 = 0").selectExpr("id as query_id", "v as query_vec")
    for cutoff in (0.8, 0.5, 0.05):
        want = {(i, q) for i, a in vectors for q, b in vectors if q % 10 == 0 and (d := sum(x * y for x, y in zip(a, b))) / (2 - d) >= cutoff}
        assert {(r.id, r.query_id) for r in similar(df, queries, "v", cutoff, ["id"]).collect()} == want
        share = candidates(df, queries, "v", cutoff, ["id"]).count() / (360 * 36)
        assert share <= {0.8: 0.2, 0.5: 0.4, 0.05: 1}[cutoff]
    for pivots in ([], [[1.0] * 16], [[1.0] + [0.0] * 15, [-1.0] + [0.0] * 15]):
        got = {(r.id, r.query_id) for r in similar(df, queries, "v", 0.5, ["id"], pivots=pivots).collect()}
        assert len(got) == len({(i, q) for i, a in vectors for q, b in vectors if q % 10 == 0 and (d := sum(x * y for x, y in zip(a, b))) / (2 - d) >= 0.5})
