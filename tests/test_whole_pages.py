"""Pages that are cut and looked at in one place: plain tags without the tolerant parser, whole tables and lists without a shuffle."""

from __future__ import annotations

from conftest import rows

from refloom.operators import pages
from refloom.plans import approvals, classes, trials


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plain_start_tags_need_no_tolerant_parser(monkeypatch):
    built = []
    real = pages._StartTag
    monkeypatch.setattr(pages, "_StartTag", lambda: built.append(1) or real())
    markup = "<p>see <a HREF='/one.pdf' id=q1 hidden>One &amp; <b>two</b></a> and <a href=\"/no.html\" href=\"x\">no</a>\n<li>a<li>b</li></p>"
    got = []
    for whole in (False, True):
        parser = pages._Elements(frozenset(["a", "p", "li"]), pages.SILENT)
        if whole:
            parser.feed(markup)
            parser.close()
        else:
            parser.read(markup)
        got.append([[*e[:3], "".join(e[3])] for e in parser.found])
    assert got[0] == got[1] and got[0][1] == [0, "a", {"href": "/one.pdf", "id": "q1", "hidden": ""}, "One & two"]
    assert not built
    parser.read("<a href='?a&amp;b'>x</a><a href=x/>")
    assert built and parser.found[-2][2] == {"href": "?a&b"}


TABLES = [
    (1, "<table><tr><td>Title</td></tr><tr><th>A</th><th>B (x)</th><th>A</th></tr><tr><td> 1\n2</td><td rowspan=2>b</td><td>c</td></tr><tr><td>d</td><td>e</td></tr>"
        "<tr><td>cut</td></tr><tr><td>x</td><td>y</td><td>z</td><td>w</td></tr></table><table><tr></tr><tr><td>q</td></tr><tr><td>r</td></tr></table>"),
    (2, "<table><tr><td>A<table><tr><td>in</td></tr><tr><td>v</td></tr></table></td></tr><tr><td>1</td></tr></table>"), (3, None), (4, ""), (None, "<table><tr><td>A</td></tr><tr><td>1</td></tr></table>"),
]


def test_records_of_tables_are_made_where_pages_are_parsed(spark):
    def page_table(data):
        return spark.createDataFrame(data, "page_id long, html string")

    def got(found):
        return rows(found.selectExpr("page_id", "table_no", "row_no", "sort_array(transform(map_entries(fields), x -> concat(x.key, '=', x.value))) as f"))

    once = pages.page_records(page_table(TABLES))
    assert "Exchange" not in plan(once)
    assert got(once) == got(pages.table_records(pages.table_rows(page_table(TABLES)))) and once.count() == 5
    # Pages that share an id, and pages without one, stay what they were.
    twice = page_table(TABLES + TABLES)
    assert got(pages.page_records(twice)) == got(pages.table_records(pages.table_rows(twice)))


APPROVALS = (
    "<table><tr><th>Brand Name</th><th>Non-proprietary Name</th><th>Approved in</th><th>English</th></tr>"
    "<tr><td>A<sup>partial change</sup><sup>2</sup></td><td>g &amp; h</td><td>May 2020</td><td><a href='/1.PDF'>x</a><a href='/2.html'>y</a><a href='b/3.pdf'>z</a></td></tr>"
    "<tr><td>note</td></tr><tr></tr><tr><td>Brand name</td><td>x</td><td>y</td><td>z</td></tr><tr><td>B</td><td>n</td><td>2019</td></tr></table>"
    "<table><tr><td>k</td><td>l</td><td>m</td><td>n</td></tr><tr><td>C</td><td><table><tr><td>brand</td></tr><tr><td>D</td></tr></table></td><td>June 2018</td><td></td></tr></table>"
    "<table><tr></tr><tr><td>brand</td></tr><tr><td>E</td></tr></table>"
)


def test_approvals_are_read_where_pages_are_parsed(spark):
    data = [(1, "https://h.example/l/", APPROVALS), (2, None, APPROVALS), (3, "https://h.example/x", None), (None, "https://h.example/x", APPROVALS)]
    listed = spark.createDataFrame(data, "page_id long, url string, html string")
    found = approvals.approvals(listed)
    assert "Exchange" not in plan(found)
    assert rows(found) == rows(approvals._shaped(approvals._across_pages(listed)))
    assert {r.brand_name for r in found.collect()} >= {"A", "B", "C"}
    first = found.filter("page_id = 1 and brand_name = 'A'").first()
    assert (first.approval_type, first.generic_name, first.approval_date) == ("Partial Change Approval", "g & h", "2020-05")
    assert first.en_urls == ["https://h.example/1.PDF", "https://h.example/l/b/3.pdf"]
    twice = listed.unionByName(listed)
    assert rows(approvals.approvals(twice)) == rows(approvals._shaped(approvals._across_pages(twice)))


CODES = (
    "<h2><span id=loinc-id> 1-2 </span><span id='lcn'>One</span><span id='lcn'>Two</span></h2><section id='term-description'><p itemprop='description'> d </p><p itemprop='description'>e</p></section>"
    "<section id='additional-names'><dl><dt>Fully-Specified Name</dt><dd>a:b​:c</dd><dt>Short Name</dt><dd>s</dd><dt>Short name</dt><dd> t </dd><dt>Display Name</dt></dl></section>"
    "<section id=basic><dl><dt>Class / Type</dt><dd>k</dd><dt>Type</dt><dd>y</dd></dl><dl><dt>Order vs. Obs</dt><dd>Both</dd></dl></section>"
    "<section id='related-names'><ul><li>r</li><li> </li><li>q &lt; p</li><li>r</li></ul></section>"
    "<section id='example-units'><table><tr><td>mg</td><td>x</td></tr><tr><td>g</td></tr><tr><td>mg</td></tr><tr><td></td></tr></table></section>"
)


def test_code_pages_are_known_where_they_are_parsed(spark):
    data = [(1, CODES), (2, "<span>x</span><dl><dt>Class</dt><dd>no</dd></dl>"), (3, None), (4, "<p>no span</p>"), (None, CODES)]
    listed = spark.createDataFrame(data, "page_id long, html string")
    for limit in (100, 2):
        found = classes._observed(listed, limit)
        assert "Exchange" not in plan(found)
        together = classes._observed_together(listed, limit)
        assert rows(found) == rows(together.select(*found.columns))
    first = classes.observations(listed).filter("page_id = 1").first()
    assert (first.loinc_num, first.long_common_name, first.description, first.short_name, first["class"], first.type, first.order_obs) == ("1-2", "One", "d", "t", "k", "y", "Both")
    assert (first.component, first.property, first.related_names, first.example_units) == ("a", "b", "r; q < p; r", "mg; g")
    assert sorted(r.part for r in classes.observations(listed, 2).collect()) == [0, 0, 0, 1]
    twice = listed.unionByName(listed)
    assert rows(classes.observations(twice)) and classes.observations(twice).count() == classes._observed_together(twice, 100).count()


GRIDS = (
    "<table><tr><td>No</td><td>Publication date</td></tr><tr><td>k</td><td>x</td></tr></table><table><tr><td>No</td></tr><tr><td> Key </td><td>1</td></tr><tr><td>Address</td><td>home</td></tr>"
    "<tr><td>Name of Certified Review Board</td><td>B</td></tr><tr><td>Address</td><td>o &amp; p</td></tr><tr><td>Address</td><td>q</td></tr><tr><td>Key</td><td>2</td></tr><tr><td>Key</td><td>1</td></tr>"
    "<tr><td>Key</td><td>2</td></tr><tr><td></td><td>no</td></tr><tr></tr><tr><td>S</td><td>S</td><td>v</td></tr><tr><td>S</td><td></td><td>w</td></tr><tr><td>A</td><td>B</td><td>C</td><td> x</td><td>y </td></tr></table>"
    "<table><tr><td rowspan=2>Key</td><td>3</td></tr><tr><td>\xa0 4</td></tr><tr><td colspan=3>in<table><tr><td>S</td><td>S</td><td>z</td></tr><tr><td>Address</td><td>n</td></tr></table></td></tr></table>"
)


def test_grid_fields_are_read_where_pages_are_parsed(spark):
    data = [(1, GRIDS), (2, "<p>no table</p>"), (3, None), (4, GRIDS[::2]), (None, GRIDS)]
    listed = spark.createDataFrame(data, "page_id long, html string")
    found = trials.grid_records(listed)
    assert "Exchange" not in plan(found)
    assert rows(found) == rows(trials._grid_across_pages(listed))
    got = {(r.label, r.value) for r in found.filter("page_id = 1").collect()}
    assert got >= {("Key", "1"), ("Key (2)", "2"), ("Key (3)", "2"), ("Key (4)", "3"), ("Address", "home"), ("Address (2)", "n"), ("Certified Review Board - Address", "q"), ("S", "z")}
    # Pages that share an id, and pages without one, stay what they were.
    twice = listed.unionByName(listed.filter("page_id = 1 or page_id is null"))
    assert rows(trials.grid_records(twice)) == rows(trials._grid_across_pages(twice))


TRIAL = (
    "<table><tr><td>Phase</td><td>not here</td></tr></table><table border='1'><tr><td>CTRI Number</td><td>CTRI/2021/05/033 [Registered on: 03/05/2021 ]\xa0 Registered Retrospectively</td></tr>"
    "<tr><td>CTRI\nNumber</td><td>CTRI/2020/01/7</td></tr><tr><th>Phase</th><td>2</td></tr><tr><td>Phase </td><td>3</td></tr><tr><td>Phase</td><td>1 &lt; 2</td></tr><tr><td>(&eacute;)</td><td>no label</td></tr>"
    "<tr><td>Details of Contact Person (Scientific Query)</td><td><table><tr><td>Name :</td><td>Ann \"A\" \\ \x01\x1b B/C</td></tr><tr><td>one</td></tr><tr><td>E Mail: </td><td>a@b</td></tr><tr><td>NAME</td><td>Éva</td></tr><tr><td>:</td><td>e</td></tr></table></td></tr>"
    "<tr><td>Contact Person (Public Query)</td><td><table></table><table><tr><td>Name</td><td>second table</td></tr></table></td></tr>"
    "<tr><td>Health Condition / Problems Studied</td><td><table><tr><td>Title</td></tr><tr><td>Type</td><td>Condition (x)</td><td>Type</td></tr><tr><td rowspan=2>P</td><td>Flu \n &amp;</td><td>c</td></tr><tr><td>d</td></tr><tr><td>div</td></tr><tr><td>l</td><td>m</td><td>n</td><td>o</td></tr></table></td></tr>"
    "<tr><td>Health Conditions</td><td><table><tr><td>Type</td></tr><tr><td>A</td></tr></table></td></tr><tr><td>Secondary IDs if Any</td><td><table><tr></tr><tr><td>a</td><td>b</td></tr></table></td></tr>"
    "<tr><td>Source of Monetary or Material Support</td><td>x<table><tr><td>Fund</td><td> N/A </td></tr><tr><td></td><td colspan=2>F \xa0 2</td></tr></table></td></tr><tr><td>three</td><td>cells</td><td>here</td></tr>"
    "<tr><td>Intervention / Comparator Agent</td><td></td></tr></table><table bordercolor=lightgrey><tr><td>Phase</td><td>grey</td></tr></table>"
)


def test_trial_pages_are_read_where_they_are_parsed(spark, monkeypatch):
    data = [(1, TRIAL), (2, "INVALID"), (3, None), (4, TRIAL.replace("lightgrey", "grey")), (5, TRIAL[::3]), (6, "<p>no table</p>"), (7, "<table border=1></table>"), (None, TRIAL)]
    listed = spark.createDataFrame(data, "page_id long, html string")
    flat = trials.flat_pages(listed)
    assert "Exchange" not in plan(flat) and rows(flat.select("page_id", "part")) == [(1, 0), (4, 0)]
    assert rows(trials._whole_records(listed)) == rows(trials._records_across_pages(listed))
    got = flat.filter("page_id = 4").first()
    assert (got.ctri_id, got.registration_date, got.registration_type) == ("CTRI/2021/05/033", "03/05/2021", "Unknown")
    assert got.contact_scientific_name == "Éva" and got.health_conditions.startswith('[{"type":"P","condition_x":"Flu &"}')
    # Pages that share an id stay what they were, and long lists are cut alike.
    monkeypatch.setattr(trials.ordered_list, "__defaults__", tuple(2 if d == trials.GROUP_LIMIT else d for d in trials.ordered_list.__defaults__))
    assert rows(trials._whole_records(listed, 2)) == rows(trials._records_across_pages(listed))
    twice = listed.unionByName(listed.filter("page_id = 1 or page_id is null"))
    assert rows(trials.flat_pages(twice).filter("page_id = 1")) == rows(trials.flat_pages(listed.unionByName(listed)).filter("page_id = 1"))
