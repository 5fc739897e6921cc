"""Line records and page jobs on hand-written inputs."""

import random

from conftest import rows
from pyspark.sql import functions as F

from refloom.operators import pages, records, scans
from refloom.operators.records import fields_to_records, lines_to_fields
from refloom.plans import approvals, classes, trials
from refloom.session import materialize

PAGES = {
    "a": """=====
PAGE 1
Summary
EudraCT Number: 2004-1
Link: https://x/y
Trial Status: Ongoing
(by country)
A. Protocol Information
A.3 Full title: First line
second: line
Sponsor 1
B.1.1 Name: Acme
B. Sponsors
B.5.2 Contact: Ann
D.IMP: 2
D.2.1.1.1 Trade name: Pill
D.8 Placebo: 1
D.8.3 Form: Tablet
Summary
Trial Status: before number
Summary
EudraCT Number: 2005-2
Trial Status: Completed
Trial Status: Stopped
for good
Summary
Trial Status: never numbered
""",
    "b": "A.1 Lost: no record\nSummary\nEudraCT Number: 2006-3\nNote: not a field\n",
}
WANT = {
    ("a", "2004-1"): {
        "EudraCT Number": "2004-1", "Link": "https://x/y", "Trial Status": "Ongoing (by country) A. Protocol Information",
        "A.3 Full title": "First line second: line", "Sponsor 1 - B.1.1 Name": "Acme B. Sponsors", "B.5.2 Contact": "Ann",
        "IMP 2 - D.IMP": "2", "IMP 2 - D.2.1.1.1 Trade name": "Pill", "Placebo 1 - D.8 Placebo": "1",
        "Placebo 1 - D.8.3 Form": "Tablet",
    },
    ("a", "2005-2"): {"EudraCT Number": "2005-2", "Trial Status": "Stopped for good"},
    ("b", "2006-3"): {"EudraCT Number": "2006-3 Note: not a field", "A.1 Lost": "no record"},
}


def _lines(spark, width):
    data = [(f, i // width, i, s) for f, text in PAGES.items() for i, s in enumerate(text.splitlines())]
    return spark.createDataFrame(data, "file string, block long, seq long, line string").repartition(6)


def test_line_records(spark):
    for width, line_limit in ((100, 1000), (100, 0), (3, 0), (1, 0), (3, 20)):
        records = fields_to_records(lines_to_fields(_lines(spark, width), line_limit=line_limit)).collect()
        got = {(r.file, r.fields["EudraCT Number"].split(" ")[0]): r.fields for r in records}
        assert got == WANT


def test_line_record_table(spark):
    got = trials.line_records(_lines(spark, 4))
    assert got.columns[3:6] == ["EudraCT Number", "Link", "Trial Status"]
    assert got.columns[6:] == sorted(got.columns[6:]) and got.count() == 3


def page(spark, *html):
    return spark.createDataFrame([(i, "https://h/x/", h) for i, h in enumerate(html)], "page_id long, url string, html string")


def test_spans(spark):
    html = """<table><tr><td rowspan=2>a</td><td colspan="2">b <i>c</i></td></tr><tr><td>d<td>e</tr>
      <tr><td>f</td><td><table><tr><td>inner</td></tr></table></td></tr></table>"""
    got = pages.grid_rows(pages.table_cells(page(spark, html, None)))
    assert rows(got, "table_no", "row_no", "cells") == [
        (0, 0, ["a", "b c", "b c"]), (0, 1, ["a", "d", "e"]), (0, 2, ["f", "inner"]), (1, 0, ["inner"]),
    ]


def test_grid_fields(spark):
    html = """<table><tr><td>No</td><td>Publication date</td></tr><tr><td>1</td><td>x</td></tr></table>
      <table><tr><td>Key</td><td>1</td></tr><tr><td>Address</td><td>home</td></tr>
      <tr><td>Name of Certified Review Board</td><td>Board</td></tr><tr><td>Address</td><td>office</td></tr>
      <tr><td>Key</td><td>2</td></tr><tr><td>Key</td><td>1</td></tr><tr><td></td><td>no</td></tr>
      <tr><td>S</td><td>S</td><td>v</td></tr><tr><td>S</td><td>T</td><td>w</td></tr>
      <tr><td>A</td><td>B</td><td>C</td><td>x</td><td>y</td></tr></table>"""
    got = {(r.label, r.value) for r in trials.grid_records(page(spark, html)).collect()}
    assert got == {
        ("Key", "1"), ("Key (2)", "2"), ("Address", "home"), ("Certified Review Board - Name", "Board"),
        ("Certified Review Board - Address", "office"), ("S", "v"), ("S - T", "w"), ("A - B - C", "x y"),
    }


def test_records_with_title_row(spark):
    html = """<table><tr><td>No of Sites = 2</td></tr><tr><th>Site Name</th><th>City/Area</th></tr>
      <tr><td>A&nbsp;B</td><td>c</td></tr><tr><td>divider</td></tr><tr><td>x</td><td>y</td><td>z</td></tr></table>"""
    got = [r.fields for r in pages.table_records(pages.table_cells(page(spark, html))).orderBy("row_no").collect()]
    assert got == [{"site_name": "A B", "cityarea": "c"}, {"raw_row": "x | y | z"}]


def test_trial_page(spark):
    html = """<table border="1"><tr><td>CTRI Number</td><td>CTRI/2021/05/033 [Registered on: 03/05/2021] Trial Registered Prospectively</td></tr>
      <tr><td>Details of Contact Person (Scientific Query)</td><td><table><tr><td>Name</td><td>Ann</td></tr><tr><td>Email :</td><td>a@b</td></tr></table></td></tr>
      <tr><td>ExclusionCriteria</td><td><table><tr><td>Details</td><td>none</td></tr></table></td></tr>
      <tr><td>Health Condition / Problems Studied</td><td><table><tr><td>Type</td><td>Condition</td></tr><tr><td>P</td><td>Flu</td></tr></table></td></tr>
      <tr><td>Source of Monetary or Material Support</td><td><table><tr><td>Fund</td></tr><tr><td>N/A</td></tr></table></td></tr>
      <tr><td>Phase</td><td>3</td></tr></table>"""
    (got,) = trials.flat_pages(page(spark, html, "INVALID", "<p>no table</p>")).collect()
    assert (got.ctri_id, got.registration_date, got.registration_type) == ("CTRI/2021/05/033", "03/05/2021", "Prospective")
    assert (got.contact_scientific_name, got.contact_scientific_email, got.exclusion_details) == ("Ann", "a@b", "none")
    assert got.health_conditions == '[{"type":"P","condition":"Flu"}]' and got.source_of_monetary_support == '["Fund"]'
    assert got.sites_of_study == "[]" and got.pi_name == ""
    assert len(got) == 56 and got.part == 0


def test_articles(spark):
    xml = "<article><front>t</front><body><p>One <xref>1</xref> two\n three</p><p> </p><sec><p>Four</p></sec></body></article>"
    bare = "<article>Title\n\n text <ref-list>x</ref-list><back>y</back>\nend</article>"
    assert rows(pages.article_text(page(spark, xml, bare)), "page_id", "body") == [(0, "One two three\n\nFour"), (1, "Title\n\ntext\n\nend")]


def test_observation_page(spark):
    html = """<span id="loinc-id">1-8</span><span id="lcn">Long</span><section id="additional-names"><dl><dt>Fully-Specified Name</dt>
      <dd>Comp\u200b:Prop:Pt:Ser</dd><dt>Short Name</dt><dd>Sh</dd></dl></section><section id="basic"><dl><dt>Class</dt><dd>CHEM</dd>
      <dt>Order vs. Observation</dt><dd>Both</dd></dl></section><section id="related-names"><ul><li>r1</li><li> </li><li>r2</li></ul></section>
      <section id="example-units"><table><tbody><tr><td>mg</td><td>x</td></tr><tr><td>mg</td></tr><tr><td>g</td></tr></tbody></table></section>"""
    (r,) = classes.observations(page(spark, html)).collect()
    assert (r.component, r.property, r.system, r.scale_type) == ("Comp", "Prop", "Ser", "")
    assert (r.short_name, r["class"], r.order_obs, r.related_names, r.example_units) == ("Sh", "CHEM", "Both", "r1; r2", "mg; g")


def test_class_pages(spark):
    html = """<div id=content><b>A&nbsp;<a href="./?code=A&x">ALIMENTARY</a></b><b>A01 <a href="./?code=A01">STOMA</a></b>
      <a href="./?code=A01A">down</a><a href="./?code=zz">no</a><table><tr><td>ATC code</td><td>Name</td></tr>
      <tr><td>A01AA01</td><td>fluoride</td><td>1.1&nbsp;</td><td>mg</td><td>O</td></tr><tr><td>A01AA02</td></tr></table></div>"""
    links = classes.class_links(page(spark, html))
    assert rows(links, "code", "level") == [("A", 1), ("A01", 2), ("A01A", 3)]
    shown = spark.createDataFrame([(0, "A01")], "page_id long, code string")
    assert rows(classes.child_codes(links, shown)) == [("A01", "A01A")]
    assert rows(classes.substances(page(spark, html)), "code", "ddd", "note", "parent_code") == [("A01AA01", "1.1", "", "A01AA")]


def test_chapter_page(spark):
    html = """<div id="classicont"><div class="Chapter"><h1>Chapter I (A00-B99)</h1></div><dl class="Rubric-inclusion-l1"><dt>Incl.:</dt>
      <dd>diseases  that</dd><dd>spread</dd></dl><dl class="Rubric-exclusion"><dd>others</dd></dl><dl class="Rubric-coding-hint"><dd>hint</dd></dl></div>"""
    (r,) = classes.chapters(page(spark, html)).collect()
    assert (r.code_range, r.inclusions, r.exclusions, r.notes) == ("A00-B99", "diseases that;spread", "others", "hint")


def test_approvals(spark):
    html = """<table><tr><td><a href="#a">A</a></td></tr></table>
      <table><tr><th>Brand Name</th><th>Non-proprietary Name</th><th>Approved in</th><th>Report (EN)</th></tr>
      <tr><td>Alpha<sup>Partial change</sup></td><td>a</td><td>July 2024 (Conditional)</td><td><a href="/f.pdf">x</a></td></tr>
      <tr><td>Beta</td><td>b</td><td>2020</td><td></td></tr><tr><td></td><td>c</td><td>d</td><td></td></tr></table>
      <table><tr><td>1</td><td>2</td><td>3</td><td>4</td></tr><tr><td>Gamma</td><td>g</td><td>x</td><td></td></tr></table>"""
    got = approvals.approvals(page(spark, html)).select("brand_name", "approval_type", "approval_date", "en_urls")
    assert rows(got) == [
        ("Alpha", "Partial Change Approval", "2024-07", ["https://h/f.pdf"]), ("Beta", "Initial Approval", "2020-00", []),
        ("Gamma", "Initial Approval", "unknown", []),
    ]


def test_links(spark):
    html = '<a href="/en/documents/leaflet/a.pdf">A</a><a href="/en/documents/leaflet/a.pdf">A2</a><a href="b_fr.pdf">B</a><a>none</a><a href="#">x</a>'
    got = pages.document_links(page(spark, html))
    assert rows(got, "absolute_url", "lang", "kind", "text") == [
        ("https://h/en/documents/leaflet/a.pdf", "en", "leaflet", "A"), ("https://h/x/b_fr.pdf", "fr", "other", "B"),
    ]
    assert pages.document_links(page(spark, html), "fr").count() == 1


def test_simple_list(spark):
    html = "<table><tr><td>One</td></tr><tr><td>NIL</td></tr><tr><td> </td></tr></table>"
    got = pages.simple_list(pages.table_cells(page(spark, html)), ("NIL",))
    assert rows(got, "text") == [("One",)]
    assert got.select(F.max("row_no")).head()[0] == 0


def test_plain_markup_is_read_as_by_the_parser():
    wanted, quiet, apart = frozenset(["table", "tr", "td", "a", "p"]), frozenset(["b"]) | pages.SILENT, frozenset(["sup"])
    bits = [
        "<table>", "</TABLE >", "<tr>", "<td rowspan=2>", '<td x="a&amp;b" y>', "</td>", "x &lt;", " ", "<A href=x/>", "<p/>", "<br/>", "<b>", "</b>", "<sup>", "</sup>", "<!-- c -->",
        "<!-- <td> -->", "<!DOCTYPE html>", "<script>a<b</script>", "<style>y</style>", "</p>", "<", "&#6", "<td a = 1>",
    ]
    draw, plain = random.Random(3), 0
    for _ in range(3_000):
        html = "".join(draw.choices(bits, k=draw.randint(0, 8)))
        fed, got = (pages._Elements(wanted, quiet, apart) for _ in range(2))
        fed.feed(html)
        fed.close()
        got.read(html)
        def shown(p):
            return [(*e[:3], "".join(e[3]), "".join(e[4])) for e in p.found]
        assert shown(fed) == shown(got), html
        plain += not got.rawdata and got.getpos() == (1, 0)
    assert plain > 1_000


def test_rows_of_the_parse_are_rows_of_cells(spark):
    """A grid row leaves the parse as one row; pages that share an id are still taken together."""
    html = "<table><tr><td rowspan=2>a</td><th>b</th></tr><tr><td>c</td></tr></table>"
    twice = spark.createDataFrame([(1, html), (1, html), (None, html)], "page_id long, html string")
    found = pages.table_rows(twice)
    assert found.count() == 6
    assert rows(pages.grid_rows(found)) == rows(pages.grid_rows(pages.table_cells(twice)))
    assert rows(pages.grid_rows(found).filter("page_id = 1 and row_no = 1"), "cells") == [(["a", "a", "c", "c"],)]


def test_class_links_need_no_join(spark):
    html = '<a href="./?code=A01&x">n</a>'
    plan = classes.class_links(page(spark, html))._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


POOL = (
    "Summary", "Summary", "EudraCT Number: 7", "Trial Status: x", "Link: l", "A. Protocol", "A.1 Title: t", "Sponsor 1", "sponsor 22", "Sponsor 1: no",
    "B.1 Name: n", "D.IMP: 3", "D.8 Placebo: 4", "D.8.3 Form: f", "Sec - A.1 Title: u", "Link - other: v", "x: y", "plain", " plain too ", "", "PAGE 3", "=", "c: A.1",
)


def _plain_fields(lines, limit):
    """The same for the lines of one file, one line after the other."""
    found, record, number, fields, field, section = [], 0, False, {}, None, ""
    for line in [x.strip() for x in lines]:
        if not line or line.startswith("=") or line == "PAGE 3":
            continue
        if line == "Summary":
            section = ""
            if number:
                found.append((record, fields))
                record, number, fields, field = record + 1, False, {}, None
            continue
        if line[0] in "AD" and line[1:3] == ". ":
            section = ""
        head, _, tail = line.partition(" ")
        if head.lower() == "sponsor" and tail.isdigit():
            section = f"Sponsor {tail}"
            continue
        section = {"D.IMP: 3": "IMP 3", "D.8 Placebo: 4": "Placebo 4"}.get(line, section)
        name, colon, value = line.partition(":")
        core = name if section else name.split(" - ", 1)[-1]
        if colon and core.lower().startswith(("eudract number", "trial status", "link", "a.1 ", "b.1 ", "d.imp", "d.8 ", "d.8.3 ")):
            field = f"{section} - {name}" if section else name
            fields[field] = [value.strip()]
            number = number or field == "EudraCT Number"
        elif field is not None:
            fields[field].append(line)
    if number:
        found.append((record, fields))
    return [(r, k, i // limit, " ".join(v[i : i + limit])) for r, f in found for k, v in f.items() for i in range(0, len(v), limit)]


def test_fields_of_random_lines(spark):
    """Any cut into blocks gives what reading from the top gives: open sections, fields, parts and records run on across blocks."""
    draw = random.Random(5)
    files = {f: [draw.choice(POOL) for _ in range(n)] for f, n in ((None, 60), ("", 90), ("a", 400), ("b", 3))}
    want = sorted((str(f), *x) for f, lines in files.items() for x in _plain_fields(lines, 2))
    assert len(want) > 100 and any(x[3] > 1 for x in want) and {"Sec - A.1 Title", "Sponsor 1 - Link - other"} <= {x[2] for x in want}
    for line_limit, width in ((1000, 7), (0, 3), (0, 50), (100, 4)):
        data = [(f, i // width if i >= width else None, i, x) for f, lines in files.items() for i, x in enumerate(lines)]
        lines = spark.createDataFrame(data, "file string, block long, seq long, line string").repartition(5)
        got = lines_to_fields(lines, limit=2, line_limit=line_limit).collect()
        assert sorted((str(r.file), r.record, r.label, r.part, r.value) for r in got) == want


def test_lines_of_large_files_move_once(spark, monkeypatch):
    """state is carried by a row per block; the lines themselves are shuffled once, by block, and never written."""
    written = []
    for module in (records, scans):
        monkeypatch.setattr(module, "materialize", lambda df, name: written.append((name, df)) or materialize(df, name), raising=False)
    lines_to_fields(_lines(spark, 3), line_limit=0).collect()
    assert [name for name, _ in written] == ["fields"]
    shuffled = [x for x in written[0][1]._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange hashpartitioning(_at" in x and "REPARTITION_BY_COL" in x]
    # Once for the states and once for the last lines of the blocks, out of the same exchange.
    assert len(shuffled) == 2


def test_lines_of_files_are_sorted_once(spark):
    """running values, fields and labels of ordinary files follow one sort of the lines and one of the fields."""
    text = lines_to_fields(_lines(spark, 3))._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning(") == 1 and text.count("Sort [") <= 2
