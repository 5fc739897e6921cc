"""Web pages to rows.

One vectorised step turns each page into long rows of the elements asked for; everything after it
is DataFrame work. A page is one row, so no task holds more than its batch of pages.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refloom.functions.text import clean, clean_text
from refloom.functions.urls import resolve_url, url_kind, url_language
from refloom.operators.aggregate import ordered_text
from refloom.operators.dedup import dedup_first
from refloom.operators.select import filter_in
from refloom.operators.skew import GROUP_LIMIT, hot_groups, split_hot
from refloom.session import materialize

#: Rows that leave a task at once, so that a batch of pages is never held as elements.
EMITTED = 2_000

# Elements without an end tag, and start tags that end an open element.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
ENDS = {
    "p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"},
}
SCOPES = frozenset({"table", "ul", "ol", "dl", "body", "article", "section", "div"})
SILENT = frozenset({"script", "style"})


#: What most mark-up is made of, in forms that need no tolerance: end tags, start tags (with the text and the end tag of an element that holds text alone), and
#: comments, declarations and scripts without a ``<`` inside.
TOKEN = re.compile(
    r"""</([a-zA-Z][a-zA-Z0-9]*)[ \t\n\r\f]*>
    |<(?!(?:script|style)[ \t\n\r\f/>])([a-zA-Z][a-zA-Z0-9]*)
      ((?:[ \t\n\r\f]+[a-zA-Z_:][-a-zA-Z0-9_:.]*(?:="[^"<>]*"|='[^'<>]*'|=[-a-zA-Z0-9_\#.%]+)?)*[ \t\n\r\f]*/?)>
      (?:([^<]*+)</\2[ \t\n\r\f]*>)?
    |<!--[^<>]*-->|<!doctype[^<>]*>|<(?P<cdata>script|style)(?:[ \t\n\r\f]+[a-z][-a-z]*="[^"<>]*")*>[^<]*</(?P=cdata)>""",
    re.VERBOSE | re.IGNORECASE | re.ASCII,
)
#: The attributes of a start tag that ``TOKEN`` took.
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-a-zA-Z0-9_:.]*)(?:="([^"]*)"|='([^']*)'|=([-a-zA-Z0-9_\#.%]+))?""", re.ASCII)


class _StartTag(HTMLParser):
    """Name, attributes and self-closing slash of one start tag."""

    got: tuple[str, dict, bool] | None = None

    def handle_starttag(self, tag, attrs):
        self.got = tag, {k: v or "" for k, v in attrs}, False

    def handle_startendtag(self, tag, attrs):
        self.got = tag, {k: v or "" for k, v in attrs}, True


@lru_cache(4_096)
def _parsed_tag(markup: str) -> tuple[str, dict, bool] | None:
    parser = _StartTag()
    parser.feed(markup)
    return parser.got


def _start_tag(tag: str, more: str) -> tuple[str, dict, bool]:
    """The start tag of a token. Character references and closing slashes are left to the tolerant parser."""
    if "&" in more or more[-1] == "/":
        return _parsed_tag(f"<{tag}{more}>")
    return tag.lower(), {name.lower(): a or b or c for name, a, b, c in ATTRIBUTE.findall(more)}, False


class _Elements(HTMLParser):
    """Elements of the wanted tags in document order, with their text. Those of other tags than ``only`` have none."""

    def __init__(
        self, wanted: frozenset[str], skip: frozenset[str], apart: frozenset[str] = frozenset(), only: frozenset[str] | None = None,
        around: frozenset[str] | None = None,
    ):
        super().__init__(convert_charrefs=True)
        self.wanted, self.skip, self.apart, self.noted = wanted, skip, apart, skip | apart
        self.only = wanted if only is None else only
        self.around = wanted if around is None else around
        self.open: list[tuple[str, int | None, list[str] | None]] = []
        self.found: list[list] = []
        self.quiet = self.aside = 0

    def read(self, markup: str) -> None:
        """All of a page. Plain mark-up is cut by one expression; a page with anything else in it is left to the tolerant parser."""
        bits = TOKEN.split(markup)
        texts, leaves, scripts = bits[::6], bits[4::6], bits[5::6]
        # Every token has one "<", scripts and elements that hold text alone have two.
        if markup.count("<") != 3 * len(leaves) - leaves.count(None) - scripts.count(None) or self.wanted & SILENT:
            self.feed(markup)
            self.close()
            return
        stack, noted, found, wanted = self.open, self.noted, self.found, self.wanted
        for data, end, tag, more, leaf in zip(texts, bits[1::6], bits[2::6], bits[3::6], leaves):
            if data and stack:
                self.handle_data(unescape(data) if "&" in data else data)
            if end:
                tag = end.lower()
                # Mostly it is the innermost element that ends.
                if stack and stack[-1][0] == tag and tag not in noted:
                    stack.pop()
                else:
                    self.handle_endtag(tag)
            elif tag:
                attrs, closed = {}, False
                if more:
                    tag, attrs, closed = _start_tag(tag, more)
                else:
                    tag = tag.lower()
                if leaf is None or closed or tag in noted or tag in VOID:
                    self._start(tag, attrs)
                    if closed:
                        self.handle_endtag(tag)
                    if leaf is not None:
                        if leaf and stack:
                            self.handle_data(unescape(leaf) if "&" in leaf else leaf)
                        self.handle_endtag(tag)
                    continue
                # An element that holds text alone is never open for anything else.
                if tag in ENDS:
                    self._end(tag)
                if "&" in leaf:
                    leaf = unescape(leaf)
                if tag in wanted:
                    heard = [leaf] if leaf and not self.quiet else []
                    bits = heard if tag in self.only else None
                    found.append([self._parent(), tag, attrs, bits, heard[:] if bits and self.apart and not self.aside else []])
                if leaf and stack:
                    self.handle_data(leaf)
        if texts[-1] and stack:
            self.handle_data(unescape(texts[-1]) if "&" in texts[-1] else texts[-1])

    def _parent(self) -> int | None:
        for name, row, _ in reversed(self.open):
            if name in self.around:
                return row
        return None

    def _end(self, tag: str) -> None:
        """Close what a start tag ends."""
        ends = ENDS[tag]
        for at in range(len(self.open) - 1, -1, -1):
            name = self.open[at][0]
            if name in ends:
                self._close(at)
            elif name in SCOPES:
                break

    def handle_starttag(self, tag, attrs):
        self._start(tag, {k: v or "" for k, v in attrs})

    def _start(self, tag: str, attrs: dict[str, str]):
        if tag in ENDS:
            self._end(tag)
        if tag in VOID:
            return
        row = bits = None
        if tag in self.wanted:
            row, bits = len(self.found), [] if tag in self.only else None
            self.found.append([self._parent(), tag, attrs, bits, []])
        self.open.append((tag, row, bits))
        if tag in self.noted:
            self.quiet += tag in self.skip
            self.aside += tag in self.apart

    def handle_endtag(self, tag):
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._close(at)
                return

    def _close(self, at: int):
        for tag, *_ in self.open[at:]:
            if tag in self.noted:
                self.quiet -= tag in self.skip
                self.aside -= tag in self.apart
        del self.open[at:]

    def handle_data(self, data):
        if not self.quiet:
            for _, _, bits in self.open:
                if bits is not None:
                    bits.append(data)
            if self.apart and not self.aside:
                for _, row, bits in self.open:
                    if bits is not None:
                        self.found[row][4].append(data)


def spaced(bits: Sequence[str]) -> str:
    if len(bits) == 1:
        return bits[0].strip()
    return " ".join([b for x in bits if (b := x.strip())])


def _maps(values: Sequence[dict]) -> pa.Array:
    offsets = [0, *accumulate(map(len, values))]
    return pa.MapArray.from_arrays(offsets, pa.array([k for v in values for k in v], pa.string()), pa.array([x for v in values for x in v.values()], pa.string()))


def _spots(values: Sequence[list[tuple[int, int]] | None]) -> pa.Array:
    offsets = [0, *accumulate(len(v or ()) for v in values)]
    # A place that begins with NULL in the offsets is a NULL list.
    starts = [None if v is None else at for v, at in zip(values, offsets)] + offsets[-1:]
    flat = [x for v in values if v for x in v]
    places = pa.StructArray.from_arrays([pa.array([x[i] for x in flat], pa.int32()) for i in (0, 1)], ["row_no", "col_no"])
    return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), places)


#: Columns of an element: the type, and how it is built.
COLUMNS = {
    "page_id": ("long", pa.int64()), "seq": ("int", pa.int32()), "parent": ("int", pa.int32()), "tag": ("string", pa.string()),
    "attrs": ("map<string,string>", _maps), "text": ("string", pa.string()), "spaced": ("string", pa.string()), "bare": ("string", pa.string()),
    "table_no": ("int", pa.int32()), "spots": ("array<struct<row_no: int, col_no: int>>", _spots),
}


def elements(
    pages: DataFrame, tags: Sequence[str], skip: Sequence[str] = (), html: str = "html", apart: Sequence[str] = (), grid: bool = False,
    columns: Sequence[str] = (), only: Sequence[str] = (), carry: Sequence[str] = (), around: Sequence[str] = (),
) -> DataFrame:
    """Elements of some tags per page, with the nearest wanted element around each, of the tags ``around`` if given.

    ``text`` is the raw text, ``spaced`` its pieces trimmed and joined by one space. Text in scripts,
    styles and ``skip`` elements is left out. With ``apart``, ``bare`` is the spaced text without what stands in such elements. With ``grid``,
    cells have ``table_no`` and ``spots``, the places (row_no, col_no) that they fill in it, spans included (see ``grid_cells``).
    Of all these, ``columns`` names those that are needed besides the page, and ``only`` the tags whose elements are; ``carry`` names text columns of the page.
    """
    wanted, quiet, aside = frozenset(tags), frozenset(skip) | SILENT, frozenset(apart)
    shown = frozenset(only) or wanted
    parents = frozenset(around) or wanted
    names = ["page_id", *(columns or ["seq", "parent", "tag", "attrs", "text", "spaced", *["bare"] * bool(apart), *["table_no", "spots"] * grid])]
    ddl = ", ".join([f"{n} {COLUMNS[n][0]}" for n in names] + [f"{c} string" for c in carry])

    def page_rows(out: dict[str, list], page: int, markup: str | None, carried: tuple) -> None:
        parser = _Elements(wanted, quiet, aside, shown, parents)
        parser.read(markup or "")
        places = _places(parser.found) if grid else {}
        kept = [(seq, e) for seq, e in enumerate(parser.found) if e[1] in shown] if only else list(enumerate(parser.found))
        made = {
            "page_id": lambda: [page] * len(kept), "seq": lambda: [seq for seq, _ in kept], "parent": lambda: [e[0] for _, e in kept],
            "tag": lambda: [e[1] for _, e in kept], "attrs": lambda: [e[2] for _, e in kept], "text": lambda: ["".join(e[3]) for _, e in kept],
            "spaced": lambda: [spaced(e[3]) for _, e in kept], "bare": lambda: [spaced(e[4]) for _, e in kept],
            "table_no": lambda: [places.get(seq, (None, None))[0] for seq, _ in kept], "spots": lambda: [places.get(seq, (None, None))[1] for seq, _ in kept],
        }
        for n in names:
            out[n] += made[n]()
        for c, value in zip(carry, carried):
            out[c] += [value] * len(kept)

    def batch(out: dict[str, list]) -> pa.RecordBatch:
        arrays = [pa.array(out[n], how) if isinstance(how := COLUMNS[n][1], pa.DataType) else how(out[n]) for n in names]
        return pa.RecordBatch.from_arrays(arrays + [pa.array(out[c], pa.string()) for c in carry], names=[*names, *carry])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in batches:
            out = {n: [] for n in [*names, *carry]}
            for page, markup, *carried in zip(*found.columns):
                page_rows(out, page.as_py(), markup.as_py(), tuple(c.as_py() for c in carried))
                if len(out["page_id"]) >= EMITTED:
                    yield batch(out)
                    out = {n: [] for n in out}
            yield batch(out)

    return pages.select(F.col("page_id").cast("long"), F.col(html).alias("html"), *carry).mapInArrow(parse, ddl)


def parsed(
    pages: DataFrame, tags: Sequence[str], skip: Sequence[str] = (), apart: Sequence[str] = (), grid: bool = False, columns: Sequence[str] = (),
    only: Sequence[str] = (), carry: Sequence[str] = (), around: Sequence[str] = (),
) -> DataFrame:
    """Elements written once, for jobs that look at them several times: parsing is the costly step."""
    return materialize(elements(pages, tags, skip, apart=apart, grid=grid, columns=columns, only=only, carry=carry, around=around), "elements")


def link_rows(pages: DataFrame, *carry: str) -> DataFrame:
    """(page_id, pos, href, text) of all links with a target, and columns of their page."""
    links = elements(pages, ["a"], columns=["seq", "attrs", "text"], carry=carry).filter("page_id is not null")
    links = links.filter(F.coalesce(F.col("attrs")["href"], F.lit("")) != "")
    return links.select("page_id", F.col("seq").alias("pos"), F.col("attrs")["href"].alias("href"), clean_text("text").alias("text"), *carry)


def page_links(pages: DataFrame) -> DataFrame:
    """(page_id, pos, url, href, text, absolute_url) of all links with a target."""
    return link_rows(pages).join(pages.select("page_id", "url"), "page_id").withColumn("absolute_url", resolve_url("url", "href"))


def document_links(pages: DataFrame, languages: str = "all") -> DataFrame:
    """Links to documents with language and kind, one row per absolute URL, first seen wins."""
    target = F.lower("href")
    links = link_rows(pages, "url").filter(F.contains(target, F.lit("pdf")) | F.contains(target, F.lit("/document/")))
    links = links.withColumn("absolute_url", resolve_url("url", "href"))
    links = links.withColumns({"lang": url_language("absolute_url"), "kind": url_kind("absolute_url")})
    return dedup_first(filter_in(links, "lang", languages), ["absolute_url"], ["page_id", "pos"])


def _spread(cells: Sequence[tuple[int, int, int, int]]) -> Iterator[tuple[int, int, int]]:
    """Grid of one table: each cell (row, rows and columns it spans, its number) fills places, later ones win."""
    if all(down == across == 1 for _, down, across, _ in cells):
        at: Counter[int] = Counter()
        for row, _, _, cell in cells:
            yield row, at[row], cell
            at[row] += 1
        return
    taken: dict[tuple[int, int], int] = {}
    rows = max((c[0] for c in cells), default=-1) + 1
    free = [0] * rows
    for row, down, across, cell in cells:
        at = free[row]
        while (row, at) in taken:
            at += 1
        for r in range(row, min(row + down, rows)):
            for c in range(at, at + across):
                taken[r, c] = cell
        free[row] = at + across
    for (r, c), cell in sorted(taken.items()):
        yield r, c, cell


def _span(attrs: dict, name: str) -> int:
    if not attrs:
        return 1
    value = attrs.get(name, "1").strip()
    return max(int(value), 1) if value.isdigit() else 1


def _grids(found: Sequence[list]) -> dict[int, tuple[int, list[tuple[int, int, int, int]]]]:
    """Number and cells (row, rows and columns spanned, element) of every table; cells belong to the innermost table around them."""
    tables, rows, heights = {}, {}, {}
    for seq, (parent, tag, attrs, *_) in enumerate(found):
        if tag == "table":
            tables[seq], heights[seq] = (len(tables), []), 0
        elif tag == "tr" and parent in tables:
            rows[seq] = (parent, heights[parent])
            heights[parent] += 1
        elif tag in ("td", "th") and parent in rows:
            table, row = rows[parent]
            tables[table][1].append((row, _span(attrs, "rowspan"), _span(attrs, "colspan"), seq) if attrs else (row, 1, 1, seq))
    return tables


def _places(found: Sequence[list]) -> dict[int, tuple[int, list[tuple[int, int]]]]:
    """Table number and filled places of every cell."""
    tables = _grids(found)
    out = {seq: (number, []) for seq, (number, _) in tables.items()}
    for number, of_table in tables.values():
        out |= {seq: (number, []) for *_, seq in of_table}
        for row, col, seq in _spread(of_table):
            out[seq][1].append((row, col))
    return out


def table_rows(pages: DataFrame, html: str = "html") -> DataFrame:
    """The cell grid of all tables by rows: (page_id, table_no, row_no, items of col_no, text and is_header)."""
    wanted, shown = frozenset(["table", "tr", "td", "th"]), frozenset(["td", "th"])

    def batch(rows: list[tuple[int, int, int]], sizes: list[int], items: list[tuple[int, str, bool]]) -> pa.RecordBatch:
        kinds = {"col_no": pa.int32(), "text": pa.string(), "is_header": pa.bool_()}
        cells = pa.StructArray.from_arrays([pa.array([x[i] for x in items], kind) for i, kind in enumerate(kinds.values())], list(kinds))
        lists = pa.ListArray.from_arrays(pa.array([0, *accumulate(sizes)], pa.int32()), cells)
        places = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int32()))]
        return pa.RecordBatch.from_arrays([*places, lists], names=[*ROW, "items"])

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            rows, sizes, items = [], [], []
            for page, markup in zip(*given.columns):
                parser = _Elements(wanted, SILENT, only=shown)
                parser.read(markup.as_py() or "")
                page, found = page.as_py(), parser.found
                for number, of_table in _grids(found).values():
                    texts = {seq: spaced(found[seq][3]) for *_, seq in of_table}
                    last = None
                    for row, col, seq in _spread(of_table):
                        if row != last:
                            rows.append((page, number, row))
                            sizes.append(0)
                            last = row
                        sizes[-1] += 1
                        items.append((col, texts[seq], found[seq][1] == "th"))
                if len(items) >= EMITTED:
                    yield batch(rows, sizes, items)
                    rows, sizes, items = [], [], []
            yield batch(rows, sizes, items)

    ddl = "page_id long, table_no int, row_no int, items array<struct<col_no: int, text: string, is_header: boolean>>"
    return pages.select(F.col("page_id").cast("long"), F.col(html).alias("html")).mapInArrow(parse, ddl)


def by_page(pages: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Pages whose id no other page has, and those that share theirs (None if there are none).

    What is known of the first kind is whole where a page is parsed; only pages that share an id are brought together by their elements.
    """
    pages = pages.withColumn("page_id", F.col("page_id").cast("long"))
    shared = hot_groups(pages, ["page_id"], 1)
    return (pages, None) if shared is None else split_hot(pages, ["page_id"], shared)


def per_page(
    pages: DataFrame, tags: Sequence[str], ddl: str, kinds: Sequence[pa.DataType], made: Callable[[int | None, _Elements], Iterator[tuple]],
    only: Sequence[str] = (), apart: Sequence[str] = (),
) -> DataFrame:
    """Rows that ``made`` gives for a page's elements, in one parse; a column ``url`` of ``ddl`` is the page's own and comes last."""
    wanted, shown, aside = frozenset(tags), frozenset(only or tags), frozenset(apart)
    carry = ["url"] * ("url string" in ddl)
    names = [x.split()[0] for x in ddl.split(";")]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [()] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for given in batches:
            rows = []
            for page, markup, *carried in zip(*given.columns):
                parser = _Elements(wanted, SILENT, aside, shown)
                parser.read(markup.as_py() or "")
                more = tuple(c.as_py() for c in carried)
                rows += [(*row, *more) for row in made(page.as_py(), parser)]
                if len(rows) >= EMITTED:
                    yield batch(rows)
                    rows = []
            yield batch(rows)

    return pages.select("page_id", "html", *carry).mapInArrow(parse, ddl.replace(";", ","))


def filled_rows(found: Sequence[list], of_table: Sequence[tuple[int, int, int, int]]) -> list[tuple[int, list[str]]]:
    """Rows of one table out of ``_grids``: number and the texts of the cells, spans filled."""
    rows: dict[int, list[str]] = {}
    for at, _, seq in _spread(of_table):
        text = spaced(found[seq][3])
        if at in rows:
            rows[at].append(text)
        else:
            rows[at] = [text]
    return sorted(rows.items())


def whole_tables(pages: DataFrame) -> DataFrame:
    """All tables, one row each: (page_id, table_no, rows of row_no and the texts of the cells, spans filled)."""
    row = pa.struct([("row_no", pa.int32()), ("cells", pa.list_(pa.string()))])

    def tables(page: int | None, parser: _Elements) -> Iterator[tuple]:
        for number, of_table in _grids(parser.found).values():
            if rows := filled_rows(parser.found, of_table):
                yield page, number, [{"row_no": at, "cells": cells} for at, cells in rows]

    ddl = "page_id long; table_no int; rows array<struct<row_no: int, cells: array<string>>>"
    return per_page(pages, ["table", "tr", "td", "th"], ddl, [pa.int64(), pa.int32(), pa.list_(row)], tables, ["td", "th"])


def grid_cells(found: DataFrame) -> DataFrame:
    """Cell grid out of elements parsed with ``grid`` and at least table, tr, td and th."""
    cells = found.filter("tag in ('td', 'th')").select("page_id", "table_no", F.inline("spots"), F.col("spaced").alias("text"), (F.col("tag") == "th").alias("is_header"))
    return cells.select("page_id", "table_no", "row_no", "col_no", "text", "is_header")


def table_cells(pages: DataFrame, html: str = "html") -> DataFrame:
    """Cell grid of all tables, row and column spans filled: (page_id, table_no, row_no, col_no, text, is_header).

    Cells belong to the innermost table around them.
    """
    return table_rows(pages, html).select(*ROW, F.inline("items"))


ROW = ["page_id", "table_no", "row_no"]


def grid_rows(cells: DataFrame) -> DataFrame:
    """Grid rows with the cells as an array, out of cells or of ``table_rows``. A row is as wide as its page made it, so lists stay small.

    They are dealt out by table, so that what looks at whole tables next finds them in place.
    """
    if "items" in cells.columns:
        found = F.flatten(F.collect_list(F.transform("items", lambda x: F.struct(x["col_no"].alias("col_no"), x["text"].alias("text")))))
    else:
        found = F.collect_list(F.struct("col_no", "text"))
    rows = cells.repartition("page_id", "table_no").groupBy(*ROW)
    return rows.agg(F.transform(F.sort_array(found), lambda x: x["text"]).alias("cells"))


def _of_table(value: Column) -> Column:
    """A value of the whole table that a row is in; NULL for a page without an id, which no table belongs to."""
    return F.when(F.col("page_id").isNotNull(), value.over(Window.partitionBy("page_id", "table_no")))


# The label that opens a section, the section name, and the labels it prefixes.
SECTION_OPENER = "Name of Certified Review Board"
SECTION_NAME = "Certified Review Board"
SECTION_LABELS = ("Address", "Telephone", "E-Mail", "Approval Status", "Date of approval")


def grid_fields(cells: DataFrame) -> DataFrame:
    """Label and value of each grid row of two, three or more columns: (page_id, table_no, row_no, label, value, plain).

    ``plain`` marks labels that need a number when they repeat. Revision tables are left out.
    """
    rows = grid_rows(cells)
    c = [F.trim(F.get("cells", F.lit(i))) for i in range(4)]
    revision = (F.col("row_no") == 0) & (c[0] == "No") & (c[1] == "Publication date")
    rows = rows.withColumn("_revised", _of_table(F.max(revision))).filter("not coalesce(_revised, false)")
    width = F.size("cells")
    opener = (width == 2) & (c[0] == SECTION_OPENER)
    rows = _carry(rows.withColumn("_opens", opener))
    prefixed = F.col("_section").isNotNull() & c[0].isin(*SECTION_LABELS)
    tail = F.trim(F.array_join(F.slice("cells", 4, F.greatest(width, F.lit(1))), " "))
    label = (
        F.when(opener, F.lit(f"{SECTION_NAME} - Name"))
        .when((width == 2) & prefixed, F.concat(F.lit(f"{SECTION_NAME} - "), c[0]))
        .when(width == 2, c[0])
        .when((width == 3) & (c[0] == c[1]), c[0])
        .when(width == 3, F.concat_ws(" - ", c[0], c[1]))
        .when(width >= 4, F.concat_ws(" - ", c[0], c[1], c[2]))
    )
    value = F.when(width == 2, c[1]).when(width == 3, c[2]).otherwise(tail)
    plain = (width == 2) & ~opener & ~prefixed
    out = rows.select(*ROW, label.alias("label"), value.alias("value"), plain.alias("plain"))
    return out.filter(F.col("label").isNotNull() & (F.col("label") != ""))


def _fields(page: int | None, rows: Sequence[tuple[int, list[str]]]) -> Iterator[tuple[str, str, bool]]:
    """``grid_fields`` of one table, its rows in order: label, value and whether it is plain."""
    section = False
    for at, cells in rows:
        c, width = [x.strip(" ") for x in cells], len(cells)
        # A page without an id has no tables as a whole, see ``_of_table``.
        if at == 0 and page is not None and c[:2] == ["No", "Publication date"]:
            return
        opener = width == 2 and c[0] == SECTION_OPENER
        section = section or (opener and page is not None)
        prefixed = section and c[0] in SECTION_LABELS
        if width == 2:
            label = f"{SECTION_NAME} - Name" if opener else f"{SECTION_NAME} - {c[0]}" if prefixed else c[0]
            value = c[1]
        elif width == 3:
            label, value = c[0] if c[0] == c[1] else f"{c[0]} - {c[1]}", c[2]
        elif width > 3:
            label, value = " - ".join(c[:3]), " ".join(cells[3:]).strip(" ")
        else:
            continue
        if label:
            yield label, value, width == 2 and not opener and not prefixed


def page_fields(pages: DataFrame) -> DataFrame:
    """(page_id, label, value) of pages whose ids differ, ``grid_fields`` with one row per label: looked at where a page is parsed.

    A plain label that comes again with another value than the first gets a number; of any other label the last counts.
    """
    def fields(page: int | None, parser: _Elements) -> Iterator[tuple]:
        firsts, counts, lasts = {}, Counter(), {}
        for _, of_table in _grids(parser.found).values():
            for label, value, plain in _fields(page, filled_rows(parser.found, of_table)):
                if not plain:
                    lasts[label] = value
                elif label not in firsts or value != firsts[label]:
                    firsts.setdefault(label, value)
                    counts[label] += 1
                    yield page, label if counts[label] == 1 else f"{label} ({counts[label]})", value
        for label, value in lasts.items():
            yield page, label, value

    ddl = "page_id long; label string; value string"
    return per_page(pages, ["table", "tr", "td", "th"], ddl, [pa.int64(), pa.string(), pa.string()], fields, ["td", "th"])


def _carry(rows: DataFrame) -> DataFrame:
    """Section open at each row of a table: some earlier row of the table opened it."""
    first = _of_table(F.min(F.when(F.col("_opens"), F.col("row_no"))))
    return rows.withColumn("_section", F.when(F.col("row_no") >= first, F.lit(SECTION_NAME)))


_NO_NAME = re.compile(r"[^a-zA-Z0-9_ ]")


def header_name(c: Column) -> Column:
    """Header cell as a lower snake case name."""
    bare = F.trim(F.regexp_replace(clean_text(c), r"[^a-zA-Z0-9_\s]", ""))
    return F.replace(F.lower(bare), F.lit(" "), F.lit("_"))


#: Characters of a text whose name is remembered.
SHORT = 200


@lru_cache(4_096)
def _short_name(text: str) -> str:
    return _NO_NAME.sub("", clean(text)).strip(" ").lower().replace(" ", "_")


def field_name(text: str) -> str:
    """``header_name`` of one text."""
    return _short_name(text) if len(text) <= SHORT else _short_name.__wrapped__(text)


def table_records(cells: DataFrame) -> DataFrame:
    """Records of tables with a header row: (page_id, table_no, row_no, fields).

    A one-cell title row above the header is skipped, one-cell dividers are dropped, and a row that
    does not fit the header becomes ``raw_row`` text.
    """
    rows = grid_rows(cells)
    width = F.size("cells")
    w0, w1 = (F.max(F.when(F.col("row_no") == n, width)) for n in (0, 1))
    rows = rows.filter("page_id is not null").withColumns({"_w0": _of_table(w0), "_w1": _of_table(w1)})
    rows = rows.withColumn("_head", F.when((F.col("_w0") == 1) & (F.col("_w1") > 1), 1).otherwise(0))
    rows = rows.filter("_w0 is not null or _w1 is not null")
    rows = rows.withColumn("names", _of_table(F.max(F.when(F.col("row_no") == F.col("_head"), F.transform("cells", header_name)))))
    return _fielded(_keyed(rows))


def page_records(pages: DataFrame) -> DataFrame:
    """``table_records`` of all tables of pages, each looked at where its page is parsed."""
    once, shared = by_page(pages)

    def row(n: int | Column) -> Column:
        return F.get(F.filter(F.slice("rows", 1, 2), lambda x: x["row_no"] == n), F.lit(0))["cells"]

    tables = whole_tables(once.filter("page_id is not null"))
    tables = tables.withColumn("_head", F.when((F.size(row(0)) == 1) & (F.size(row(1)) > 1), 1).otherwise(0))
    tables = tables.withColumn("names", F.transform(row(F.col("_head")), header_name)).filter("names is not null")
    found = _fielded(_keyed(tables).select("page_id", "table_no", "_head", "names", "_keys", "_at", F.inline("rows")))
    return found if shared is None else found.unionByName(table_records(table_rows(shared)))


def _fielded(rows: DataFrame) -> DataFrame:
    """Fields of the rows below the header, ``_head``, whose cells are ``names``; see ``_keyed``."""
    data = rows.filter((F.col("row_no") > F.col("_head")) & F.col("names").isNotNull())
    fits = F.size("cells") == F.size("names")
    data = data.filter(~((F.size("cells") == 1) & (F.size("names") > 1)))
    clean = F.transform("cells", clean_text)
    raw = F.create_map(F.lit("raw_row"), F.array_join(clean, " | "))
    return data.select(
        *ROW, F.when(fits, F.map_from_arrays("_keys", F.transform("_at", lambda i: clean_text(F.get("cells", i))))).otherwise(raw).alias("fields")
    )


def fielded_rows(rows: Sequence[tuple[int, list[str]]]) -> list[dict[str, str]]:
    """``table_records`` of one table, its rows in order."""
    by_number = dict(rows)
    first, second = by_number.get(0), by_number.get(1)
    head = int(first is not None and len(first) == 1 and second is not None and len(second) > 1)
    if head not in by_number:
        return []
    names, out = [field_name(x) for x in by_number[head]], []
    for at, cells in rows:
        if at <= head or (len(cells) == 1 and len(names) > 1):
            continue
        cells = [clean(x) for x in cells]
        fields: dict[str, str] = {}
        for name, cell in zip(names, cells):
            fields.setdefault(name, cell)
        out.append(fields if len(cells) == len(names) else {"raw_row": " | ".join(cells)})
    return out


def _keyed(rows: DataFrame) -> DataFrame:
    """Names that a record has as keys, and their places in a row: of equal names the first counts."""
    at = F.filter(F.transform("names", lambda x, i: i), lambda i: F.array_position(F.col("names"), F.get("names", i)) == i + 1)
    rows = rows.withColumn("_at", at)
    return rows.withColumn("_keys", F.transform("_at", lambda i: F.get("names", i)))


def simple_list(cells: DataFrame, sentinels: Sequence[str]) -> DataFrame:
    """Non-empty cells of a table that mean something: (page_id, table_no, row_no, col_no, text)."""
    text = clean_text("text")
    return cells.filter((text != "") & ~text.isin(*sentinels)).select(*ROW, "col_no", text.alias("text"))


def key_values(rows: Sequence[tuple[int, list[str]]]) -> dict[str, str]:
    """``key_value_rows`` of one table, its rows in order: of equal labels the last row stays, at its own place."""
    out: dict[str, str] = {}
    for _, cells in rows:
        if len(cells) == 2:
            label = clean(cells[0]).rstrip(": ").lower().replace(" ", "_")
            if label in out:
                del out[label]
            out[label] = clean(cells[1])
    return out


def key_value_rows(cells: DataFrame) -> DataFrame:
    """Two-cell rows as (page_id, table_no, row_no, label, value); the label loses its colon and becomes a name."""
    rows = grid_rows(cells).filter(F.size("cells") == 2)
    label = F.regexp_replace(clean_text(F.get("cells", F.lit(0))), r"[:\s]+$", "")
    return rows.select(
        *ROW, F.replace(F.lower(label), F.lit(" "), F.lit("_")).alias("label"),
        clean_text(F.get("cells", F.lit(1))).alias("value"),
    )


def definition_lists(found: DataFrame) -> DataFrame:
    """Terms and definitions of ``dl`` lists, paired in order: (page_id, section, pos, term, definition).

    ``found``: elements with at least section, dl, dt and dd.
    """
    sections = found.filter("tag = 'section'").select(
        "page_id", F.col("seq").alias("_sec"), F.col("attrs")["id"].alias("section")
    )
    lists = found.filter("tag = 'dl'").select("page_id", F.col("seq").alias("_list"), F.col("parent").alias("_sec"))
    lists = lists.join(sections, ["page_id", "_sec"], "left").drop("_sec")
    items = found.filter("tag in ('dt', 'dd')").select(
        "page_id", F.col("parent").alias("_list"), "seq", "tag", F.trim("text").alias("text")
    )
    # Items of one list of one page, in order; both sides of a pair have the same position.
    both = items.groupBy("page_id", "_list").agg(
        F.sort_array(F.collect_list(F.when(F.col("tag") == "dt", F.struct("seq", "text")))).alias("terms"),
        F.sort_array(F.collect_list(F.when(F.col("tag") == "dd", F.struct("seq", "text")))).alias("defs"),
    )
    pairs = both.select("page_id", "_list", F.posexplode(F.arrays_zip("terms", "defs")).alias("pos", "_p"))
    pairs = pairs.select(
        "page_id", "_list", "pos", F.col("_p.terms.text").alias("term"), F.col("_p.defs.text").alias("definition")
    ).filter("term is not null and definition is not null")
    return pairs.join(lists, ["page_id", "_list"]).drop("_list")


def first_rule(term: Column, rules: dict[str, Sequence[str]]) -> Column:
    """Name of the first rule with words in a term."""
    lower = F.lower(term)
    which = None
    for name, words in rules.items():
        for word in words:
            hit = F.contains(lower, F.lit(word))
            which = F.when(hit, name) if which is None else which.when(hit, name)
    return which


def labelled_columns(pairs: DataFrame, keys: Sequence[str], rules: dict[str, Sequence[str]], term: str, value: str, order: str) -> DataFrame:
    """One row per key with a column per rule: the last value whose term holds the words of the rule.

    Rules are tried in order and a term goes to the first rule that fits.
    """
    rows = pairs.withColumn("_rule", first_rule(F.col(term), rules)).filter("_rule is not null")
    return rows.groupBy(*keys).agg(
        *[F.max_by(value, F.when(F.col("_rule") == name, F.col(order))).alias(name) for name in rules]
    )


# Word in the class of a rubric list, and the kind it stands for.
RUBRIC_KINDS = {
    "Rubric-inclusion": "inclusions",
    "Rubric-exclusion": "exclusions",
    "Rubric-note": "notes",
    "Rubric-coding-hint": "notes",
}


def rubric_elements(pages: DataFrame, *more: str) -> DataFrame:
    """Elements that ``rubrics`` looks at, and those of ``more`` tags out of the same parse; lists alone count as what is around an item."""
    return parsed(pages, ["dl", "dd", *more], columns=["seq", "parent", "tag", "attrs", "spaced"], around=["dl", "dd"])


def rubrics(found: DataFrame) -> DataFrame:
    """Inclusion, exclusion and note texts per page, out of ``rubric_elements``: (page_id, kind, pos, text)."""
    kind = None
    for word, name in RUBRIC_KINDS.items():
        hit = F.contains(F.coalesce(F.col("attrs")["class"], F.lit("")), F.lit(word))
        kind = F.when(hit, name) if kind is None else kind.when(hit, name)
    lists = found.filter("tag = 'dl'").select("page_id", F.col("seq").alias("parent"), kind.alias("kind"))
    items = found.filter("tag = 'dd'").join(lists.filter("kind is not null"), ["page_id", "parent"])
    return items.select("page_id", "kind", F.col("seq").alias("pos"), clean_text("spaced").alias("text"))


def rubric_lists(found: DataFrame) -> DataFrame:
    """One row per page and kind with its texts joined by ``;``, out of ``rubric_elements``."""
    return ordered_text(materialize(rubrics(found), "rubrics"), ["page_id", "kind"], F.col("text"), ";", [F.col("pos")], "texts")


def article_text(pages: DataFrame, skip: Sequence[str] = ("xref",), limit: int = GROUP_LIMIT) -> DataFrame:
    """Narrative text per page: (page_id, part, body).

    Paragraphs of the body without citations, normalised, empty ones dropped, joined by a blank
    line. A document without a body gives its non-blank lines, without reference lists.
    """
    has_body = F.col("html").rlike(r"(?i)<body[\s>]")
    parts = elements(pages.filter(has_body), ["p"], skip, columns=["seq", "text"])
    parts = parts.select("page_id", "seq", clean_text("text").alias("text"))
    whole = pages.filter(~has_body).select("page_id", F.concat(F.lit("<doc>"), "html", F.lit("</doc>")).alias("html"))
    lines = elements(whole, ["doc"], ["ref-list", "back"], columns=["text"])
    lines = lines.select("page_id", F.posexplode(F.split("text", r"\n")).alias("seq", "text"))
    lines = lines.select("page_id", "seq", F.trim("text").alias("text"))
    texts = materialize(parts.unionByName(lines).filter("text <> ''"), "paragraphs")
    return ordered_text(texts, ["page_id"], F.col("text"), "\n\n", [F.col("seq")], "body", limit)
