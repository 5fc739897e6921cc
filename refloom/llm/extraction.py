"""Main text of web pages: streaming parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's parser turns a page into lines (one per block of text) with their tag counts and the containers around them.
Lines inside furniture (menus, headers, footers, sidebars, notices, adverts, forms, comments, by element, role or class name) never
count, nor do those of names that sections of an article may have too (discussion, related, legal), except where such an element stands in the
content and its ratio and links are those of text. The text-to-tag ratios of the rest are smoothed along the page, and the lines above the threshold form clusters, with
the headings before them. Each cluster selects the smallest container that holds most of its text, its lines outside it select theirs, and
every line of the selected containers that is not furniture is returned, short ones too. Mark-up helps in one way: a container inside an
article element stands for the whole element. An article element without clustered text is not returned.

Defined results: NULL and empty pages, and pages of furniture only, give the empty text. Broken mark-up never stops the parser: an end tag
without its start is ignored, an open element ends with its parent. Repeated rows are kept. Extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(
    "script style head title noscript template iframe object svg math canvas audio video select option datalist textarea "
    "button form fieldset dialog nav footer aside menu".split()
)
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header hgroup hr html li main "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article body center div html main section table tbody td tr ul ol dl blockquote header figure details".split())
#: Containers that are parts of a page, and those that are the page.
PARTS = frozenset("article main section div center td details".split())
ROOTS = frozenset(("html", "body"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: An open paragraph or item ends where one of these begins.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th")}
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar status".split())
FURNITURE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adslot advertorial banner billboard sponsor sponsored sponsors promo promos "
    "promoted promotion promotional nav navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs header masthead topbar toolbar footer "
    "sidebar sidebars aside rail widget widgets cookie cookies consent gdpr notice notices notification notifications alert alerts "
    "disclaimer popup modal overlay paywall newsletter subscribe subscription signup login signin share sharing social socials "
    "follow comment comments commentlist disqus respond reply replies discussion feedback related recommended recommendations "
    "trending popular pagination pager copyright legal search form skip outbrain taboola teaser teasers toc".split()
)
#: Words of FURNITURE that also name sections of an article.
DOUBTFUL = frozenset(
    "discussion related legal search alert alerts notice notices comment reply replies respond feedback follow form copyright disclaimer "
    "promotion popular trending notification notifications subscription consent social sharing recommendations toc".split()
)
#: Words of FURNITURE that name a place or a form of page parts, not what these say; inside an article they are no more than a doubt.
LAYOUT = frozenset(
    "banner nav navbar navigation menu menus submenu breadcrumb breadcrumbs crumbs header masthead topbar toolbar footer sidebar sidebars aside "
    "rail widget widgets overlay skip pager".split()
)
CONTENT = frozenset("article articles body content contents entry main post story text copy page".split())
#: Words that add nothing to a furniture name.
GENERIC = frozenset("box block area bar button buttons container wrapper wrap inner outer slot unit item items list link links section site top bottom left right main js css".split())
NEUTRAL = frozenset("has have with no without is not js".split())

SIGMA = 1.0
#: A line counts as content where its smoothed ratio exceeds this share of the ratios' standard deviation.
THRESHOLD = 0.5
#: Share of a cluster's text that its container holds.
SHARE = 0.8
#: A part at the page's start or end counts from this share of the threshold on, by its own text and tags.
PART = 0.25

_TOKEN = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")


def is_furniture(name: str) -> bool:
    """Whether a class or id names a part around the article: its last known word decides."""
    tokens = [t.lower() for t in _TOKEN.findall(name)]
    if not NEUTRAL.isdisjoint(tokens):
        return False
    for t in reversed(tokens):
        if t in FURNITURE:
            return True
        if t in CONTENT:
            return False
    return False


def is_doubtful(name: str, in_article: bool) -> bool:
    """Whether a furniture name may be that of an article's section: by its words, or inside an article because it names a place, or something else too."""
    tokens = [t.lower() for t in _TOKEN.findall(name)]
    known = [t for t in tokens if t in FURNITURE]
    if DOUBTFUL.issuperset(known):
        return True
    return in_article and (LAYOUT.union(DOUBTFUL).issuperset(known) or not FURNITURE.union(CONTENT, GENERIC).issuperset(tokens))


def names_of(tag: str, attrs: list[tuple[str, str | None]]) -> list[str]:
    """Furniture names of an element; the ids of headings and paragraphs are slugs of their text and do not count."""
    if tag in ("html", "body", "main", "h1"):
        return []
    keys = ("class",) if tag in HEADINGS or tag == "p" else ("class", "id")
    return [name for key, value in attrs if key in keys for name in (value or "").split() if is_furniture(name)]


def is_hidden(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    if tag in UNSEEN or tag == "header" and not in_article:
        return True
    if tag in ("html", "body", "main", "h1"):
        return False
    for key, value in attrs:
        value = value or ""
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key == "style" and "display:none" in value.lower().replace(" ", ""):
            return True
    return not all(is_doubtful(name, in_article) for name in names_of(tag, attrs))


class Lines(HTMLParser):
    """Parser events to lines: ``(text, tags, containers, heading)``, the containers from the outermost to the innermost.

    ``doubts`` has each line's outermost element with a doubtful name, by number, or -1, and its characters in links.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, tuple[int, ...], bool]] = []
        self.names: list[str] = []  # of containers, by number
        self.open: list[tuple[str, int, bool, bool]] = []  # tag, container number or -1, hidden, doubtful
        self.doubts: list[tuple[int, int]] = []
        self.doubtful = self.doubt_number = self.linked = 0
        self.link = False
        self.path: tuple[int, ...] = ()
        self.hidden = 0
        self.text: list[str] = []
        self.tags = 0

    def flush(self) -> None:
        if self.text:
            line = " ".join("".join(self.text).split())
            if line:
                self.lines.append((line, self.tags, self.path, bool(self.open) and self.open[-1][0] in HEADINGS))
                self.doubts.append((self.doubt_number if self.doubtful else -1, self.linked))
                self.tags = 0
            self.text = []
            self.linked = 0

    def pop(self) -> None:
        _, number, hidden, doubtful = self.open.pop()
        self.hidden -= hidden
        self.doubtful -= doubtful
        if number >= 0:
            self.path = self.path[:-1]

    def close_open(self, tags: tuple[str, ...]) -> None:
        """End an open element of these tags, unless a container stands between."""
        for k in range(len(self.open) - 1, -1, -1):
            tag = self.open[k][0]
            if tag in tags:
                while len(self.open) > k:
                    self.pop()
                return
            if tag in CONTAINERS or tag in UNSEEN:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS or tag in UNSEEN:
            self.flush()
            self.close_open(("p",))
            if tag in CLOSES:
                self.close_open(CLOSES[tag])
        if not self.hidden:
            self.tags += 1
        if tag in VOID:
            return
        hidden = is_hidden(tag, attrs, any(self.names[n] in ("article", "main") for n in self.path))
        # Inline elements only matter where they hide something.
        doubtful = not hidden and bool(names_of(tag, attrs))
        if tag == "a":
            self.link = True
        if hidden or doubtful or tag in BLOCKS:
            if hidden or doubtful:
                self.flush()
            self.doubt_number += doubtful and not self.doubtful
            number = -1
            if tag in CONTAINERS and not self.hidden and not hidden:
                number = len(self.names)
                self.names.append(tag)
                self.path += (number,)
            self.open.append((tag, number, hidden, doubtful))
            self.hidden += hidden
            self.doubtful += doubtful

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID:
            self.handle_starttag(tag, attrs)
        else:  # the slash means nothing in HTML
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCKS or tag in UNSEEN:
            self.flush()
        if tag == "a":
            self.link = False
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.flush()
                while len(self.open) > k:
                    self.pop()
                return
            if tag not in CONTAINERS and tag not in UNSEEN and self.open[k][0] in CONTAINERS:
                return

    def handle_data(self, data: str) -> None:
        if not self.hidden:
            self.text.append(data)
            self.linked += self.link * len(data)


def page_lines(html: str) -> Lines:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser


def smooth(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the lines, with weights that sum to one at the ends as well."""
    radius = max(1, math.ceil(2 * sigma))
    weights = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    total = np.convolve(np.ones(len(ratios)), weights)[radius:-radius]
    return np.convolve(ratios, weights)[radius:-radius] / total


def runs(chosen: np.ndarray) -> list[list[int]]:
    """Clusters: runs of neighbouring lines above the threshold."""
    at = np.flatnonzero(chosen)
    return [r.tolist() for r in np.split(at, np.flatnonzero(np.diff(at) > 1) + 1)]


def regions(chosen: np.ndarray, paths: list[tuple[int, ...]], names: list[str], size: np.ndarray) -> list[list[int]]:
    """Lines of each container that the clusters select; every line of a cluster is in one of them.

    The innermost container with ``SHARE`` of a cluster's text is taken whole, and the cluster's other lines select theirs in the same way.
    A page's body, and what has several article elements, is taken whole only if enough clustered text stands in it directly, and else part by part.
    """
    first, last = {-1: 0}, {-1: len(paths)}
    for k, p in enumerate(paths):
        for n in p:
            first.setdefault(n, k)
            last[n] = k + 1

    def below(k: int, depth: int) -> int:
        return next((n for n in paths[k][depth:] if names[n] in PARTS or names[n] in ROOTS), -1)

    found, taken, shares, todo = [], set(), {}, runs(chosen)
    total = size[chosen].sum()
    while todo:
        run = todo.pop()
        mass: dict[int, float] = {}
        for k in run:
            for n in paths[k]:
                mass[n] = mass.get(n, 0.0) + size[k]
        least = SHARE * size[run].sum()
        holder = max((n for n in mass if mass[n] >= least), default=-1)
        path = next((paths[k][: paths[k].index(holder) + 1] for k in run if holder in paths[k]), ())
        # Lists, tables and quotes are a piece of the part around them, and sections a piece of their article.
        part = max((i for i, n in enumerate(path) if names[n] in PARTS or names[n] in ROOTS), default=-1)
        article = max((i for i, n in enumerate(path) if names[n] == "article"), default=-1)
        if article >= 0:
            path = path[: article + 1]
        elif part >= 0 and names[path[part]] in PARTS:
            path = path[: part + 1]
        depth = len(path)
        whole = article >= 0 or depth and names[path[-1]] not in ROOTS and not any(names[n] == "article" for k in run for n in paths[k][depth:])
        top = path[-1] if path else -1
        low, high = first[top], last[top]
        if not whole:
            if top not in shares:
                shares[top] = sum(size[k] for k in range(low, high) if chosen[k] and below(k, depth) < 0)
            whole = shares[top] >= (1 - SHARE) * total
        within = [k for k in run if low <= k < high]
        if not whole:
            groups: dict[int, list[int]] = {}
            for k in within:
                groups.setdefault(below(k, depth), []).append(k)
            if -1 in groups:
                found.append(groups.pop(-1))
            todo += groups.values()
        elif top not in taken:
            taken.add(top)
            found.append(list(range(low, high)))
        if len(within) < len(run):
            todo.append([k for k in run if not low <= k < high])
    return found


def content(html: str | None) -> str:
    """Text of the content regions, one line per block."""
    if not html:
        return ""
    parser = page_lines(html)
    lines, names = parser.lines, parser.names
    doubts, linked = np.array(parser.doubts, int).reshape(-1, 2).T
    sure = doubts < 0
    if not sure.any():
        return ""
    size = np.array([len(t) for t, _, _, _ in lines], float)
    tags = np.array([n for _, n, _, _ in lines])
    ratios = size / np.maximum(1, tags)
    smoothed = smooth(ratios[sure])
    threshold = THRESHOLD * smoothed.std()
    chosen = sure.copy()
    if (smoothed >= threshold).any():
        chosen[sure] = smoothed >= threshold
    # Elements with a doubtful name select no region; inside one, those with low ratios or mostly links are furniture. Headings have low ratios anyway.
    heading = np.array([h for _, _, _, h in lines])
    left_out = {
        d for d in set(doubts[~sure].tolist())
        if not heading[doubts == d].all() and size[doubts == d].sum() < threshold * max(1, tags[doubts == d].sum())
        or linked[doubts == d].sum() * 2 >= size[doubts == d].sum()
    }
    # A heading goes with the text that follows it.
    for k in range(len(lines) - 2, -1, -1):
        if lines[k][3] and chosen[k + 1]:
            chosen[k] = True
    paths = [path for _, _, path, _ in lines]
    parts = regions(chosen, paths, names, size)
    # Smoothing lifts what stands next to long text: weak parts at the page's ends go, headings stay.
    level = PART * threshold
    weak = [size[p].sum() / max(1, tags[p].sum()) < level and not any(lines[k][3] for k in p) for p in parts]
    order = sorted(range(len(parts)), key=lambda k: parts[k][0])
    strong = [i for i, k in enumerate(order) if not weak[k]]
    if strong:
        order = order[strong[0] : strong[-1] + 1]
    kept = sorted({line for k in order for line in parts[k] if doubts[line] not in left_out})
    return "\n".join(lines[k][0] for k in kept)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every page."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            texts = [content(h if isinstance(h, str) else "") for h in pdf.pop("html").tolist()]
            yield pdf.assign(text=texts, n_chars=[len(t) for t in texts])

    rows = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
    )
    kind = dict(rows.dtypes)["page_id"]
    return rows.mapInPandas(run, f"page_id {kind}, url string, text string, n_chars long")
