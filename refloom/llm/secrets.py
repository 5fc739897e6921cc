"""Secret scans by corpus-wide ownership frequency.

Every text is scanned for credentials of known form (the base kinds) and for other long, mixed, random-looking strings. The
hashes of all of them are counted over the whole corpus, by distinct repositories and distinct owners; exact copies of a text are one repository of
one owner. A value is a copied example where different texts of several owners have it, or where very many repositories do, be it of one owner; else it
belongs to one owner and looks live, and where no base kind covers it, it is added as a span of kind ``live``. Base spans always stay.

Defined results: NULL and empty texts have no spans ('' and the hash of ''). A NULL owner or repository counts as one value.
Repeated rows are scanned each and counted once per repository. An empty table gives an empty result. Extra columns, whatever their names, are ignored by ``secrets``
and kept by ``redacted``.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import materialize

KINDS = ("assign", "access", "hex", "live")
#: The base patterns, and the least length of what they find.
_ASSIGN = re.compile(
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
LEAST_ASSIGN, LEAST_ACCESS = 8, 16
_WORDS = ("passw", "secret", "token", "api")
#: Other candidates: runs of this form with capitals, small letters and digits, and so many bits of entropy per character.
_OTHER = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
LEAST_BITS = 3.5
MASK = "[SECRET]"
#: A value that so many owners, or so many repositories, have is a copied example.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 2, 10

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """Spans of the base kinds with the secret value, by start and kind."""
    out = []
    low = text.lower()
    if any(w in low for w in _WORDS):
        out += [(m.start(), 0, m.end(), m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end(), m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end(), m[0]) for m in _HEX.finditer(text)]
    return sorted(out)


def entropy(value: str) -> float:
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values())


def other_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Random-looking strings that no base span touches."""
    out = []
    starts = [b[0] for b in base]
    ends = list(accumulate((b[2] for b in base), max))
    for m in _OTHER.finditer(text):
        v = m[0]
        if any(c.isdigit() for c in v) and not v.islower() and not v.isupper() and any(c.islower() for c in v):
            before = bisect_left(starts, m.end())
            if entropy(v) >= LEAST_BITS and not (before and ends[before - 1] > m.start()):
                out.append((m.start(), 3, m.end(), v))
    return out


_FOUND = "array<struct<start:int,kind:int,end:int,value:long>>"


def scan(docs: DataFrame, id_col: str, text_col: str, owner_col: str, repo_col: str) -> DataFrame:
    """One row per document, without its text: ``found`` has all candidates with the hash of their value. Written once."""
    names = ["doc_id", "text_key", "owner", "repo", "found"]

    def find(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            found = []
            for text in pdf.pop("text").tolist():
                spans = []
                if isinstance(text, str) and text:
                    spans = base_spans(text)
                    spans += other_spans(text, spans)
                found.append(
                    [{"start": a, "kind": k, "end": b, "value": xxhash.xxh3_64_intdigest(v) - (1 << 63)} for a, k, b, v in spans]
                )
            yield pdf.assign(found=found, doc_id=pdf["doc_id"].astype("Int64"))[names]

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(owner_col).cast("string").alias("owner"),
        F.col(repo_col).cast("string").alias("repo"), F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
    )
    found = rows.mapInPandas(find, f"doc_id long, text_key long, owner string, repo string, found {_FOUND}")
    return materialize(found.withColumn("row", F.monotonically_increasing_id()), "secrets")


def ownership(found: DataFrame) -> DataFrame:
    """Per value: in how many repositories and with how many owners it occurs. A text and its exact copies are in one repository, the least one."""
    blank = F.lit("")
    place = F.struct(F.coalesce("owner", blank).alias("owner"), F.coalesce("repo", blank).alias("repo"))
    seen = found.select("text_key", place.alias("place"), F.explode("found.value").alias("value"))
    texts = seen.groupBy("value", "text_key").agg(F.min("place").alias("place"))
    per_owner = texts.select("value", "place.*").distinct().groupBy("value", "owner").agg(F.count("*").alias("n"))
    return per_owner.groupBy("value").agg(F.count("*").alias("owners"), F.sum("n").alias("repos"))


def is_live(example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS) -> Column:
    """Whether a value with these ``owners`` and ``repos`` belongs to one owner."""
    return (F.col("owners") < example_owners) & (F.col("repos") < example_repos)


def _joined(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform(
        spans, lambda s: F.concat_ws(":", kinds[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(text, ",")


def secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS,
) -> DataFrame:
    """One row per document: counts and spans, the number of its values that one owner has, and of those that are examples."""
    found = scan(docs, id_col, text_col, owner_col, repo_col)
    spans = found.select("row", F.explode("found").alias("s")).select("row", "s.*")
    judged = spans.join(ownership(found), "value").select(
        "row", "start", "kind", "end", is_live(example_owners, example_repos).alias("live")
    )
    added = F.collect_list(F.when(F.col("live") & (F.col("kind") == 3), F.struct("start", "kind", "end")))
    per_row = judged.groupBy("row").agg(
        added.alias("added"), F.count_if("live").alias("n_live"), F.count_if(~F.col("live")).alias("n_example")
    )
    plain = F.transform("found", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    out = found.withColumn("base", F.filter(plain, lambda s: s["kind"] < 3)).join(per_row, "row", "left")
    every = F.array_sort(F.concat("base", F.coalesce("added", F.slice("base", 1, 0))))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    zero = F.lit(0).cast("long")
    return out.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(every).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_example", zero).alias("n_example"),
    )


def mask(text: str, spans: list[tuple[int, int]], sign: str = MASK) -> str:
    """``text`` with every stretch that the spans cover replaced by one sign."""
    out, at = [], 0
    for start, end in sorted(spans):
        if end <= at:
            continue
        if start >= at:
            out += [text[at:start], sign]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redacted(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
    example_owners: int = EXAMPLE_OWNERS, example_repos: int = EXAMPLE_REPOS, length_col: str = "n_chars",
) -> DataFrame:
    """The documents, all columns, with base spans and live values masked in the text; other texts stay as they are.

    A column ``length_col``, if there is one, follows the texts that change.
    """
    found = scan(docs, id_col, text_col, owner_col, repo_col)
    others = found.select("doc_id", "text_key", F.explode("found").alias("s")).select("doc_id", "text_key", "s.*").filter("kind = 3")
    live = others.join(ownership(found).filter(is_live(example_owners, example_repos)), "value", "left_semi")
    by_text = live.groupBy(F.col("text_key").alias("__text_key")).agg(
        F.collect_set(F.struct("start", "end")).alias("__live")
    )

    @F.pandas_udf("string")
    def masked(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for text, more in zip(texts.tolist(), spans.tolist(), strict=True):
            if isinstance(text, str) and text:
                places = [(a, b) for a, _, b, _ in base_spans(text)]
                if more is not None:
                    places += [(x["start"], x["end"]) for x in more]
                text = mask(text, places) if places else text
            out.append(text)
        return pd.Series(out, dtype=object)

    text = F.col(text_col).cast("string")
    joined = docs.withColumn("__text_key", F.xxhash64(text)).join(by_text, "__text_key", "left")
    out = joined.withColumn("__masked", masked(text, F.col("__live")))
    if length_col in docs.columns:
        length = F.length("__masked").cast(docs.schema[length_col].dataType)
        out = out.withColumn(length_col, F.when(F.col("__masked") != text, length).otherwise(F.col(length_col)))
    return out.withColumn(text_col, F.col("__masked")).select(*docs.columns)
