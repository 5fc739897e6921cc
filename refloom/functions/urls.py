"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from refloom.functions.text import col


def url_language(c: Column | str) -> Column:
    """Two-letter language of a document URL: path segment before ``/documents/``, else ``_xx.pdf``, else ``unknown``."""
    by_path = F.regexp_extract(col(c), r"https?://[^/]+/([a-z]{2})/documents/", 1)
    by_name = F.regexp_extract(F.lower(col(c)), r"_([a-z]{2})\.pdf$", 1)
    return F.coalesce(F.nullif(by_path, F.lit("")), F.nullif(by_name, F.lit("")), F.lit("unknown"))


def url_kind(c: Column | str) -> Column:
    """Document kind: the segment after ``/documents/``, else ``other``."""
    return F.coalesce(F.nullif(F.regexp_extract(col(c), r"/documents/([^/]+)/", 1), F.lit("")), F.lit("other"))


def url_param(c: Column | str, name: str) -> Column:
    """Decoded value of a query parameter, NULL when absent."""
    raw = F.regexp_extract(col(c), rf"[?&]{name}=([^&#]*)", 1)
    return F.nullif(F.trim(F.try_url_decode(raw)), F.lit(""))


def replace_param(c: Column | str, name: str, value: int | str) -> Column:
    """The same URL with another value for one numeric query parameter."""
    return F.regexp_replace(col(c), rf"([?&]{name}=)\d+", f"$1{value}")


def resolve_url(base: Column | str, href: Column | str) -> Column:
    """Absolute form of a link found on a page.

    Covers absolute, protocol-relative, root-relative, query-only, fragment-only and plain relative
    references; ``.`` and ``..`` segments of the path are resolved in the last kind and in root-relative ones.
    """
    page, link = col(base), F.trim(col(href))
    scheme = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.\-]*:)", 1)
    origin = F.regexp_extract(page, r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1)
    bare = F.regexp_replace(page, r"#.*$", "")
    no_query = F.regexp_replace(page, r"[?#].*$", "")
    folder = F.when(no_query == origin, F.concat(origin, F.lit("/"))).otherwise(
        F.regexp_replace(no_query, r"[^/]*$", "")
    )
    inside = F.substring(folder, F.length(origin) + 1, F.length(folder))
    path, rest = F.regexp_extract(link, r"^[^?#]*", 0), F.regexp_extract(link, r"[?#].*$", 0)
    return (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), link)
        .when(link == "", bare)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(origin, plain_path(path), rest))
        .when(link.startswith("?"), F.concat(no_query, link))
        .when(link.startswith("#"), F.concat(bare, link))
        .otherwise(F.concat(origin, plain_path(F.regexp_replace(F.concat(inside, path), "/{2,}", "/")), rest))
    )


def plain_path(path: Column) -> Column:
    """A path (from its first ``/``) without ``.`` and ``..`` segments; one that ends with such a segment ends with ``/``."""
    steps = F.slice(F.split(path, "/"), F.lit(2), F.greatest(F.size(F.split(path, "/")) - 1, F.lit(1)))
    kept = F.aggregate(
        steps, F.array().cast("array<string>"),
        lambda acc, x: F.when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).when(x == ".", acc).otherwise(F.array_append(acc, x)),
    )
    kept = F.when(F.element_at(steps, -1).isin(".", ".."), F.array_append(kept, F.lit(""))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(kept, "/"))).otherwise(path)


def hash_id(c: Column | str, size: int = 8) -> Column:
    """Short stable id: first characters of the MD5 hex digest."""
    return F.substring(F.md5(col(c)), 1, size)


def file_name(c: Column | str) -> Column:
    """Last path segment of a URL."""
    return F.regexp_extract(F.regexp_replace(col(c), r"[?#].*$", ""), r"([^/]*)$", 1)
