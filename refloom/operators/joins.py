"""Reference joins. The join algorithm is left to Spark and its runtime statistics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.functions.codes import dotted_parent
from refloom.functions.text import safe_text, strip_zeros
from refloom.operators.aggregate import Child, nested_master, text_master
from refloom.operators.dedup import dedup_first
from refloom.operators.select import INVALID_NAMES, contains_any
from refloom.operators.skew import GROUP_LIMIT


def left_attach(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Left equi join, one row per match, unmatched left rows kept."""
    return left.join(right, list(on), "left")


def chain(*steps: DataFrame | Sequence[str]) -> DataFrame:
    """Inner joins in a row: ``chain(a, ["k"], b, ["j"], c)``."""
    joined = steps[0]
    for keys, table in zip(steps[1::2], steps[2::2]):
        joined = joined.join(table, list(keys), "inner")
    return joined


def pending(rows: DataFrame, done: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in the finished set. That set is made distinct first: a key may be in it very often."""
    return rows.join(done.select(*keys).distinct(), list(keys), "left_anti")


def enrich_codes(
    df: DataFrame, codes: DataFrame, on: Sequence[str], text: str, default: str = ""
) -> DataFrame:
    """Add the text of a code. Whether the code map is broadcast is left to its size at run time."""
    return df.join(codes, list(on), "left").withColumn(text, F.coalesce(F.col(text), F.lit(default)))


def cogroup_details(
    parent: DataFrame, keys: Sequence[str], children: Sequence[tuple[str, DataFrame, Column]],
    sep: str = " | ", limit: int = GROUP_LIMIT, order: Sequence[str | Column] = (),
) -> DataFrame:
    """Parent with ``<name>_count`` and ``<name>_list`` per child table; children are grouped first, once for both.

    Lists are sorted by their texts, or by ``order``, columns of every child table (such as the place of a row in its file).
    """
    kids = [Child(f"{name}_list", rows, detail, order, f"{name}_count") for name, rows, detail in children]
    joined = text_master(parent, keys, kids, sep, limit)
    return joined.withColumns({f"{n}_list": F.coalesce(f"{n}_list", F.lit("")) for n, _, _ in children})


def resolve_reference(
    products: DataFrame, patents: DataFrame, order: Sequence[str], limit: int = GROUP_LIMIT,
    listed: Sequence[str] = ("patent_number", "expires"),
) -> DataFrame:
    """Link products to the patents of their reference product.

    ``products``: number, name, licence, reference_name; ``patents``: number, patent_number, expires.
    A product under an original licence is its own reference; any other one refers by brand name to
    the last original product of that name. Adds resolved number, patent count and packed lists, in the order of the columns ``listed``.
    """
    original = F.contains(safe_text("licence"), F.lit("351(a)"))
    plain = F.lower(F.trim("name"))
    brands = products.filter(original & (strip_zeros("number") != "") & ~plain.isin(*INVALID_NAMES))
    brands = brands.groupBy(plain.alias("_ref")).agg(
        F.max_by(strip_zeros("number"), F.struct(*order)).alias("_ref_number")
    )
    wanted = F.lower(F.trim(F.coalesce("reference_name", F.lit(""))))
    rows = products.withColumn("_ref", F.when(~wanted.isin(*INVALID_NAMES), wanted)).join(brands, "_ref", "left")
    rows = rows.withColumn("_lookup", F.when(original, strip_zeros("number")).otherwise(F.col("_ref_number")))
    known = ["patent_number", "expires", *[c for c in listed if c not in ("patent_number", "expires")]]
    grouped = patents.select(strip_zeros("number").alias("_lookup"), *known).filter("_lookup <> ''")
    details = [
        Child("patent_numbers", grouped, safe_text("patent_number"), listed, "associated_patents_count"),
        Child("patent_expirations", grouped, safe_text("expires"), listed),
    ]
    joined = text_master(rows, ["_lookup"], details, "; ", limit)
    return joined.select(
        *products.columns,
        "part",
        F.coalesce("_ref_number", F.lit("N/A")).alias("resolved_reference_number"),
        "associated_patents_count",
        F.coalesce("patent_numbers", F.lit("")).alias("patent_numbers"),
        F.coalesce("patent_expirations", F.lit("")).alias("patent_expirations"),
    )


def merge_lists(lists: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Master index of several lists: a later list overwrites an earlier one by key."""
    tagged = reduce(DataFrame.unionByName, [df.withColumn("_rank", F.lit(i)) for i, df in enumerate(lists)])
    return dedup_first(tagged, keys, [F.col("_rank").desc(), *order]).drop("_rank")


def search_joined(
    parent: DataFrame, child: DataFrame, key: str, term: str, parent_cols: Sequence[str], child_cols: Sequence[str]
) -> DataFrame:
    """Parents that match themselves or through a child row. Keys are matched first, then semi-joined."""
    own = parent.filter(contains_any(term, parent_cols)).select(key)
    via = child.filter(contains_any(term, child_cols)).select(key)
    return parent.join(own.union(via).distinct(), key, "left_semi")


def leaf_flag(codes: DataFrame, code: str = "code") -> DataFrame:
    """Add ``parent_code`` of a dotted code and ``is_leaf``: no other code has it as parent."""
    rows = codes.withColumn("parent_code", dotted_parent(code))
    parents = rows.select(F.col("parent_code").alias(code)).filter(F.col(code).isNotNull()).distinct()
    flagged = rows.join(parents.withColumn("_inner", F.lit(True)), code, "left")
    return flagged.withColumn("is_leaf", F.col("_inner").isNull()).drop("_inner")


def case_bundle(
    reports: DataFrame, children: dict[str, DataFrame], key: str, matches: Sequence[DataFrame],
    order: Sequence[str], k: int = 5, limit: int = GROUP_LIMIT,
) -> DataFrame:
    """The first ``k`` cases that match anywhere, each with all its child rows as JSON lists.

    The limit is the feature (a result page); ids are cut by ``order`` on the key, children are whole.
    """
    ids = reduce(DataFrame.union, [m.select(key) for m in matches]).distinct()
    top = ids.orderBy(key).limit(k)
    cases = reports.join(top, key, "left_semi")
    kids = [
        Child(name, rows.join(top, key, "left_semi"), F.struct(*[c for c in rows.columns if c != key]), order)
        for name, rows in children.items()
    ]
    return nested_master(cases, [key], kids, limit).withColumns({n: F.to_json(n) for n in children})
