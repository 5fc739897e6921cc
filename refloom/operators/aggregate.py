"""Grouped text, lists, masters, statistics and trees."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.operators.skew import GROUP_LIMIT, hot_groups, join_keys, number_ranges, slice_hot
from refloom.session import materialize


@dataclass
class Child:
    """A child table attached to a parent: rows of ``rows`` per key, shown as ``value`` in ``order``; ``count`` names a column for their number."""

    name: str
    rows: DataFrame
    value: Column
    order: Sequence[str | Column] = field(default_factory=list)
    count: str | None = None


def ordered_text(
    df: DataFrame, keys: Sequence[str], value: Column, sep: str = "; ", order: Sequence[str | Column] = (),
    out: str = "text", limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Ordered string aggregation per key: (keys, part, text). NULL values are skipped; none left gives no row.

    Sorted by the text itself unless ``order`` is given. A key with more than ``limit`` values gets
    several rows, numbered by ``part``, whose texts follow each other.
    """
    ((found, _),) = _gather([Child(out, df, value, order)], keys, limit, sep)
    return found.filter(F.col(out).isNotNull())


def ordered_list(
    df: DataFrame, keys: Sequence[str], value: Column, order: Sequence[str | Column], out: str = "items",
    limit: int = GROUP_LIMIT,
) -> DataFrame:
    """Ordered array of values per key: (keys, part, items), at most ``limit`` values in an array."""
    ((found, _),) = _gather([Child(out, df, value, order)], keys, limit)
    return found.filter(F.col(out).isNotNull())


def _gather(
    children: Sequence[Child], keys: Sequence[str], limit: int, sep: str | None = None
) -> list[tuple[DataFrame, bool]]:
    """Arrays of child values per key and part, in order, NULL where a key has none; texts if ``sep`` is given. With each, whether all of it is part 0.

    Children that share one table are gathered in one grouping; where that table has keys of more than ``limit`` rows, each child
    is sliced on its own, by its own order. Values with the same position in every key's order make the same part either way.
    """
    out = []
    for rows, group in _by_table(children):
        hot = hot_groups(rows, keys, limit)
        if hot is None:
            out.append((_collect(rows, group, keys, None, limit, sep), True))
        else:
            out += [(_collect(rows, [c], keys, hot, limit, sep), False) for c in group]
    return out


def _by_table(children: Sequence[Child]) -> list[tuple[DataFrame, list[Child]]]:
    tables: dict[int, tuple[DataFrame, list[Child]]] = {}
    for c in children:
        tables.setdefault(id(c.rows), (c.rows, []))[1].append(c)
    return list(tables.values())


def _collect(
    rows: DataFrame, group: Sequence[Child], keys: Sequence[str], hot: DataFrame | None, limit: int, sep: str | None
) -> DataFrame:
    # A value that is its own order is gathered bare, any other one behind its order columns.
    items = {}
    for i, c in enumerate(group):
        by = [F.col(o) if isinstance(o, str) else o for o in c.order]
        entry = F.struct(*[o.alias(f"o{n}") for n, o in enumerate(by)], c.value.alias("v"))
        items[f"_e{i}"] = F.when(c.value.isNotNull(), entry) if by else c.value
    # Parts leave out rows without a value, so only whole groups tell the number of rows.
    counted = [c.count for c in group if c.count and hot is None]
    counts = [F.count(F.lit(1)).alias(n) for n in counted]
    # Rows that are gathered whole move as they are, once; values are made where their group is, and what joins the groups by key finds them in place.
    found = (rows.repartition(*keys) if keys and hot is None else rows).select(*keys, *[e.alias(n) for n, e in items.items()])
    lists = [F.sort_array(F.collect_list(n)).alias(n) for n in items]
    if hot is not None:
        # One child at a time here, in its own order.
        found = slice_hot(found.filter("_e0 is not null"), keys, ["_e0"], hot, limit=limit)
        grouped = found.groupBy(*keys, "part").agg(*lists)
    else:
        grouped = found.groupBy(*keys).agg(*lists, *counts).withColumn("part", F.lit(0).cast("long"))

    def finish(name: str, child: Child) -> Column:
        values = F.transform(name, lambda x: x["v"]) if child.order else F.col(name)
        return F.when(F.size(name) > 0, values if sep is None else F.array_join(values, sep)).alias(child.name)

    return grouped.select(*keys, "part", *[finish(n, c) for n, c in zip(items, group)], *counted)


def attach_parts(parent: DataFrame, keys: Sequence[str], lists: Sequence[DataFrame]) -> DataFrame:
    """Left join of pre-aggregated children to their parent; nothing fans out.

    Parent rows carry part 0. Only a parent with an oversized list gets further rows, one per part.
    """
    parts = reduce(DataFrame.unionByName, [x.filter("part > 0").select(*keys, "part") for x in lists]).distinct()
    base = parent.withColumn("part", F.lit(0).cast("long")).unionByName(join_keys(parent, parts, keys))
    return reduce(lambda acc, x: join_keys(acc, x, [*keys, "part"], "left"), lists, base)


def _attach(parent: DataFrame, keys: Sequence[str], lists: Sequence[tuple[DataFrame, bool]]) -> DataFrame:
    """``attach_parts`` of gathered children. Where none has parts, keys that are not NULL are joined where the groups are."""
    if not all(whole for _, whole in lists):
        return attach_parts(parent, keys, [x for x, _ in lists])
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    base = parent.withColumn("part", F.lit(0).cast("long"))
    children = [x.drop("part") for x, _ in lists]
    full = reduce(lambda acc, x: acc.join(x.filter(known), list(keys), "left"), children, base.filter(known))
    rest = reduce(lambda acc, x: join_keys(acc, x.filter(~known), keys, "left"), children, base.filter(~known))
    return full.unionByName(rest)


def text_master(
    parent: DataFrame, keys: Sequence[str], children: Sequence[Child], sep: str = "; ", limit: int = GROUP_LIMIT
) -> DataFrame:
    """Parent with one ordered text column per child table, NULL without a child, and the counts that children name, 0 without one."""
    lists = _gather(children, keys, limit, sep)
    joined = _attach(parent, keys, lists)
    wanted = [c for c in children if c.count]
    if not {c.count for c in wanted} <= {n for x, _ in lists for n in x.columns}:
        # Some key is in parts, and every part of a parent tells the number of all its rows.
        for c in wanted:
            totals = c.rows.groupBy(*keys).agg(F.count(F.lit(1)).alias(c.count))
            joined = join_keys(joined.drop(c.count), totals, keys, "left")
    counts = [F.coalesce(c.count, F.lit(0).cast("long")).alias(c.count) for c in children if c.count]
    return joined.select(*parent.columns, "part", *[c.name for c in children], *counts)


def nested_master(
    parent: DataFrame, keys: Sequence[str], children: Sequence[Child], limit: int = GROUP_LIMIT
) -> DataFrame:
    """Parent with one array of child structs per child table; no child gives an empty array."""
    joined = _attach(parent, keys, _gather(children, keys, limit))
    return joined.select(
        *parent.columns, "part", *[F.coalesce(F.col(c.name), F.array()).alias(c.name) for c in children]
    )


def first_non_null(df: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per key and column, the first value in ``order`` that is neither NULL nor empty."""
    at = F.struct(*order)
    return df.groupBy(*keys).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != ""), at)).alias(c) for c in cols]
    )


def union_lists(
    df: DataFrame, keys: Sequence[str], packed: str, sep: str = ",", out: str | None = None, limit: int = GROUP_LIMIT
) -> DataFrame:
    """Union of packed lists per key: distinct, sorted, packed again. Duplicates go before the grouping."""
    items = df.select(*keys, F.explode(F.split(packed, f"\\Q{sep}\\E")).alias("_item"))
    items = items.select(*keys, F.trim("_item").alias("_item")).filter("_item <> ''").distinct()
    return ordered_text(items, keys, F.col("_item"), sep, out=out or packed, limit=limit)


def dataset_stats(
    df: DataFrame, keys: Sequence[str] = (), distinct: Sequence[str] = (), sums: Sequence[str] = (),
    approximate: bool = False,
) -> DataFrame:
    """Row count, distinct counts and sums. Distinct counts are exact unless ``approximate``."""
    count = F.approx_count_distinct if approximate else F.countDistinct
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    aggs += [count(c).alias(f"n_{c}") for c in distinct] + [F.sum(c).alias(f"sum_{c}") for c in sums]
    return df.groupBy(*keys).agg(*aggs)


def partition_stats(df: DataFrame, part: str, distinct: Sequence[str] = (), sums: Sequence[str] = (), lg_k: int = 14) -> DataFrame:
    """Statistics per partition that merge: row count, sums, and a distinct-count sketch of each column in ``distinct``.

    Sketches of 2^``lg_k`` registers, with a standard error of about 1.04 / 2^(lg_k / 2). Kept as a table, a partition is counted once and never read again.
    """
    # Text of the value: a sketch takes texts and whole numbers, and both sides of a merge must agree.
    aggs = [F.count(F.lit(1)).alias("n_rows"), *[F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"sketch_{c}") for c in distinct]]
    return df.groupBy(part).agg(*aggs, *[F.sum(c).alias(f"sum_{c}") for c in sums])


def merge_stats(stats: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The statistics of any union of partitions, from their rows of ``partition_stats``; distinct counts are estimates."""
    aggs = [F.sum("n_rows").alias("n_rows")]
    for c in stats.columns:
        if c.startswith("sketch_"):
            aggs.append(F.hll_sketch_estimate(F.hll_union_agg(c)).alias(f"n_{c.removeprefix('sketch_')}"))
        elif c.startswith("sum_"):
            aggs.append(F.sum(c).alias(c))
    return stats.groupBy(*keys).agg(*aggs)


def add_partitions(df: DataFrame, path: str, part: str, distinct: Sequence[str] = (), sums: Sequence[str] = (), lg_k: int = 14) -> DataFrame:
    """Statistics of all partitions known so far, after adding those of ``df``; a partition that comes again replaces its row.

    Only ``df`` is read. Each partition's row lies in a folder of its own, which a later load of the same partition overwrites.
    """
    stats = partition_stats(df, part, distinct, sums, lg_k)
    writer = stats.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(part).parquet(path)
    return df.sparkSession.read.parquet(path)


def status_counts(df: DataFrame, status: str) -> DataFrame:
    return df.groupBy(status).agg(F.count(F.lit(1)).alias("n"))


def longest_wins(df: DataFrame, keys: Sequence[str], text: str, name: str, order: str) -> DataFrame:
    """Per key the longest text (first seen on equal length) and the first non-empty name."""
    size = F.struct(F.coalesce(F.length(text), F.lit(0)), -F.col(order))
    return df.groupBy(*keys).agg(
        F.min_by(name, F.when(F.coalesce(F.col(name), F.lit("")) != "", F.col(order))).alias(name),
        F.max_by(text, size).alias(text),
    )


def map_columns(df: DataFrame, record: str, first: Sequence[str] = ()) -> list[str]:
    """All keys of a map column: the pinned ones first, the rest sorted. They become the columns of one schema."""
    found = [r.k for r in df.select(F.explode(F.map_keys(record)).alias("k")).distinct().collect()]
    return [c for c in first if c in found] + sorted(set(found) - set(first))


def union_columns(df: DataFrame, record: str, keep: Sequence[str], first: Sequence[str] = ()) -> DataFrame:
    """Map rows to a flat table with one column per key seen in any record."""
    return df.select(
        *keep, *[F.try_element_at(record, F.lit(c)).alias(c) for c in map_columns(df, record, first)]
    )


def distinct_ids(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def build_tree(
    levels: Sequence[DataFrame], code: str = "code", parent: str = "parent_code", limit: int = GROUP_LIMIT
) -> DataFrame:
    """Nest levels of nodes into their parents, bottom up. Each level has ``code`` and ``parent_code``.

    Returns root nodes with a JSON ``children`` text; a node whose parent is missing becomes a root.
    Children are ordered by code. A node with more than ``limit`` children appears once per part.
    """
    roots: list[DataFrame] = []
    below: DataFrame | None = None
    for level in reversed(levels):
        nodes = level.withColumn("part", F.lit(0).cast("long")).withColumn("children", F.lit(None).cast("string"))
        if below is not None:
            nodes = _adopt(level, below, code, parent, limit)
            orphans = join_keys(below, level.select(F.col(code).alias(parent)), [parent], "left_anti")
            roots.append(orphans)
        # Written once per level: the next level reads it for its children and for its orphans.
        below = materialize(nodes, "level")
    roots.append(below)
    shaped = [r.select(code, "part", _node(r, parent).alias("node")) for r in roots]
    return reduce(DataFrame.unionByName, shaped)


def tree_lines(
    levels: Sequence[DataFrame], code: str = "code", parent: str = "parent_code"
) -> DataFrame:
    """The same trees as text in pieces, a row per node: (root, pos, text). In order of ``pos`` the pieces of a root are its JSON text.

    Nodes are numbered in pre-order, along sorted ranges of the codes on their way from the root; what a node opens and closes follows from its own depth and the
    next node's. No subtree is ever one value, so a root may be of any size. Codes are unique within a level.
    """
    placed: list[DataFrame] = []
    for k, level in enumerate(levels):
        own = F.to_json(F.struct(*[c for c in level.columns if c != parent]))
        nodes = level.select(F.col(code).alias("_code"), F.col(parent).alias("_parent"), own.alias("_own"))
        path = F.array("_code")
        if placed:
            above = placed[-1].select(F.col("_code").alias("_parent"), F.col("_path").alias("_above"))
            nodes = nodes.join(above, "_parent", "left")
            path = F.concat(F.coalesce("_above", F.array().cast("array<string>")), path)
        nodes = nodes.select("_code", path.alias("_path"), "_own", F.lit(k == len(levels) - 1).alias("_leaf"))
        placed.append(materialize(nodes, "level"))
    nodes = reduce(DataFrame.unionByName, placed).select(F.col("_path")[0].alias("root"), "_path", "_own", "_leaf")
    nodes = materialize(number_ranges(nodes, ["_path"], ["root"], "pos"), "preorder").withColumn("_depth", F.size("_path"))
    after = nodes.select("root", (F.col("pos") - 1).alias("pos"), F.col("_depth").alias("_next"))
    rows = nodes.join(after, ["root", "pos"], "left")
    depth, following = F.col("_depth"), F.coalesce("_next", F.lit(1))
    begun = F.concat(F.left("_own", F.length("_own") - 1), F.lit(',"children":['))
    closing = F.concat(F.repeat(F.lit("]}"), depth - following), F.when(F.col("_next").isNotNull(), ",").otherwise(""))
    text = F.when(following > depth, begun).otherwise(F.concat(F.when(F.col("_leaf"), F.col("_own")).otherwise(F.concat(begun, F.lit("]}"))), closing))
    return rows.select("root", "pos", text.alias("text"))


def write_tree(lines: DataFrame, path: str) -> None:
    """The pieces of ``tree_lines`` as text files, one line each: read in the order of their names, the files are the trees one after the other."""
    lines.repartitionByRange("root", "pos").sortWithinPartitions("root", "pos").select("text").write.text(path)


def _node(df: DataFrame, parent: str) -> Column:
    own = F.to_json(F.struct(*[c for c in df.columns if c not in (parent, "part", "children")]))
    nested = F.concat(F.left(own, F.length(own) - 1), F.lit(',"children":'), F.col("children"), F.lit("}"))
    return F.coalesce(nested, own)


def _adopt(level: DataFrame, below: DataFrame, code: str, parent: str, limit: int) -> DataFrame:
    """Nodes of one level with the JSON array of their children; leaves have none."""
    texts = ordered_list(below, [parent], _node(below, parent), [code, "part"], "_kids", limit)
    joined = attach_parts(level, [code], [texts.withColumnRenamed(parent, code)])
    kids = F.coalesce(F.array_join("_kids", ","), F.lit(""))
    return joined.withColumn("children", F.concat(F.lit("["), kids, F.lit("]"))).drop("_kids")
