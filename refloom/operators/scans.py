"""Running values along ordered lines.

Lines carry ``keys`` (the file or text), ``block`` (a slice of bounded size, such as a file split)
and an order inside the block. A file of ordinary size is one window. For larger ones, windows run
per block and one summary row per block carries the state across blocks, so that no window ever
holds a whole large file.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refloom.operators.skew import hot_groups, join_keys, split_hot
from refloom.session import materialize

LINE_LIMIT = 1_000_000


def by_size(df: DataFrame, keys: Sequence[str], job: Callable[[DataFrame, bool], DataFrame], limit: int = LINE_LIMIT) -> DataFrame:
    """Run a job on the ordinary keys as they are and on the oversized ones block by block.

    ``job`` gets the rows and whether they are to be scanned in blocks.
    """
    hot = hot_groups(df, keys, limit)
    if hot is None:
        return job(df, False)
    cold, warm = split_hot(df, keys, hot)
    return job(cold, False).unionByName(job(materialize(warm, "lines"), True))


def scan(
    df: DataFrame,
    keys: Sequence[str],
    block: str,
    order: Sequence[str],
    sums: dict[str, Column] | None = None,
    lasts: dict[str, Column] | None = None,
    before: dict[str, Column] | None = None,
    blocks: bool = True,
) -> DataFrame:
    """Add running values per key: ``sums`` so far, ``lasts`` non-NULL so far, ``before`` = last non-NULL strictly earlier.

    ``blocks`` scans in two levels; the result is written once, because it is read for the lines
    and for the summaries.
    """
    sums, lasts, before = sums or {}, lasts or {}, before or {}
    values = {f"_v_{n}": e for n, e in {**sums, **lasts, **before}.items()}
    here = Window.partitionBy(*keys, block).orderBy(*order) if blocks else Window.partitionBy(*keys).orderBy(block, *order)
    upto, prior = here.rowsBetween(Window.unboundedPreceding, 0), here.rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns(values).withColumns(
        {f"_l_{n}": F.sum(f"_v_{n}").over(upto) for n in sums}
        | {f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(upto) for n in lasts}
        | {f"_l_{n}": F.last(f"_v_{n}", ignorenulls=True).over(prior) for n in before}
    )
    if not blocks:
        return local.select(*df.columns, *[F.col(f"_l_{n}").alias(n) for n in {**sums, **lasts, **before}])
    local = materialize(local, "scan")
    at = F.struct(*order)
    totals = local.groupBy(*keys, block).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums],
        *[
            F.max_by(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), at)).alias(f"_t_{n}")
            for n in {**lasts, **before}
        ],
    )
    earlier = Window.partitionBy(*keys).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        *keys,
        block,
        *[F.coalesce(F.sum(f"_t_{n}").over(earlier), F.lit(0)).alias(f"_c_{n}") for n in sums],
        *[F.last(f"_t_{n}", ignorenulls=True).over(earlier).alias(f"_c_{n}") for n in {**lasts, **before}],
    )
    return join_keys(local, carried, [*keys, block]).select(
        *df.columns,
        *[(F.col(f"_l_{n}") + F.col(f"_c_{n}")).alias(n) for n in sums],
        *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in {**lasts, **before}],
    )
