"""First-wins, last-wins and either-key deduplication."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from refloom.operators.skew import GROUP_LIMIT, hot_groups, join_keys, number_rows, split_hot
from refloom.session import materialize


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    The filter on ``row_number`` lets Spark keep one row per key and task before the shuffle
    (window group limit), so a hot key costs one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the last in ``order``."""
    return dedup_first(df, keys, [F.col(c).desc() if isinstance(c, str) else c for c in order])


def upsert(
    base: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[str], keep: Sequence[str] = ()
) -> DataFrame:
    """``base`` with rows of ``delta`` replacing or adding by key; later rows win.

    Columns in ``keep`` stay as the first row of the key had them. Plain aggregates, so rows are
    combined before the shuffle.
    """
    rows = base.withColumn("_side", F.lit(0)).unionByName(delta.withColumn("_side", F.lit(1)))
    at = F.struct("_side", *order)
    rest = [c for c in base.columns if c not in keys and c not in keep]
    picked = rows.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), at).alias("_new"),
        *([F.min_by(F.struct(*keep), at).alias("_old")] if keep else []),
    )
    source = {**{c: F.col(f"_new.{c}") for c in rest}, **{c: F.col(f"_old.{c}") for c in keep}}
    return picked.select(*[F.col(c) if c in keys else source[c].alias(c) for c in base.columns])


def suffix_duplicates(
    df: DataFrame, group: Sequence[str], key: str, value: str, order: Sequence[str], limit: int = GROUP_LIMIT
) -> DataFrame:
    """Give repeated keys of one record distinct names: ``key``, ``key (2)``, ``key (3)``.

    A later row with the value of the first row adds nothing; every other one gets the next number.
    """
    keys = [*group, key]
    at = F.struct(*order)
    first = df.groupBy(*keys).agg(F.min(at).alias("_at"), F.min_by(value, at).alias("_value"))
    rows = join_keys(df, first, keys)
    rows = rows.filter((at == F.col("_at")) | ~F.col(value).eqNullSafe(F.col("_value"))).drop("_at", "_value")
    rows = number_rows(rows, keys, order, "_n", limit)
    named = F.when(F.col("_n") == 1, F.col(key)).otherwise(
        F.concat(F.col(key), F.lit(" ("), F.col("_n").cast("string"), F.lit(")"))
    )
    return rows.withColumn(key, named).drop("_n")


def _present(name: str) -> Column:
    return F.col(name).isNotNull() & (F.col(name) != "")


#: Rows of a group that one task may walk through.
WALK = 10_000
_A, _B = "_a", "_b"


def _accept_in_order(group: Sequence[str]):
    """Ids of accepted rows, taken one after the other; a partition holds whole groups in order, and only one group's keys are kept."""

    def accept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen1, seen2, at = set(), set(), None
        for rows in batches:
            keep = []
            for i, a, b, *g in rows[["_id", _A, _B, *group]].itertuples(index=False, name=None):
                g = [None if x is None or x != x else x for x in g]
                if g != at:
                    seen1, seen2, at = set(), set(), g
                a, b = (None if x is None or x != x else x for x in (a, b))
                if (a is None or a not in seen1) and (b is None or b not in seen2):
                    seen1.update(() if a is None else (a,))
                    seen2.update(() if b is None else (b,))
                    keep.append(i)
            yield pd.DataFrame({"_id": keep})

    return accept


class _Greedy:
    """Open rows (group columns, _a, _b, _at, _id) are accepted or fall until none is left. ``_at`` is the order, unique by the id in it.

    A row waits for the earlier open rows that share a key with it. Every step decides rows for good, so steps can follow in any order.
    """

    def __init__(self, open_rows: DataFrame, group: Sequence[str]):
        self.open, self.group, self.accepted = open_rows, list(group), []

    def _ranked(self) -> DataFrame:
        """Open rows with the first ``_at`` of either key."""
        rows = self.open
        for name in (_A, _B):
            firsts = rows.filter(F.col(name).isNotNull()).groupBy(*self.group, name).agg(F.min("_at").alias(f"_first{name}"))
            rows = join_keys(rows, firsts, [*self.group, name], "left")
        return rows

    def _accept(self, won: DataFrame, rest: DataFrame) -> None:
        """Rows ``won`` are accepted; of the rest, all that share a key with one of them fall."""
        self.accepted.append(won.select("_id"))
        for name in (_A, _B):
            taken = won.filter(F.col(name).isNotNull()).select(*self.group, name).distinct()
            rest = join_keys(rest, taken, [*self.group, name], "left_anti")
        self.open = materialize(rest, "open")

    def first_rows(self) -> None:
        """Accept the rows that come first for both of their keys."""
        first = reduce(lambda x, y: x & y, [F.col(n).isNull() | (F.col("_at") == F.col(f"_first{n}")) for n in (_A, _B)])
        marked = materialize(self._ranked().select(*self.group, _A, _B, "_at", "_id", first.alias("_ok")), "round")
        self._accept(marked.filter("_ok").drop("_ok"), marked.filter("not _ok").drop("_ok"))

    def chains(self) -> None:
        """The same, and whatever follows from it along chains of rows that wait for one earlier row each.

        A row that is second for one key and first for the other waits for the first row of that key alone: it is accepted just where that
        one falls. Such links are followed by pointer jumping, so a chain of any length takes a logarithmic number of joins. A key
        whose second row is of this kind goes to its first or its second row, and all later ones fall.
        """
        rows = self._ranked()
        for name in (_A, _B):
            later = rows.filter(F.col("_at") > F.col(f"_first{name}"))
            seconds = later.groupBy(*self.group, name).agg(F.min("_at").alias(f"_second{name}"))
            rows = join_keys(rows, seconds, [*self.group, name], "left")
        first = {n: F.col(n).isNull() | (F.col("_at") == F.col(f"_first{n}")) for n in (_A, _B)}
        second = {n: F.coalesce(F.col("_at") == F.col(f"_second{n}"), F.lit(False)) for n in (_A, _B)}
        waits = F.when(second[_A] & first[_B], F.col(f"_first{_A}._id")).when(second[_B] & first[_A], F.col(f"_first{_B}._id"))
        third = {n: ~first[n] & ~second[n] for n in (_A, _B)}
        rows = materialize(rows.select(
            *self.group, _A, _B, "_at", "_id", (first[_A] & first[_B]).alias("_ok"), waits.alias("_waits"),
            *[second[n].alias(f"_is_second{n}") for n in (_A, _B)], *[third[n].alias(f"_is_third{n}") for n in (_A, _B)],
        ), "ranks")
        ends = self._chain_ends(rows.filter("_waits is not null").select("_id", F.col("_waits").alias("_end"), F.lit(1).alias("_n")))
        decided = ends.join(rows.filter("_ok").select(F.col("_id").alias("_end")), "_end", "left_semi")
        rows = rows.join(decided.select("_id", (F.col("_n") % 2 == 0).alias("_even")), "_id", "left")
        rows = materialize(rows.withColumn("_won", F.col("_ok") | F.coalesce("_even", F.lit(False))), "ranks")
        rest = rows.filter("not _won and _even is null")
        for name in (_A, _B):
            sealed = rows.filter(F.col("_waits").isNotNull() & F.col(f"_is_second{name}")).select(*self.group, name)
            late = F.col(f"_is_third{name}")
            rest = rest.filter(~late).unionByName(join_keys(rest.filter(late), sealed, [*self.group, name], "left_anti"))
        slim = [*self.group, _A, _B, "_at", "_id"]
        self._accept(rows.filter("_won").select(*slim), rest.select(*slim))

    @staticmethod
    def _chain_ends(links: DataFrame) -> DataFrame:
        """Last row that each row's chain of waiting leads to, and how many steps away it is."""
        while True:
            links = materialize(links, "chains")
            further = links.select(F.col("_id").alias("_end"), F.col("_end").alias("_next"), F.col("_n").alias("_more"))
            if links.join(further, "_end", "left_semi").isEmpty():
                return links
            jumped = links.join(further, "_end", "left")
            links = jumped.select("_id", F.coalesce("_next", "_end").alias("_end"), (F.col("_n") + F.coalesce("_more", F.lit(0))).alias("_n"))

    def walk(self, rows: DataFrame) -> DataFrame:
        """Ids of the rows that a walk through each group accepts, each group in one task."""
        dealt = rows.withColumn("_part", F.xxhash64(*self.group)).repartition("_part").sortWithinPartitions("_part", *self.group, "_at")
        return dealt.select("_id", _A, _B, *self.group).mapInPandas(_accept_in_order(self.group), "_id long")

    def prefixes(self, limit: int) -> None:
        """Walk through the first rows of each group; what they accept is tested against the rest by joins."""
        ahead = Window.partitionBy(*self.group).orderBy("_at")
        prefix = self.open.withColumn("_rn", F.row_number().over(ahead)).filter(F.col("_rn") <= limit).drop("_rn")
        prefix = materialize(prefix, "prefix")
        won = prefix.join(materialize(self.walk(prefix), "walked"), "_id", "left_semi")
        self._accept(won, self.open.join(prefix.select("_id"), "_id", "left_anti"))

    def run(self, rounds: int, limit: int) -> DataFrame:
        """Ids of all accepted rows."""
        for _ in range(rounds):
            self.first_rows()
        steps, k, before = (self.first_rows, self.chains, lambda: self.prefixes(limit)), 0, None
        while True:
            large = hot_groups(self.open, self.group, limit)
            if large is None:
                self.accepted.append(self.walk(self.open))
                return reduce(DataFrame.unionByName, self.accepted)
            small, self.open = split_hot(self.open, self.group, large)
            self.accepted.append(materialize(self.walk(small), "walked"))
            self.open = materialize(self.open, "open")
            n = self.open.count()
            # The next kind of step where the last one decided less than half of the rows.
            k = min(k + 1, 2) if before is not None and 2 * n > before else k
            before = n
            steps[k]()
            k = 1 if k == 2 else k


def dedup_either(
    df: DataFrame, group: Sequence[str], k1: str, k2: str, order: Sequence[str], rounds: int = 1, walk: int = WALK
) -> DataFrame:
    """Drop a row when an accepted earlier row of its group has the same ``k1`` or the same ``k2``.

    Missing or empty keys never match. Order decides, and it should be unique within a group. Rows that come first for both of their keys are
    accepted, and every row that shares a key with an accepted one falls away, by joins. ``rounds`` such rounds come first. Groups with at most
    ``walk`` open rows are then walked through in order, one task each; larger ones go on with rounds, with chains of rows that
    wait for one another followed by pointer jumping, and, where neither decides much, with their first ``walk`` rows, whose keys are
    tested against the rest. No task ever holds more than ``walk`` rows of a group.
    """
    p1, p2 = _present(k1), _present(k2)
    has_key = F.coalesce(p1, F.lit(False)) | F.coalesce(p2, F.lit(False))
    free, keyed = df.filter(~has_key), df.filter(has_key)
    keyed = materialize(keyed.withColumns({_A: F.when(p1, F.col(k1)), _B: F.when(p2, F.col(k2)), "_id": F.monotonically_increasing_id()}), "rows")
    slim = keyed.select(*group, _A, _B, F.struct(*order, "_id").alias("_at"), "_id")
    # A repeated pair of keys can never be accepted next to its first row.
    open_rows = materialize(dedup_first(slim, [*group, _A, _B], ["_at"]), "open")
    ids = _Greedy(open_rows, group).run(rounds, walk)
    accepted = keyed.join(ids, "_id", "left_semi").drop(_A, _B, "_id")
    return free.unionByName(accepted.select(*free.columns))
