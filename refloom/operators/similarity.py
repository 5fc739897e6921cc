"""Threshold similarity search over a vectors table."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )


#: Pivots that make join cells, and pivots in all; vectors looked at to choose them (a choice of speed, never of results).
CELL_PIVOTS, PIVOTS, PIVOT_SAMPLE = 2, 6, 1000
#: Rings that the largest angle is cut into.
RINGS = 3


def choose_pivots(df: DataFrame, vec: str, n: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> list[list[float]]:
    """Directions far from one another, out of the first ``sample`` vectors: each is the one farthest from those before it."""
    found = [r["v"] for r in df.select(F.col(vec).alias("v")).filter(F.col(vec).isNotNull()).limit(sample).collect()]
    width = max((len(v) for v in found), default=0)
    rows = np.array([v for v in found if len(v) == width and None not in v], float).reshape(-1, width)
    length = np.linalg.norm(rows, axis=1)
    rows = rows[(length > 0) & np.isfinite(length)] / length[(length > 0) & np.isfinite(length), None]
    pivots: list[np.ndarray] = []
    nearest = np.full(len(rows), -np.inf)
    while len(rows) and len(pivots) < n:
        at = int(nearest.argmin())
        if pivots and nearest[at] > 1 - 1e-9:
            break
        pivots.append(rows[at])
        nearest = np.maximum(nearest, rows @ rows[at])
    return [p.tolist() for p in pivots]


def similar(
    df: DataFrame, queries: DataFrame, vec: str, cutoff: float, keep: Sequence[str], query_id: str = "query_id", query_vec: str = "query_vec",
    pivots: Sequence[Sequence[float]] | None = None,
) -> DataFrame:
    """Rows whose Tanimoto similarity to a query vector is at least ``cutoff``: (keep, query_id, score).

    Score = a.b / (|a|^2 + |b|^2 - a.b). It bounds the ratio of the two lengths, and the angle between the vectors by acos(2c / (1 + c)). Angles are a
    metric, so two vectors this close have angles to any third one, a pivot, that differ by no more. Rows lie in cells: a band of length, and a ring of
    angles around each of two pivots. A query meets the cells within its bounds by an equi join; pairs outside the exact bounds of
    length, or of the angle to any pivot, are dropped before a product is formed. A zero vector is similar to nothing. Without a
    cutoff above 0 nothing can be ruled out.
    """
    pairs = candidates(df, queries, vec, cutoff, keep, query_id, query_vec, pivots).withColumn("_d", dot(F.col("_v"), F.col("_q")))
    score = F.col("_d") / F.nullif(F.col("_n2") + F.col("_q2") - F.col("_d"), F.lit(0.0))
    return pairs.select(*keep, "query_id", score.alias("score")).filter(F.col("score") >= cutoff)


def candidates(
    df: DataFrame, queries: DataFrame, vec: str, cutoff: float, keep: Sequence[str], query_id: str = "query_id", query_vec: str = "query_vec",
    pivots: Sequence[Sequence[float]] | None = None,
) -> DataFrame:
    """Pairs that bounds do not rule out: (keep, query_id), vectors as _v and _q, their squared lengths as _n2 and _q2."""
    if cutoff <= 0:
        rows = df.select(*keep, F.col(vec).alias("_v"), dot(F.col(vec), F.col(vec)).alias("_n2"), F.lit(0).alias("_cell"))
        asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("_q"), dot(F.col(query_vec), F.col(query_vec)).alias("_q2"), F.lit(0).alias("_cell"))
        return rows.join(asked, "_cell").drop("_cell")
    low, high = _length_band(cutoff)
    width = 2 * math.log(high)
    # Rounding: an angle near 0 is known to about 1e-8.
    angle = math.acos(min(1.0, 2 * cutoff / (1 + cutoff))) + 1e-6
    ring = angle / RINGS
    pivots = choose_pivots(queries, query_vec) if pivots is None else [[x / math.hypot(*p) for x in p] for p in pivots]
    cells = min(CELL_PIVOTS, len(pivots))
    listed = ", ".join("array(" + ", ".join(f"{float(x)!r}D" for x in p) + ")" for p in pivots)
    directions = F.expr(f"array({listed})").cast("array<array<double>>")

    def placed(table: DataFrame, v: str, n2: str) -> DataFrame:
        table = table.withColumn(n2, dot(F.col(v), F.col(v))).filter(F.col(n2) > 0)
        share = F.transform(directions, lambda p: F.try_divide(dot(F.col(v), p), F.sqrt(n2)))
        return table.withColumn(f"{v}_angles", F.transform(share, lambda x: F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x)))))

    def cell_of(v: str, n2: str) -> list[Column]:
        return [F.floor(F.ln(n2) / width)] + [F.floor(F.col(f"{v}_angles")[k] / ring) for k in range(cells)]

    rows = placed(df.select(*keep, F.col(vec).alias("_v")), "_v", "_n2")
    rows = rows.withColumns({f"_c{k}": c for k, c in enumerate(cell_of("_v", "_n2"))})
    asked = placed(queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).alias("_q")), "_q", "_q2")
    for k, c in enumerate(cell_of("_q", "_q2")):
        reach = 1 if k == 0 else RINGS
        asked = asked.withColumn(f"_c{k}", F.explode(F.sequence(c - reach, c + reach)))
        if k:
            asked = asked.filter((F.col(f"_c{k}") >= 0) & (F.col(f"_c{k}") * ring <= math.pi))
    near = F.col("_n2").between(F.col("_q2") * (low * low * (1 - 1e-9)), F.col("_q2") * (high * high * (1 + 1e-9)))
    for k in range(len(pivots)):
        near &= F.abs(F.col("_v_angles")[k] - F.col("_q_angles")[k]) <= angle
    found = rows.join(asked, [f"_c{k}" for k in range(1 + cells)]).filter(near)
    return found.select(*keep, "query_id", "_v", "_q", "_n2", "_q2")


def _length_band(cutoff: float) -> tuple[float, float]:
    """Ratio |a|/|q| that can still reach the cutoff: roots of c r^2 - (1 + c) r + c = 0."""
    root = math.sqrt(max((1 + cutoff) ** 2 - 4 * cutoff * cutoff, 0.0))
    # A cutoff of 1 leaves one length; a band of some width around it keeps rounding harmless.
    return ((1 + cutoff) - root) / (2 * cutoff), max(((1 + cutoff) + root) / (2 * cutoff), 1 + 1e-6)
