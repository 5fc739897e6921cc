"""Vector codes: every vector becomes one entry number per part, by codebooks that Lloyd rounds fit on all vectors.

Components are scaled to integers, so distances, means and ties are exact. Each part keeps, in a table, the entry it is assigned to and the exact
distance to it.

Active-entry Lloyd: after an update only some entries have moved. A part whose own entry stayed where it was has its stored distance still, and no entry that
stayed can have come closer, so it is compared with the moved entries alone. A part whose own entry moved is compared with all
entries. Of equally near entries the lowest number wins, in both cases.

Vectors stay on the executors: a round is one pass that assigns, written as a table with its distances, and one pass that adds up per task, at most
one row per entry; the driver gets the sums of all entries (64 per part, so as many numbers as 64 vectors have) and sends the codebooks back.

Defined results: a NULL vector, or one with a NULL, NaN or infinite component, is left out, whatever else its row holds. Vectors are as wide as the widest
one, up to a multiple of the number of parts; missing components are 0. Rows with equal ids are ordered by their vectors, a
NULL id comes last; repeated rows are kept. With fewer vectors than entries there are as many entries as vectors. With no component at all a part is one 0. Scaled components
are held within 2 ** 52, and an error beyond the largest long is that long. An empty table gives an empty result. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from refloom.llm.common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Sums beyond this are not exact in floating point; Python integers take their place.
EXACT = 1 << 53
LARGEST = (1 << 63) - 1
#: Parts that the rows of one label are dealt out to when its sum is joined to them.
SALTS = 32


def integers(vector: Column, scale: int = SCALE) -> Column:
    """Components scaled and rounded down."""
    bound = float(1 << 52)
    return F.transform(vector, lambda x: F.floor(F.greatest(F.lit(-bound), F.least(F.lit(bound), x.cast("double") * scale))).cast("long"))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def cut(rows: np.ndarray, parts: int) -> np.ndarray:
    """Vectors (rows) as part, row, component."""
    return rows.reshape(len(rows), parts, -1).transpose(1, 0, 2)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, a row per point and a column per entry."""
    if points.dtype == object:
        return ((points[:, None, :] - entries.astype(object)[None]) ** 2).sum(2)
    entries = entries.astype(float)
    return (points**2).sum(1)[:, None] - 2 * points @ entries.T + (entries**2).sum(1)


def nearest(points: np.ndarray, entries: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of the entries with the given (ascending) numbers, and its distance; the lowest number of equals."""
    d = distances(points, entries[of])
    best = d.argmin(1)
    return of[best], d[np.arange(len(d)), best]


def assign(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry number and distance of each point, compared with all entries."""
    return nearest(points, entries, np.arange(len(entries)))


def reassign(
    points: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray, stored: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The same after the entries in ``moved`` (a mask) have changed; a stored distance below 0 is not known."""
    code, best = code.copy(), stored.astype(points.dtype)
    again = moved[code] | (stored < 0)
    if again.any():
        code[again], best[again] = assign(points[again], entries)
    if moved.any() and not again.all():
        own, d = code[~again], best[~again]
        other, near = nearest(points[~again], entries, np.flatnonzero(moved))
        closer = (near < d) | ((near == d) & (other < own))
        code[~again], best[~again] = np.where(closer, other, own), np.where(closer, near, d)
    return code, best


def update(entries: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Each entry replaced by the mean of its points, rounded down; unused entries stay. Arrays of Python integers."""
    used = counts > 0
    out = entries.copy()
    out[used] = sums[used] // counts[used][:, None]
    return out


_STATE = "vec_id long, label string, v array<long>, codes array<int>, dists array<long>"
_CODED = "vec_id long, label string, code string, error long"


def _matrix(column: pa.ListArray, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))


def _assigned(batch: pa.RecordBatch, books: np.ndarray, moved: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Entry numbers and distances of a batch, a row per part."""
    v = _matrix(batch.column("v"), batch.num_rows)
    width = v.shape[1]
    largest = max(abs(int(x)) for x in (v.min(), v.max(), books.min(), books.max()))
    points = cut(v, len(books)).astype(float if 8 * width * largest * largest < EXACT else object)
    if moved is None:
        found = [assign(p, b) for p, b in zip(points, books, strict=True)]
    else:
        codes, dists = _matrix(batch.column("codes"), batch.num_rows).T, _matrix(batch.column("dists"), batch.num_rows).T
        found = [reassign(p, b, m, c, d) for p, b, m, c, d in zip(points, books, moved, codes, dists, strict=True)]
    return np.array([c for c, _ in found]), np.array([d for _, d in found], dtype=points.dtype)


def _assign_pass(rows: DataFrame, books: np.ndarray, moved: np.ndarray | None = None) -> DataFrame:
    """State of all vectors after one assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes, dists = _assigned(batch, books, moved)
                known = np.where(dists <= LARGEST >> 1, dists, -1).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), batch.column("v"), _lists(codes.T.astype(np.int32)), _lists(known.T)],
                    names=["vec_id", "label", "v", "codes", "dists"],
                )

    return rows.mapInArrow(run, _STATE)


def _code_pass(rows: DataFrame, books: np.ndarray, moved: np.ndarray) -> DataFrame:
    """Code and error of all vectors by the last assignment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                codes, dists = _assigned(batch, books, moved)
                error = [min(LARGEST, int(e)) for e in dists.sum(0)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), batch.column("label"), [bytes(c.tolist()).hex() for c in codes.T], pa.array(error, pa.int64())],
                    names=["vec_id", "label", "code", "error"],
                )

    return rows.mapInArrow(run, _CODED)


def _sums(state: DataFrame, shape: tuple[int, int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Points and component sums of every entry. Added up in each task first: a row per entry and task."""
    parts, entries, width = shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros(shape, object)
        for batch in batches:
            if not batch.num_rows:
                continue
            v, codes = cut(_matrix(batch.column("v"), batch.num_rows), parts), _matrix(batch.column("codes"), batch.num_rows).T
            small = batch.num_rows * max(abs(int(v.min())), abs(int(v.max()))) < EXACT
            for p in range(parts):
                counts[p] += np.bincount(codes[p], minlength=entries)
                for k in range(width):
                    if small:
                        sums[p, :, k] += np.bincount(codes[p], v[p, :, k], entries).astype(np.int64)
                    else:
                        np.add.at(sums[p, :, k], codes[p], v[p, :, k].astype(object))
        part, entry = np.nonzero(counts)
        totals = [[str(x) for x in row] for row in sums[part, entry]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part.astype(np.int32)), pa.array(entry.astype(np.int32)), pa.array(counts[part, entry]), pa.array(totals, pa.list_(pa.string()))],
            names=["part", "entry", "n", "totals"],
        )

    rows = state.select("v", "codes").mapInArrow(add, "part int, entry int, n long, totals array<string>")
    rows = rows.select("part", "entry", "n", F.posexplode("totals").alias("k", "total"))
    totals = rows.groupBy("part", "entry", "k").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    counts, sums = np.zeros((parts, entries), object), np.zeros(shape, object)
    for r in totals.collect():  # as many rows as ``entries`` vectors have components
        counts[r["part"], r["entry"]] = r["n"]
        sums[r["part"], r["entry"], r["k"]] = int(r["total"])
    return counts, sums


def fit(
    rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[np.ndarray, np.ndarray, DataFrame] | None:
    """Codebooks (part, entry, component), which entries moved last, and the state table before the assignment to these; None without rows.

    ``rows`` has vec_id, label and v, all v of one width, a multiple of ``parts``.
    """
    first = rows.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    if not first:
        return None
    books = cut(np.array([r["v"] for r in first], object), parts)
    state, moved = materialize(_assign_pass(rows, books), "codes"), None
    for k in range(rounds):
        if k:
            state = materialize(_assign_pass(state, books, moved), "codes")
        counts, sums = _sums(state, books.shape)
        after = np.array([update(b, c, s) for b, c, s in zip(books, counts, sums, strict=True)], object)
        books, moved = after, (after != books).any(2)
    return books, moved if moved is not None else np.zeros(books.shape[:2], bool), state


def vectors(df: DataFrame, parts: int = PARTS, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """The usable vectors as integers of one width: vec_id, label, v."""
    kept = df.filter(usable(F.col(vector_col))).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), integers(F.col(vector_col)).alias("v")
    )
    widest = kept.agg(F.max(F.size("v"))).first()[0] or 0
    width = max(parts, -(-widest // parts) * parts)
    padding = F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("v"))
    return kept.withColumn("v", F.concat("v", padding))


def codes(
    df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """``vec_id``, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable vector."""
    rows = vectors(df, parts, id_col, vector_col, label_col)
    fitted = fit(rows, parts, entries, rounds)
    if fitted is None:
        return df.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    books, moved, state = fitted
    coded = materialize(_code_pass(state, books, moved), "codes")
    digest = hashlib.sha256(",".join(str(x) for x in books.ravel()).encode()).hexdigest()
    # A label may have any share of the rows: its sum meets them dealt out by id.
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LARGEST).cast("decimal(38,0)")).cast("long")
    sums = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of")
    sums = sums.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    salt = F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS))
    joined = coded.withColumn("salt", salt).join(sums, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("at")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
