"""Whitening of vectors by shifted CholeskyQR.

1. Components become whole numbers, and the distinct vectors are the list that the transform is fitted to. Sums and
   deviations from the mean are exact.
2. A pass over the centred rows adds up their Gram matrix, a block of rows at a time. Its triangular factor, from the
   matrix shifted by a multiple of the rounding error so that it exists whatever the condition, takes the rows nearly
   to an orthonormal basis by triangular solves. Further passes repeat this on the solved rows until their Gram
   matrix is the identity; the rows themselves are never stored anew, each pass solves by all factors so far.
3. The composed factors are one triangular matrix R with the singular values of the centred rows. Its decomposition
   gives the components and their variances.

The driver holds matrices of the vectors' width, never rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forgemart.llm.common import discard, staged

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
LARGEST = 2.0**34  # of an entry's absolute value
PASSES = 8
BLOCK = 8192  # rows multiplied at once
RANK = 1e-12  # a singular value below this share of the largest is zero

WHITENED = (
    "vec_id long, component int, n long, deviation long, deviation_exact string, whitened double, explained double, "
    "identity_error double"
)


def whole(vectors: DataFrame) -> DataFrame:
    """(vec_id, x): ``floor(64 * c) + 1000000`` of each vector that takes part."""
    entry = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(LARGEST))
    x = F.transform("embedding", lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("long") + F.lit(OFFSET))
    rows = vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & F.forall("embedding", entry))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x"))


def _matrix(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _sums(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    total, count = np.zeros(width, np.int64), 0
    for batch in batches:
        total += _matrix(batch, width).sum(axis=0)
        count += batch.num_rows
    columns = [pa.array(np.arange(width, dtype=np.int32)), pa.array(total), pa.array(np.full(width, count))]
    yield pa.RecordBatch.from_arrays(columns, names=["i", "total", "number"])


class Centre:
    """Row count and exact sums of the fitted list."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = np.array([s % n for s in sums], np.int64)

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact."""
        near = x - self.whole
        if self.n * (int(np.abs(near).max(initial=0)) + 1) >= 2**62:
            near = near.astype(object)
        return self.n * near - self.rest

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum of squares of ``n * x - S`` of each row, exact."""
        scaled = self.scaled(x)
        if scaled.dtype == object or int(np.abs(scaled).max(initial=0)) ** 2 * x.shape[1] >= 2**62:
            scaled = scaled.astype(object)
        return (scaled * scaled).sum(axis=1).tolist()

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.scaled(x).astype(np.float64) / self.n


def solved(rows: np.ndarray, factors: list[np.ndarray]) -> np.ndarray:
    """``rows`` times the inverse of each upper triangular factor in turn, column by column."""
    for r in factors:
        out = np.empty_like(rows)
        for j in range(rows.shape[1]):
            out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
        rows = out
    return rows


def _gram(batches: Iterator[pa.RecordBatch], width: int, turn) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        x = _matrix(batch, width)
        for at in range(0, len(x), BLOCK):
            rows = turn(x[at : at + BLOCK])
            total = rows.T @ rows + (0 if total is None else total)
    if total is not None:
        i, j = np.triu_indices(len(total))
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "value"])


def gram(fit: DataFrame, width: int, size: int, turn) -> np.ndarray:
    """Sum over the rows of ``turn(x)`` transposed times ``turn(x)``; ``size`` numbers on a side."""
    cells = fit.mapInArrow(functools.partial(_gram, width=width, turn=turn), "i int, j int, value double")
    out = np.zeros((size, size))
    for r in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():  # of the vectors' width
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def _turn(x: np.ndarray, centre: Centre, factors: list[np.ndarray]) -> np.ndarray:
    return solved(centre.centred(x), factors)


def _project(x: np.ndarray, centre: Centre, axes: np.ndarray) -> np.ndarray:
    return centre.centred(x) @ axes


def factor(matrix: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """The upper triangular R with R'R = ``matrix``, shifted if asked for or if the matrix has no such factor."""
    width, size = len(matrix), np.linalg.norm(matrix, 2)
    shift = 11 * (width * n + width * (width + 1)) * np.finfo(float).eps / 2 * size if shifted else 0.0
    while True:
        try:
            return np.linalg.cholesky(matrix + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, width * np.finfo(float).eps * size)


def fit(rows: DataFrame, width: int, centre: Centre) -> tuple[np.ndarray, np.ndarray]:
    """Variances by falling size, and the components as columns, of ``rows`` (x, each once)."""
    n, factors, whole_r = centre.n, [], np.eye(width)
    for turn in range(PASSES):
        matrix = gram(rows, width, width, functools.partial(_turn, centre=centre, factors=factors))
        if not matrix.any():
            break
        if turn and np.abs(matrix - np.eye(width)).max() < 1e-13 * width:
            break
        factors.append(factor(matrix, min(n, 1 << 20), not turn))
        whole_r = factors[-1] @ whole_r
    if not factors:
        return np.zeros(0), np.zeros((width, 0))
    _, singular, axes = np.linalg.svd(whole_r)
    return singular**2 / n, axes.T


def _whiten(batches: Iterator[pa.RecordBatch], width: int, centre: Centre, axes: np.ndarray, shares: np.ndarray, error: float):
    count = axes.shape[1]
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            x = _matrix(part, width)
            number = len(x)
            deviations = centre.deviations(x)
            spread = lambda values, kind: pa.array(values, kind).take(pa.array(np.repeat(np.arange(number), count)))
            columns = [
                part.column("vec_id").take(pa.array(np.repeat(np.arange(number), count))),
                pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), number)),
                pa.array(np.full(number * count, centre.n)),
                spread([d if d < 2**63 else None for d in deviations], pa.int64()),
                spread([str(d) for d in deviations], pa.string()),
                pa.array(_project(x, centre, axes).ravel()),
                pa.array(np.tile(shares, number)),
                pa.array(np.full(number * count, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in WHITENED.split(", ")])


def whiten(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, deviation_exact, whitened, explained, identity_error: one row per vector and
    component, up to ``components``.

    Vectors that are null, empty, or hold a null or non-finite entry or one of ``LARGEST`` and more take no part, nor
    those of another width than most (of equally frequent widths the largest counts). Rows with the same vector, the
    same id or none each keep their rows; the fitted list has a vector once. Directions without variance are no
    components, so one distinct vector, or none, gives no rows. ``deviation`` is null where 64 bits can't hold it;
    ``deviation_exact`` always has its digits. Other columns are not read.
    """
    spark = vectors.sparkSession
    rows = whole(vectors)
    widths = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    empty = spark.createDataFrame([], WHITENED)
    if not widths:
        return empty
    width = widths[0]["width"]
    rows = rows.filter(F.size("x") == width)
    distinct = staged(rows.select("x").distinct(), "vectors")
    cells = distinct.mapInArrow(functools.partial(_sums, width=width), "i int, total long, number long")
    exact = F.sum(F.col("total").cast("decimal(38,0)"))
    sums = cells.groupBy("i").agg(exact.alias("total"), F.sum("number").alias("number")).orderBy("i").collect()
    centre = Centre(sums[0]["number"], [int(r["total"]) for r in sums])
    variances, axes = fit(distinct, width, centre)
    kept = int((np.sqrt(variances) > RANK * np.sqrt(variances.max(initial=0))).sum()) if len(variances) else 0
    kept = min(kept, components)
    if not kept:
        discard(distinct)
        return empty
    shares = variances[:kept] / variances.sum()
    axes = axes[:, :kept] / np.sqrt(variances[:kept])
    covariance = gram(distinct, width, kept, functools.partial(_project, centre=centre, axes=axes)) / centre.n
    error = float(np.abs(covariance - np.eye(kept)).max())
    discard(distinct)
    run = functools.partial(_whiten, width=width, centre=centre, axes=axes, shares=shares, error=error)
    return rows.mapInArrow(run, WHITENED)
