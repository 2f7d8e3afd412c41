"""Embedding whitening: components by contour integration of the covariance's resolvent.

Spark reads the vectors: it makes the list of different grid vectors, adds up their sums and
their centred products, and projects every row. What reaches the driver is one covariance
(dimension squared, whatever the number of rows). Its leading components come from

* inertia: counts of eigenvalues above a shift, from the pivots of the shifted matrix, which
  place the interval at a gap and say how many components it must hold;
* contour integration: quadrature of complex shifted solves around the interval projects a
  block of vectors on the interval's eigenspace;
* Rayleigh-Ritz in that space, repeated until the residuals are at rounding level and the
  number of components inside equals the inertia count. Otherwise an error is raised.

Defined results: rows whose vector is null, or holds nulls or non-finite entries, are left out; so are
rows whose vector has another length than most different vectors have (of equally many, the
longest), since they are in no common space. Equal vectors are one in the fit and each get a
row. Columns other than the key and the vector are not looked at. Components whose eigenvalue
is zero at double precision do not exist; a table without any spread gives no rows. A
deviation beyond 64 bits is null.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from decimal import Decimal
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagrid.llm.graph import written

STEPS = 256.0  # grid steps in one unit
NODES = 16  # quadrature points on the upper half of a contour
ROUNDS = 60  # only stops a run that does not converge, with an error
GAP = 1e-8  # of the norm: eigenvalues nearer than this are not parted by an interval
EXACT = 1 << 62  # integers below this are added in 64 bits


def usable(vector: Column) -> Column:
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(math.inf))
    return vector.isNotNull() & F.forall(vector, lambda c: finite(c.cast("double")))


def grid(vector: Column) -> Column:
    """Whole grid steps of every entry."""
    return F.transform(vector, lambda c: F.floor(F.lit(STEPS) * c.cast("double")))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _largest(x: np.ndarray) -> int:
    return max(-int(x.min()), int(x.max())) if x.size else 0


class Centre(NamedTuple):
    """Number and sums of the different grid vectors."""

    n: int
    sums: list[int]

    def gaps(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums`` in whole numbers, of any size where 64 bits could overflow."""
        small = _largest(x) * self.n + max(map(abs, self.sums)) < EXACT
        kind = np.int64 if small else object
        return self.n * x.astype(kind) - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (self.gaps(x) / self.n).astype(float)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        gaps = self.gaps(x)
        if _largest(gaps) ** 2 * max(len(self.sums), 1) < EXACT:
            return (gaps * gaps).sum(1).tolist()
        exact = gaps.astype(object)
        return [int(v) if v < 1 << 63 else None for v in (exact * exact).sum(1)]


def centre(fit: DataFrame, dims: int) -> Centre:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = 0, [0] * dims
        for batch in batches:
            x = _matrix(batch.column(0), dims)
            part = x.sum(0) if _largest(x) * len(x) < EXACT else x.astype(object).sum(0)
            total = [a + int(b) for a, b in zip(total, part, strict=True)]
            count += len(x)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, dims), pa.int32()), pa.array([Decimal(v) for v in (count, *total)], pa.decimal128(38, 0))],
            ["at", "total"],
        )

    added = fit.mapInArrow(sums, "at int, total decimal(38,0)").groupBy("at").agg(F.sum("total").alias("total"))
    total = {r.at: int(r.total) for r in added.collect()}  # one row for each dimension
    return Centre(total[-1], [total[i] for i in range(dims)])


def _products(fit: DataFrame, dims: int, of: int, values) -> np.ndarray:
    """Sum over all rows of the outer product of ``values(x)``, which has ``of`` columns."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((of, of))
        for batch in batches:
            y = values(_matrix(batch.column(0), dims))
            total += y.T @ y
        i, j = np.triu_indices(of)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "total"]
        )

    added = fit.mapInArrow(products, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total"))
    out = np.zeros((of, of))
    for r in added.collect():  # dimensions squared, not rows
        out[r.i, r.j] = out[r.j, r.i] = r.total
    return out


class Inertia:
    """Counts of eigenvalues above a shift, from the pivots of the tridiagonal form."""

    def __init__(self, matrix: np.ndarray) -> None:
        a, n = matrix.astype(float), len(matrix)
        for k in range(n - 2):
            v = a[k + 1 :, k].copy()
            v[0] += math.copysign(float(np.linalg.norm(v)), v[0])
            length = float(v @ v)
            if length > 0:
                a[k + 1 :] -= np.outer(v, (2 / length) * (v @ a[k + 1 :]))
                a[:, k + 1 :] -= np.outer((2 / length) * (a[:, k + 1 :] @ v), v)
        self.diagonal = np.diag(a).tolist()
        self.squares = (np.diag(a, -1) ** 2).tolist()
        reach = np.abs(np.diag(a)).copy()
        reach[:-1] += np.abs(np.diag(a, -1))
        reach[1:] += np.abs(np.diag(a, -1))
        self.norm = float(reach.max())

    def above(self, shift: float) -> int:
        tiny = np.finfo(float).tiny / np.finfo(float).eps
        count, pivot = 0, 1.0
        for d, square in zip(self.diagonal, [0.0, *self.squares]):
            pivot = d - shift - square / pivot
            pivot = pivot if abs(pivot) > tiny else -tiny
            count += pivot > 0
        return count

    def value(self, k: int) -> float:
        """The k-th largest eigenvalue, by bisection on the counts."""
        low, high = -self.norm * 1.01, self.norm * 1.01
        while True:
            middle = (low + high) / 2
            if middle in (low, high) or high - low <= np.finfo(float).eps * self.norm:
                return middle
            low, high = (middle, high) if self.above(middle) >= k else (low, middle)


def _projected(matrix: np.ndarray, block: np.ndarray, low: float, high: float) -> np.ndarray:
    """Quadrature of the resolvent on a circle through ``low`` and ``high``, applied to a block."""
    points, weights = np.polynomial.legendre.leggauss(NODES)
    middle, radius = (low + high) / 2, (high - low) / 2
    out = np.zeros_like(block)
    for x, w in zip(points, weights, strict=True):
        turn = np.exp(0.5j * math.pi * (1 + x))
        shifted = (middle + radius * turn) * np.eye(len(matrix)) - matrix
        out += (0.5 * w * radius * turn * np.linalg.solve(shifted, block)).real
    return out


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest positive eigenvalues, falling, and their unit vectors as columns, ``wanted`` at most."""
    dims = len(matrix)
    if dims == 0 or not matrix.any():
        return np.zeros(0), np.zeros((dims, 0))
    scale = float(np.abs(matrix).max())  # solves near the smallest doubles stay normal
    matrix = matrix / scale
    inertia = Inertia(matrix)
    floor = dims * np.finfo(float).eps * inertia.norm
    wanted = min(wanted, inertia.above(floor))
    inside = wanted
    while inside < dims and inertia.value(inside) - inertia.value(inside + 1) <= GAP * inertia.norm:
        inside += 1  # the interval ends at a gap
    largest, smallest = inertia.value(1), inertia.value(inside)
    below = inertia.value(inside + 1) if inside < dims else smallest - inertia.norm
    low = (smallest + below) / 2
    high = largest + max(0.1 * (largest - low), GAP * inertia.norm)
    expected = inertia.above(low) - inertia.above(high)
    block = np.random.default_rng(0).normal(size=(dims, min(dims, 2 * inside + 8)))
    close = 50 * np.finfo(float).eps * inertia.norm * math.sqrt(dims)
    for _ in range(ROUNDS):
        basis, _r = np.linalg.qr(_projected(matrix, block, low, high))
        values, turn = np.linalg.eigh(basis.T @ matrix @ basis)
        block = basis @ turn
        held = (values > low) & (values <= high)
        vectors = block[:, held]
        residual = np.abs(matrix @ vectors - vectors * values[held]).max(initial=0)
        if held.sum() == expected and residual <= close:
            order = np.argsort(-values[held], kind="stable")[:wanted]
            chosen = vectors[:, order]
            signs = np.sign(chosen[np.abs(chosen).argmax(0), np.arange(len(order))])
            return values[held][order] * scale, chosen * signs
    raise RuntimeError(f"{held.sum()} of {expected} components in the interval after {ROUNDS} rounds")


class Whitening(NamedTuple):
    """A fitted model: of the size of its dimensions squared, whatever it was fitted on."""

    centre: Centre
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float

    def project(self, x: np.ndarray) -> np.ndarray:
        """Scores, summed row by row: equal vectors get equal scores in whatever batch they are."""
        points, axes = self.centre.centred(x), (self.vectors / np.sqrt(self.values)).T
        return np.stack([(points * axis).sum(1) for axis in axes], 1) if len(axes) else np.zeros((len(x), 0))


def different(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """Every usable grid vector once; copies are combined before the shuffle."""
    return rows.where(usable(F.col(vector))).select(grid(F.col(vector)).alias("x")).distinct()


def fit(rows: DataFrame, vector: str = "embedding", components: int = 4) -> Whitening | None:
    """The model of all usable vectors, or None where there are none."""
    listed = written(different(rows, vector), "grid-vectors")
    common = listed.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    if common is None or common.dims == 0:
        return None
    dims = common.dims
    listed = listed.where(F.size("x") == dims)
    middle = centre(listed, dims)
    covariance = _products(listed, dims, dims, middle.centred) / middle.n
    values, vectors = leading(covariance, components)
    model = Whitening(middle, values, vectors, float(np.trace(covariance)), 0.0)
    if len(values) == 0:
        return model
    # Measured on the rows: a first column of ones brings the means along.
    ones = lambda x: np.column_stack([np.ones(len(x)), model.project(x)])
    moments = _products(listed, dims, len(values) + 1, ones) / middle.n
    spread = moments[1:, 1:] - np.outer(moments[0, 1:], moments[0, 1:])
    return model._replace(identity_error=float(np.abs(spread - np.eye(len(values))).max()))


def whiten(rows: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, ``whitened`` (array) and ``deviation`` of every row that the model can place."""
    schema = rows.select(F.col(key), F.lit(None).cast("array<double>").alias("whitened"), F.lit(None).cast("long").alias("deviation")).schema
    if model is None:
        return rows.sparkSession.createDataFrame([], schema)
    dims = len(model.centre.sums)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), dims)
            points = model.project(x)
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * points.shape[1])
            whitened = pa.ListArray.from_arrays(ends, pa.array(points.ravel()))
            deviation = pa.array(model.centre.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), whitened, deviation], [key, "whitened", "deviation"])

    placed = rows.where(usable(F.col(vector)) & (F.size(vector) == dims))
    return placed.select(F.col(key), grid(F.col(vector)).alias("_x")).mapInArrow(place, schema)


def components(rows: DataFrame, wanted: int = 4) -> DataFrame:
    """One row for each usable vector and component, with the figures of the fit."""
    model = fit(rows, components=wanted)
    placed = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    shares = [float(v / model.trace) for v in model.values] if model is not None else []
    explained = F.get(F.array(*map(F.lit, shares)) if shares else F.array().cast("array<double>"), F.col("_at"))
    return placed.select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        F.lit(model.centre.n if model is not None else 0).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained.alias("explained"),
        F.lit(model.identity_error if model is not None else 0.0).alias("identity_error"),
    )
