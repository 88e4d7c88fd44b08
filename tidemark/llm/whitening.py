"""Whitening of embeddings; the components come from FEAST contour integration.

Partitions sum the vectors, then the products of the centred ones, so that only the covariance (dimension
squared numbers) is gathered. Inertia counts of the shifted covariance, by Sylvester's law those of its tridiagonal
form, bracket the wanted eigenvalues and cut their range at wide gaps into intervals of a few each. Every
interval is a Spark task: a quadrature of (z - V)^-1 Q along a circle around the interval projects a random
block onto the eigenvectors inside, Rayleigh-Ritz extracts them, and both repeat until the residuals are at rounding level.
An interval must yield as many components as the inertia counts of its ends differ, so none is missed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Production parameters: components at the most; scale and offset of the entries' integers; eigenvalues that an
#: interval is cut to hold; quadrature nodes of the half circle.
COMPONENTS = 32
SCALE, OFFSET = 64, 1_000_000
PER_INTERVAL = 8
NODES = 8

_ROUNDS = 60
_EPS = np.finfo(float).eps
_LARGEST = float(1 << 52)  # entries whose integers doubles don't hold exactly count as not finite
_ROWS = 2048


# ---------------------------------------------------------------- inertia

def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and off-diagonal of a tridiagonal matrix with the eigenvalues of symmetric ``v`` (Householder)."""
    a = v.astype(float).copy()
    for k in range(len(a) - 2):
        x = a[k + 1:, k].copy()
        norm = np.linalg.norm(x)
        if norm == 0.0:
            continue
        x[0] += norm if x[0] >= 0 else -norm
        x /= np.linalg.norm(x)
        a[k + 1:, k:] -= 2 * np.outer(x, x @ a[k + 1:, k:])
        a[:, k + 1:] -= 2 * np.outer(a[:, k + 1:] @ x, x)
    return np.diag(a).copy(), np.diag(a, 1).copy()


def inertia(tri: tuple[np.ndarray, np.ndarray], shifts: np.ndarray) -> np.ndarray:
    """For each shift, the number of eigenvalues below it: the negative pivots of the factored shifted matrix."""
    diagonal, off = tri
    least = _EPS * max(float(np.abs(diagonal).max(initial=0)), float(np.abs(off).max(initial=0)), 1e-300)
    pivot = np.full(len(shifts), np.inf)
    below = np.zeros(len(shifts), np.int64)
    for i, d in enumerate(diagonal):
        step = off[i - 1] ** 2 / pivot if i else 0.0
        pivot = d - shifts - step
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        below += pivot < 0
    return below


def locate(tri: tuple[np.ndarray, np.ndarray], steps: int = 40) -> np.ndarray:
    """Each eigenvalue, ascending, by bisection over inertia counts."""
    diagonal, off = tri
    n = len(diagonal)
    radius = np.abs(np.r_[off, 0.0]) + np.abs(np.r_[0.0, off])
    spread = max(float(np.abs(diagonal).max() + radius.max()), 1e-300)
    lo, hi = np.full(n, -1.01 * spread), np.full(n, 1.01 * spread)
    for _ in range(steps):
        middle = (lo + hi) / 2
        above = inertia(tri, middle) > np.arange(n)  # the i-th eigenvalue lies below the middle
        lo, hi = np.where(above, lo, middle), np.where(above, middle, hi)
    return (lo + hi) / 2


def intervals(places: np.ndarray, wanted: int, most: int = PER_INTERVAL) -> list[tuple[float, float]]:
    """Intervals that hold the ``wanted`` largest of the located eigenvalues, cut at the widest of the gaps near ``most``.

    Eigenvalues too near to part stay in one interval, however many.
    """
    down = places[::-1]
    scale = max(abs(float(down[0])), abs(float(down[-1])), 1e-300)
    gaps = np.r_[down[:-1] - down[1:], np.inf]
    top, out, first = float(down[0]) + 0.01 * scale, [], 0
    while first < wanted:
        near = np.arange(min(first + most // 2, len(down)) - 1, min(first + most, len(down)))
        last = int(near[np.argmax(gaps[near])])
        while gaps[last] < 1e-7 * scale:
            last += 1
        below = float(down[last]) - (0.01 * scale if last == len(down) - 1 else float(gaps[last]) / 2)
        out.append((below, top))
        top, first = below, last + 1
    return out


# ---------------------------------------------------------------- FEAST

def _quadrature(nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Points of the upper half of the unit circle and weights; the lower half is their conjugate."""
    x, w = np.polynomial.legendre.leggauss(nodes)
    point = np.exp(1j * np.pi / 2 * (x + 1))
    return point, w / 4 * point


def eigenvectors_between(v: np.ndarray, lo: float, hi: float, expected: int, nodes: int = NODES) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of ``v`` in (lo, hi) and their unit vectors as columns; there are ``expected`` of them.

    The block is widened, at last to the whole space, if the interval doesn't yield that many.
    """
    d, scale = len(v), max(float(np.abs(v).sum(axis=1).max()), 1e-300)
    points, weights = _quadrature(nodes)
    centre, radius = (lo + hi) / 2, (hi - lo) / 2
    width = min(d, expected + expected // 2 + 4)
    while True:
        q = np.random.default_rng(11).standard_normal((d, width))
        for _ in range(_ROUNDS):
            y = np.zeros((d, width))
            for point, weight in zip(points, weights, strict=True):
                shifted = (centre + radius * point) * np.eye(d) - v
                y += 2 * (radius * weight * np.linalg.solve(shifted, q)).real
            basis, _ = np.linalg.qr(y)
            values, inner = np.linalg.eigh(basis.T @ v @ basis)
            q = basis @ inner
            inside = (values > lo) & (values < hi)
            residual = np.linalg.norm(v @ q[:, inside] - q[:, inside] * values[inside], axis=0)
            if inside.sum() == expected and (residual < 64 * d * _EPS * scale).all():
                return values[inside], q[:, inside]
        if width == d:
            raise ArithmeticError(f"{int(inside.sum())} components found between {lo} and {hi}, inertia counts {expected}")
        width = min(d, 2 * width)


def leading_components(spark: SparkSession, v: np.ndarray, wanted: int, most: int = PER_INTERVAL) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of symmetric ``v``, falling, and their unit vectors as columns.

    Fewer where fewer are above rounding error. Each interval of the spectrum is solved by a task of its own. Of
    each vector the entry with the largest magnitude is positive.
    """
    none = np.zeros(0), np.zeros((len(v), 0))
    if not len(v) or not np.abs(v).max():
        return none
    tri = tridiagonal(v)
    places = locate(tri)
    wanted = min(wanted, len(v) - int(inertia(tri, np.array([8 * len(v) * _EPS * np.abs(places).max()]))[0]))
    cuts = intervals(places, wanted, most)
    counts = [int(n) for n in inertia(tri, np.array([x for c in cuts for x in c])).reshape(-1, 2) @ (-1, 1)]
    rows = [(lo, hi, n) for (lo, hi), n in zip(cuts, counts, strict=True)]
    if not rows:
        return none

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, hi, n in batch.itertuples(index=False, name=None):
                values, vectors = eigenvectors_between(v, lo, hi, n)
                yield pd.DataFrame({"value": values, "vector": list(vectors.T)})

    jobs = spark.createDataFrame(rows, "lo double, hi double, expected long").repartition(len(rows), "lo")
    found = jobs.mapInPandas(solve, "value double, vector array<double>").collect()
    # One more Rayleigh-Ritz over all intervals makes the vectors of neighbouring ones orthogonal to rounding.
    basis, _ = np.linalg.qr(np.array([r["vector"] for r in found]).T)
    values, inner = np.linalg.eigh(basis.T @ v @ basis)
    order = np.argsort(-values, kind="stable")[:wanted]
    vectors = (basis @ inner)[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
    return values[order], vectors * signs


# ---------------------------------------------------------------- the data

def _integers(batch: pa.RecordBatch, d: int) -> tuple[pa.Array, np.ndarray]:
    """Ids and integer vectors of the usable rows of a batch (id, vector): ``d`` finite entries."""
    ids, vectors = batch.column(0), batch.column(1)
    fits = pc.fill_null(pc.equal(pc.list_value_length(vectors), d), False)
    ids, vectors = ids.filter(fits), vectors.filter(fits)
    entries = pc.list_flatten(vectors).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)  # nulls are NaN
    scaled = np.floor(entries * SCALE)
    usable = (np.abs(scaled) < _LARGEST).all(axis=1)  # False for NaN
    return ids.filter(pa.array(usable)), scaled[usable].astype(np.int64) + OFFSET


def _summed(rows: DataFrame, d: int, value: str, sums) -> dict[int, float]:
    """{place: sum} of what ``sums(vectors)`` (an array) gives for each batch, over all partitions."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            _, x = _integers(batch, d)
            if len(x):
                part = sums(x)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["place", "part"])

    added = rows.mapInArrow(partial, f"place int, part {value}").groupBy("place").agg(F.sum("part").alias("total"))
    return dict(added.collect())


@dataclass(frozen=True)
class Whitening:
    """A fit: rows, sums per dimension, covariance, and the components' values (falling) and vectors (columns)."""
    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def matrix(self) -> np.ndarray:
        """Takes centred vectors (rows) to whitened ones."""
        return self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum((n * x - S)**2) of each row, exactly; None where that is no long."""
        d, largest = len(self.sums), max(int(np.abs(x).max(initial=0)), 1)
        if self.n * largest + max(map(abs, self.sums)) < 1 << 62:
            t = self.n * x - np.array(self.sums, np.int64)
            if int(np.abs(t).max(initial=0)) ** 2 * d < 1 << 63:
                return (t * t).sum(axis=1).tolist()
        exact = (sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums, strict=True)) for row in x.tolist())
        return [v if v < 1 << 63 else None for v in exact]


def _rows(embeddings: DataFrame, vector: str, vec_id: str) -> DataFrame:
    return embeddings.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"))


def fit(embeddings: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all usable vectors; None without any.

    A vector is usable if its entries are finite (and their integers exact in doubles), and it has the length that most
    vectors have, the longer of two equally common ones. What is gathered is dimension squared numbers.
    """
    rows = _rows(embeddings, vector, vec_id)
    sizes = rows.filter(F.size("vector") > 0).groupBy(F.size("vector").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = sizes.agg(F.max(F.struct("n", "d")).alias("most")).first()["most"]
    if common is None:
        return None
    d = common["d"]
    totals = _summed(rows, d, "long", lambda x: np.r_[x.sum(axis=0), len(x)])
    if not totals:
        return None
    n, sums = totals[d], [totals[i] for i in range(d)]
    mean, upper = np.array([s / n for s in sums]), np.triu_indices(d)

    def products(x: np.ndarray) -> np.ndarray:
        centred = x - mean
        return (centred.T @ centred)[upper]

    cells = _summed(rows, d, "double", products)
    covariance = np.zeros((d, d))
    covariance[upper] = [cells[i] / n for i in range(len(upper[0]))]
    covariance = covariance + np.triu(covariance, 1).T
    values, vectors = leading_components(embeddings.sparkSession, covariance, components)
    return Whitening(n, sums, covariance, values, vectors)


def identity_error(embeddings: DataFrame, model: Whitening, vector: str = "embedding", vec_id: str = "vec_id") -> float:
    """The largest entry, in magnitude, of the covariance of the whitened vectors less the identity."""
    k, d, mean, matrix = len(model.values), len(model.sums), model.mean, model.matrix
    if not k:
        return 0.0
    upper = np.triu_indices(k)

    def moments(x: np.ndarray) -> np.ndarray:
        w = (x - mean) @ matrix
        return np.r_[(w.T @ w)[upper], w.sum(axis=0)]

    cells = _summed(_rows(embeddings, vector, vec_id), d, "double", moments)
    of_mean = np.array([cells[len(upper[0]) + i] / model.n for i in range(k)])  # the vectors are centred; what is left is rounding
    covariance = np.array([cells[i] / model.n for i in range(len(upper[0]))]) - np.outer(of_mean, of_mean)[upper]
    return float(np.abs(covariance - np.eye(k)[upper]).max())


_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, vector: str = "embedding", vec_id: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained and identity_error for every usable row of
    ``embeddings`` and component.

    Entries are taken as the integers floor(SCALE * entry) + OFFSET. Rows whose vector is null, empty, of another length
    than most, or holds null or non-finite entries are dropped. Components whose variance is rounding error have no
    whitened value and no rows, so equal vectors, a single one, or an empty table give none. deviation is null
    where it is above a long. A null vec_id and repeated rows are rows like others; other columns are not read.
    """
    spark = embeddings.sparkSession
    model = fit(embeddings, vector, vec_id, components)
    if model is None or not len(model.values):
        return spark.createDataFrame([], _OUT)
    error = identity_error(embeddings, model, vector, vec_id)
    d, k, mean, matrix = len(model.sums), len(model.values), model.mean, model.matrix
    explained = model.values / np.trace(model.covariance)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, _ROWS):
                ids, x = _integers(batch.slice(first, _ROWS), d)
                m = len(x)
                if not m:
                    continue
                each = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays([
                    ids.take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    pa.array(model.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(((x - mean) @ matrix).ravel()), pa.array(np.tile(explained, m)),
                    pa.array(np.full(m * k, error))], [c.split()[0] for c in _OUT.split(", ")])

    return _rows(embeddings, vector, vec_id).mapInArrow(project, _OUT)
