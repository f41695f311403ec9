"""Whitening of embeddings with the covariance by polarisation.

Each entry c becomes the integer x = floor(scale * c) + shift. One scan adds up x by dimension: n rows
and sums S. A second one adds up squares: of the centred value of every dimension, and of the sum
of two centred values for every pair of dimensions. Values are centred at the whole number next
below the mean, and what is left of the mean is taken out of the sums of squares in whole
numbers, so that sum((n*x - S)^2) and its like for pairs are exact whatever n is. The variance of
a sum less the two variances is twice the covariance; the matrix, each entry rounded
once, goes to ``eigh`` on the driver: d * (d + 1) / 2 numbers for vectors of d entries, however
many rows there are. A third scan writes the projections and a fourth, over the projections,
measures how far their covariance is from the identity.

Defined results: rows whose vector is NULL, empty, or holds NULL or non-finite entries are dropped,
and so are rows of another length than most (the larger length, if two are as frequent); a NULL
vec_id stays NULL; rows that repeat a vec_id, or all of a row, count each; a component
without variance (fewer independent rows than components) has explained 0 and whitened NULL and
does not enter identity_error; an entry beyond 2^61 after scaling is an error; an empty
table gives an empty table; only vec_id and embedding are looked at.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cinderlake.llm.vectors import matrices, width_of
from cinderlake.workspace import empty_frame

_EXACT = 1 << 53  # whole numbers up to here are exact in double precision
_LARGEST = float(1 << 61)
_NUMBER = pa.decimal128(38, 0)
# A component with less than this share of the largest variance has none but rounding.
_NO_VARIANCE = 1e-13
OUTPUT = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, "
    "explained double, identity_error double"
)


def whole(values: np.ndarray, scale: float, shift: int) -> np.ndarray:
    """floor(scale * c) + shift as 64-bit integers."""
    scaled = np.floor(values * scale)
    if np.abs(scaled).max(initial=0.0) >= _LARGEST:
        raise ValueError("an embedding holds an entry that is too large to whiten exactly")
    return scaled.astype(np.int64) + shift


def column_sums(x: np.ndarray) -> list[int]:
    """Sums of columns of 64-bit integers, exact beyond 64 bits."""
    high, low = (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)
    return [(int(h) << 32) + int(v) for h, v in zip(high, low, strict=True)]


def square_sums(z: np.ndarray) -> np.ndarray:
    """Sums of z_i^2 and of (z_i + z_j)^2 for i < j, exact: rows of an upper triangle in order."""
    largest = int(np.abs(z).max(initial=0))
    exact = 4 * largest**2 * len(z) < _EXACT
    columns = np.ascontiguousarray(z.T, np.float64 if exact else object)
    out = []
    for i in range(len(columns)):
        both = columns[i + 1 :] + columns[i]
        if exact:
            out.append(np.array([columns[i] @ columns[i]]))
            out.append(np.einsum("ij,ij->i", both, both))
        else:
            out.append((columns[i : i + 1] ** 2).sum(axis=1))
            out.append((both**2).sum(axis=1))
    joined = np.concatenate(out)
    return joined.astype(np.int64).astype(object) if exact else joined


def _decimals(values) -> pa.Array:
    return pa.array([Decimal(int(v)) for v in values], _NUMBER)


@dataclass(frozen=True)
class Moments:
    """How many rows, the sums of their integers by dimension, and n*n times their covariance."""

    n: int
    sums: list[int]
    scatter: list[list[int]]

    def covariance(self) -> np.ndarray:
        """Each entry is the exact quotient, rounded once."""
        square = self.n * self.n
        return np.array([[v / square for v in row] for row in self.scatter])


def moments(vectors: DataFrame, width: int, scale: float, shift: int) -> Moments | None:
    """Exact moments of the usable vectors, by two scans; None without any."""

    def add(batches):
        n, total = 0, [0] * width
        for _, found in matrices(batches, "embedding", width):
            n += len(found)
            total = [a + b for a, b in zip(total, column_sums(whole(found, scale, shift)))]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array([n] * width), _decimals(total)],
                names=["i", "n", "total"],
            )

    added = vectors.mapInArrow(add, "i int, n long, total decimal(38,0)")
    added = added.groupBy("i").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    rows = {r.i: r for r in added.collect()}
    if not rows:
        return None
    n, sums = rows[0].n, [int(rows[i].total) for i in range(width)]
    centre = np.array([s // n for s in sums], np.int64)
    rest = [s - n * int(c) for s, c in zip(sums, centre, strict=True)]

    def squares(batches):
        total = np.zeros(width * (width + 1) // 2, object)
        for _, found in matrices(batches, "embedding", width):
            total = total + square_sums(whole(found, scale, shift) - centre)
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int64()), _decimals(total)], names=["k", "total"]
            )

    squared = vectors.mapInArrow(squares, "k long, total decimal(38,0)")
    squared = squared.groupBy("k").agg(F.sum("total").alias("total"))
    total = {r.k: int(r.total) for r in squared.collect()}
    # n * sum(z^2) - (sum z)^2 is n*n times the variance; of a pair, of its sum.
    scatter = [[0] * width for _ in range(width)]
    pairs, k = {}, 0
    for i in range(width):
        scatter[i][i] = n * total.get(k, 0) - rest[i] ** 2
        for j in range(i + 1, width):
            pairs[i, j] = n * total.get(k + j - i, 0) - (rest[i] + rest[j]) ** 2
        k += width - i
    for (i, j), both in pairs.items():
        scatter[i][j] = scatter[j][i] = (both - scatter[i][i] - scatter[j][j]) // 2
    return Moments(n, sums, scatter)


@dataclass(frozen=True)
class Whitener:
    """Components by falling variance: what a row is projected on, and what they explain."""

    moments: Moments
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray

    def project(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on the components over the root of their variance; nan without variance."""
        n = self.moments.n
        centre = np.array([s // n for s in self.moments.sums], np.int64)
        rest = np.array([(s % n) / n for s in self.moments.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            scaled = np.where(self.values > 0, self.vectors / np.sqrt(self.values), np.nan)
        return ((x - centre).astype(np.float64) - rest) @ scaled


def fit(found: Moments, components: int) -> Whitener:
    """Unit eigenvectors of the covariance, the largest entry of each positive."""
    covariance = found.covariance()
    values, basis = np.linalg.eigh(covariance)
    values, basis = values[::-1][:components].copy(), basis[:, ::-1][:, :components]
    signs = np.sign(basis[np.abs(basis).argmax(axis=0), np.arange(basis.shape[1])])
    square = found.n * found.n
    trace = sum(found.scatter[i][i] for i in range(len(found.sums))) / square
    values[values <= _NO_VARIANCE * max(trace, 1e-300)] = 0.0
    return Whitener(found, basis * signs, values, values / trace if trace else values * 0.0)


def deviations(x: np.ndarray, found: Moments) -> pa.Array:
    """sum((n*x - S)^2) of each row, exact."""
    centre = [s // found.n for s in found.sums]
    rest = [s % found.n for s in found.sums]
    z = x - np.array(centre, np.int64)
    largest = found.n * (int(np.abs(z).max(initial=0)) + 1)
    if largest**2 * len(rest) < 1 << 63:
        d = z * found.n - np.array(rest, np.int64)
        return pa.array((d * d).sum(axis=1)).cast(_NUMBER)
    d = z.astype(object) * found.n - np.array(rest, object)
    return _decimals((d**2).sum(axis=1))


def _identity_error(projected: DataFrame, n: int, usable: np.ndarray) -> float:
    """Largest entry of the projections' covariance less the identity, over usable components."""
    places = np.flatnonzero(usable).tolist()
    if not places:
        return 0.0
    cells = [F.col("w")[a] for a in places]
    products = [F.col("w")[a] * F.col("w")[b] for a in places for b in places]
    sums = projected.agg(*[F.sum(c) for c in cells + products]).first()
    mean = np.array(sums[: len(places)], float) / n
    second = np.array(sums[len(places) :], float).reshape(len(places), -1) / n
    return float(np.abs(second - np.outer(mean, mean) - np.eye(len(places))).max())


def whiten(
    vectors: DataFrame, components: int = 8, scale: float = 1024.0, shift: int = 100_000
) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    A row for every usable row of ``vectors`` (vec_id, embedding) and each of the first
    ``components`` components, numbered from 1.
    """
    vectors = vectors.select(F.col("vec_id").cast("long"), "embedding")
    width = width_of(vectors, "embedding")
    found = moments(vectors, width, scale, shift) if width else None
    if found is None:
        return empty_frame(vectors.sparkSession, vectors.sparkSession.createDataFrame([], OUTPUT).schema)
    whitener = fit(found, components)
    shared = vectors.sparkSession.sparkContext.broadcast(whitener)

    def project(batches):
        own = shared.value
        for rows, values in matrices(batches, "embedding", width):
            x = whole(values, scale, shift)
            w = own.project(x)
            flat = pa.array(w.ravel(), pa.float64(), mask=np.isnan(w).ravel())
            ends = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [rows.column("vec_id"), deviations(x, own.moments),
                 pa.ListArray.from_arrays(ends, flat)],
                names=["vec_id", "deviation", "w"],
            )

    projected = vectors.mapInArrow(
        project, "vec_id long, deviation decimal(38,0), w array<double>"
    )
    error = _identity_error(projected, found.n, whitener.values > 0)
    explained = F.array(*[F.lit(float(e)) for e in whitener.explained])
    return projected.select("vec_id", "deviation", F.posexplode("w").alias("k", "whitened")).select(
        "vec_id",
        (F.col("k") + 1).alias("component"),
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("k")].alias("explained"),
        F.lit(error).alias("identity_error"),
    )
