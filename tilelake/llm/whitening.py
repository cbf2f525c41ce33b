"""Whitening of embeddings by principal components, from a covariance in two passes.

Entries become integers, ``x = floor(scale * c) + shift``, so the first pass sums them exactly, whatever the order of
tasks. The second pass centres each vector at the exact mean and adds up outer products, a matrix product for each
slice of rows; ``treeAggregate`` merges the tasks' sums, so the driver gets a few of them. LAPACK's symmetric solver
gives the components, and the projection (components x dimensions) goes to the tasks by broadcast. A third pass takes
the covariance of the whitened values themselves, before a last one returns them.

What the driver holds and broadcasts is d x d and k x d doubles for vectors of d entries, whatever the number of rows.

Defined cases: rows whose vector is null or holds null or non-finite entries go. Vectors of different lengths are
fitted apart, each length as a list of its own; an empty vector has no component and so no row. ``whitened`` is null
for a component without variance (a share of the largest eigenvalue under ``FLAT``), and the identity is held against
the others. Entries beyond 2^52 / scale in size count as that; a ``deviation`` of over 38 digits is null. Repeated rows
count as often as they come, null ids stay, an empty table gives no rows, other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

#: Entries of vectors turned at a time in a task, and the least eigenvalue that counts, as a share of the largest.
AT_A_TIME, FLAT = 1 << 20, 1e-12
SCALE, SHIFT, COMPONENTS, DIGITS = 64, 1_000_000, 32, 10**38


def vectors(col: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of doubles) of the usable vectors of a list column, of one length and about ``AT_A_TIME`` entries each."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    sizes = np.asarray(col.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), np.int64)
    flat = np.asarray(col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False), np.float64)
    first = np.cumsum(sizes) - sizes
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    good = (bad[first + sizes] == bad[first]) & (sizes > 0)
    for d in np.unique(sizes[good]).tolist():
        rows = np.flatnonzero(good & (sizes == d))
        step = max(1, AT_A_TIME // d)
        for lo in range(0, len(rows), step):
            part = rows[lo : lo + step]
            yield part, flat[first[part][:, None] + np.arange(d)]


def integers(c: np.ndarray, scale: float = SCALE, shift: int = SHIFT) -> np.ndarray:
    return np.clip(np.floor(scale * c), -(2.0**52), 2.0**52).astype(np.int64) + shift


def exact_sum(x: np.ndarray) -> list[int]:
    """Sums of columns as Python's integers: halves of 32 bits are added up apart, so nothing overflows."""
    low, high = x & 0xFFFFFFFF, x >> 32
    return [(int(h) << 32) + int(v) for h, v in zip(high.sum(axis=0), low.sum(axis=0))]


class Mean:
    """The exact mean of n integer vectors with sums S, as whole part and remainder."""

    def __init__(self, n: int, sums: list[int]):
        self.n = n
        self.whole = np.array([s // n for s in sums], np.int64)
        self.rest = [s % n for s in sums]
        self.part = np.array([r / n for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the difference of integers is exact, so rounding is that of the last step only."""
        return (x - self.whole) - self.part

    def deviation(self, x: np.ndarray) -> list[int]:
        """Sums over dimensions of (n x - S)^2, exact."""
        off = x - self.whole
        most = int(np.abs(off).max(initial=0)) * self.n + self.n
        if most * most * x.shape[1] < 1 << 63:
            return ((self.n * off - np.array(self.rest, np.int64)) ** 2).sum(axis=1).tolist()
        return ((self.n * off.astype(object) - np.array(self.rest, object)) ** 2).sum(axis=1).tolist()


def _gathered(rows: DataFrame, of, merged) -> dict:
    """For each length of vectors the merged partial results of all tasks: of(matrix) gives one, merged(a, b) adds two."""

    def run(batches):
        found: dict = {}
        for b in batches:
            for _, c in vectors(b.column(0)):
                _add(found, {c.shape[1]: of(c)}, merged)
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(found)], pa.binary())], names=["part"])

    parts = rows.mapInArrow(run, "part binary").rdd
    return parts.treeAggregate({}, lambda out, r: _add(out, pickle.loads(r[0]), merged), lambda a, b: _add(a, b, merged), 2)


def _add(out: dict, more: dict, merged) -> dict:
    for d, v in more.items():
        out[d] = merged(out[d], v) if d in out else v
    return out


class Projection:
    """Mean, components and eigenvalues of vectors of one length."""

    def __init__(self, mean: Mean, cov: np.ndarray, components: int):
        values, axes = np.linalg.eigh(cov)
        order = np.argsort(-values, kind="stable")[:components]
        self.mean, self.values, self.axes = mean, np.maximum(values[order], 0), axes[:, order].T.copy()
        self.axes *= np.where(self.axes[np.arange(len(order)), np.abs(self.axes).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
        trace = float(np.trace(cov))
        self.explained = self.values / trace if trace > 0 else np.zeros(len(order))
        self.firm = self.values > FLAT * max(float(values[-1]), 0.0)
        self.error = 0.0

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.mean.centred(x) @ self.axes.T / np.sqrt(np.where(self.firm, self.values, np.nan))


def fit(rows: DataFrame, col: str = "embedding", components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT) -> dict[int, Projection]:
    """A projection for each length of vectors, with the largest entry by which its whitened covariance misses the identity."""
    rows = rows.select(F.col(col).cast("array<double>"))
    sums = _gathered(rows, lambda c: (len(c), exact_sum(integers(c, scale, shift))), lambda a, b: (a[0] + b[0], [p + q for p, q in zip(a[1], b[1])]))
    means = {d: Mean(n, s) for d, (n, s) in sums.items()}
    spark = rows.sparkSession
    held = spark.sparkContext.broadcast(means)

    def outer(c: np.ndarray) -> np.ndarray:
        y = held.value[c.shape[1]].centred(integers(c, scale, shift))
        return y.T @ y

    found = {d: Projection(means[d], v / means[d].n, components) for d, v in _gathered(rows, outer, np.add).items()}
    turned = spark.sparkContext.broadcast(found)

    def again(c: np.ndarray) -> np.ndarray:
        p = turned.value[c.shape[1]]
        z = p(integers(c, scale, shift))[:, p.firm]  # sums to nothing, since the centred vectors do
        return z.T @ z

    for d, v in _gathered(rows, again, np.add).items():
        found[d].error = float(np.abs(v / means[d].n - np.eye(len(v))).max(initial=0.0))
    held.destroy()
    turned.destroy()
    return found


def whitened(rows: DataFrame, id_col: str = "vec_id", col: str = "embedding", components: int = COMPONENTS, scale: float = SCALE, shift: int = SHIFT) -> DataFrame:
    """A row for each vector and component: id, component (from 1), n, deviation, whitened, explained, identity_error."""
    found = fit(rows, col, components, scale, shift)
    held = rows.sparkSession.sparkContext.broadcast(found)
    own = rows.select(F.col(id_col).alias("id"), F.col(col).cast("array<double>").alias("v"))

    def run(batches):
        for b in batches:
            for where, c in vectors(b.column(1)):
                p = held.value[c.shape[1]]
                k = len(p.values)
                step = max(1, AT_A_TIME // (8 * k))
                for lo in range(0, len(where), step):
                    x = integers(c[lo : lo + step], scale, shift)
                    z, m = p(x).ravel(), len(x)
                    ids = b.column(0).take(pa.array(np.repeat(where[lo : lo + step], k)))
                    away = pa.array([Decimal(v) if v < DIGITS else None for v in p.mean.deviation(x)], pa.decimal128(38, 0))
                    cols = [pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, p.mean.n)), away.take(pa.array(np.repeat(np.arange(m), k))), pa.array(z, mask=np.isnan(z)), pa.array(np.tile(p.explained, m)), pa.array(np.full(m * k, p.error))]
                    yield pa.RecordBatch.from_arrays([ids, *cols], names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    schema = T.StructType([T.StructField("id", own.schema["id"].dataType), *T._parse_datatype_string("component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double").fields])
    return own.mapInArrow(run, schema).withColumnRenamed("id", id_col)
