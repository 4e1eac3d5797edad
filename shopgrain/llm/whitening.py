"""Whitening of vectors along the leading components of their covariance.

Sums are exact integers, gathered per task and added in Spark. The covariance is centred
before it is multiplied: a task adds up the products of its centred rows and sends one
matrix, row by row, and Spark adds those in two steps, so no group holds more than a
fixed part of the tasks' matrices. What reaches the driver is one matrix whose size is
given by the vectors' length. There it is made tridiagonal by Householder reflections,
Sturm counts bisect for the largest eigenvalues, and inverse iteration finds their
vectors, orthogonalised anew within clusters of close eigenvalues. Means and components
go out to the tasks, which project their rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopgrain.plans.saving import saved

from .arrow import slices

COMPONENTS = 8
#: Fixed point of the components: x = floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Components at least this large have no fixed point that a long can hold.
LARGEST = float(2**52)
#: Smaller eigenvalues, relative to the largest, are rounding errors in double precision.
NOISE = 1e-11
#: Eigenvalues closer than this, relative to the largest, have their vectors orthogonalised.
CLUSTER = 1e-3
#: Rows turned into a matrix at once, groups that the matrices of all tasks are first added in.
STEP, GROUPS = 1024, 256
SEED = 11


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal, off-diagonal and the reflections that bring a symmetric matrix there."""
    a = np.array(matrix, dtype=np.float64)
    reflections = []
    for k in range(len(a) - 2):
        column = a[k + 1 :, k].copy()
        length = np.linalg.norm(column)
        column[0] += math.copysign(length, column[0])
        norm = np.linalg.norm(column)
        v = column / norm if norm else column
        reflections.append(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = p - (v @ p) * v
        rest -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1, k] = a[k, k + 1] = -math.copysign(length, column[0]) if norm else 0.0
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(diagonal: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """How many eigenvalues lie below each shift: the negative pivots of a Sturm sequence."""
    least = np.finfo(float).tiny * 2**60
    squares = np.concatenate(([0.0], off**2))
    pivot, count = np.ones(len(shifts)), np.zeros(len(shifts), dtype=int)
    for d, square in zip(diagonal, squares, strict=True):
        pivot = d - shifts - square / pivot
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        count += pivot < 0
    return count


def largest_values(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> np.ndarray:
    """The largest eigenvalues, falling, each by bisection down to neighbouring doubles."""
    n = len(diagonal)
    around = np.concatenate(([0.0], np.abs(off))) + np.concatenate((np.abs(off), [0.0]))
    low = np.full(wanted, (diagonal - around).min())
    high = np.full(wanted, (diagonal + around).max())
    pad = np.abs(np.concatenate((low, high))).max() * 1e-15 + np.finfo(float).tiny
    low, high = low - pad, high + pad
    rank = n - 1 - np.arange(wanted)
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high)).all():
            return middle
        more = below(diagonal, off, middle) <= rank
        low, high = np.where(more, middle, low), np.where(more, high, middle)


def solved(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray) -> np.ndarray:
    """(T - shift) y = b by elimination with row exchanges; zero pivots become tiny ones."""
    n = len(diagonal)
    least = np.finfo(float).eps * max(np.abs(diagonal).max(), np.abs(off).max(initial=0.0), 1e-300)
    rows = [[d - shift, e, 0.0] for d, e in zip(diagonal.tolist(), [*off.tolist(), 0.0])]
    y = b.tolist()
    for k in range(n - 1):
        under = [float(off[k]), rows[k + 1][0], rows[k + 1][1]]
        if abs(under[0]) > abs(rows[k][0]):
            rows[k], under = under, rows[k]
            y[k], y[k + 1] = y[k + 1], y[k]
        if not rows[k][0]:
            rows[k][0] = least
        factor = under[0] / rows[k][0]
        rows[k + 1] = [under[1] - factor * rows[k][1], under[2] - factor * rows[k][2], 0.0]
        y[k + 1] -= factor * y[k]
    for k in reversed(range(n)):
        if abs(rows[k][0]) < least:
            rows[k][0] = math.copysign(least, rows[k][0])
        if k + 1 < n:
            y[k] -= rows[k][1] * y[k + 1]
        if k + 2 < n:
            y[k] -= rows[k][2] * y[k + 2]
        y[k] /= rows[k][0]
        if abs(y[k]) > 1e100:
            y = [v * 1e-100 for v in y]
    return np.array(y)


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and unit vectors as columns.

    A vector's largest entry in size, the first of equals, is positive.
    """
    diagonal, off, reflections = tridiagonal(matrix)
    n = len(diagonal)
    values = largest_values(diagonal, off, min(wanted, n))
    top = max(np.abs(values).max(initial=0.0), np.finfo(float).tiny)
    rng = np.random.default_rng(SEED)
    vectors = np.zeros((n, len(values)))
    shift = math.inf
    for k, value in enumerate(values.tolist()):
        # Equal shifts would find the same vector again.
        shift = min(value, shift - 4 * np.finfo(float).eps * top)
        close = [j for j in range(k) if values[j] - value <= CLUSTER * top]
        y = rng.standard_normal(n)
        for _ in range(4):
            y = solved(diagonal, off, shift, y)
            y /= np.abs(y).max()
            y /= np.linalg.norm(y)
            # What is left of a vector in the span of the others is mostly rounding.
            for _ in range(3 if close else 0):
                y -= vectors[:, close] @ (vectors[:, close].T @ y)
                y /= np.linalg.norm(y)
        vectors[:, k] = y
    for k in reversed(range(len(reflections))):
        v = reflections[k]
        vectors[k + 1 :] -= 2 * np.outer(v, v @ vectors[k + 1 :])
    vectors /= np.linalg.norm(vectors, axis=0)
    at = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[at, np.arange(len(values))])


def usable(vector: Column) -> Column:
    """Vectors whose entries are all there, finite and small enough for a fixed point."""
    held = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & held, F.lit(False))


def fixed(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """The vectors of a batch as whole numbers, a row each."""
    values = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * values.reshape(-1, dim)).astype(np.int64) + SHIFT


def exact_sums(vectors: DataFrame, dim: int) -> list[int]:
    """The sum of all fixed-point vectors per entry."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * dim
        for part in slices(batches, STEP):
            x = fixed(part.select(["vector"]), dim)
            high, low = (x >> 31).sum(axis=0).tolist(), (x & (2**31 - 1)).sum(axis=0).tolist()
            total = [t + (h << 31) + s for t, h, s in zip(total, high, low, strict=True)]
        if any(total):
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dim), pa.int32()), pa.array([str(t) for t in total])],
                names=["entry", "total"],
            )

    parts = vectors.mapInArrow(run, "entry int, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)")).alias("total")
    found = {r["entry"]: int(r["total"]) for r in parts.groupBy("entry").agg(total).collect()}
    return [found.get(i, 0) for i in range(dim)]


def added(rows: DataFrame, *keys: str) -> DataFrame:
    """The sum of ``row`` over ``part`` per ``keys``, in the order of ``part``."""
    parts = F.sort_array(F.collect_list(F.struct("part", "row")))
    total = F.aggregate(
        F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))),
        parts[0]["row"],
        lambda total, p: F.zip_with(total, p["row"], lambda a, b: a + b),
    )
    return rows.groupBy(*keys).agg(parts[0]["part"].alias("part"), total.alias("row"))


def covariance(vectors: DataFrame, mean: np.ndarray, n: int) -> np.ndarray:
    """The covariance around ``mean``, with ``n`` as its divisor."""
    dim = len(mean)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for part in slices(batches, STEP):
            centred = fixed(part, dim) - mean
            total += centred.T @ centred
        part = np.full(dim, TaskContext.get().partitionId())
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(np.arange(dim)), pa.array(list(total))],
                names=["part", "entry", "row"],
            )

    parts = vectors.mapInArrow(run, "part bigint, entry bigint, row array<double>")
    parts = parts.withColumn("group", F.col("part") % GROUPS)
    rows = added(added(parts, "entry", "group"), "entry").collect()
    total = np.zeros((dim, dim))
    for row in rows:
        total[row["entry"]] = row["row"]
    return (total + total.T) / 2 / n


@dataclass
class Whitening:
    """What is fitted: count and exact sums of the fit list, its components and variances."""

    n: int
    sums: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2 per row, exact; none where a long cannot hold it."""
        rough = self.n * np.abs(x - self.mean) + 1
        if (rough**2).sum(axis=1).max(initial=0.0) < 2.0**62 and np.abs(x).max(
            initial=0
        ) * float(self.n) < 2.0**62:
            away = self.n * x - np.array(self.sums, dtype=np.int64)
            return (away * away).sum(axis=1).tolist()
        sums = [
            sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True))
            for row in x.tolist()
        ]
        return [s if s < 2**63 else None for s in sums]

    def apply(self, vectors: DataFrame, vec_id: str) -> DataFrame:
        """``vec_id, deviation, whitened`` of usable vectors of the fitted length."""
        dim, mean = len(self.sums), self.mean
        turn = self.components / np.sqrt(self.values)

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in slices(batches, STEP):
                x = fixed(part, dim)
                whitened = (x - mean) @ turn
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        pa.array(self.deviations(x), pa.int64()),
                        pa.array(list(whitened), pa.list_(pa.float64())),
                    ],
                    names=["id", "deviation", "whitened"],
                )

        kind = vectors.schema[vec_id].dataType.simpleString()
        given = vectors.select(F.col(vec_id).alias("id"), "vector")
        return given.mapInArrow(run, f"id {kind}, deviation bigint, whitened array<double>")


def fit(vectors: DataFrame, dim: int, n: int, wanted: int = COMPONENTS) -> Whitening:
    """Components of ``n`` rows of ``vector``, all usable and of length ``dim``."""
    only = vectors.select("vector")
    sums = exact_sums(only, dim)
    v = covariance(only, np.array([s / n for s in sums]), n)
    values, components = leading(v, wanted)
    real = values > max(NOISE * values.max(initial=0.0), 0.0)
    return Whitening(n, sums, values[real], components[:, real], float(np.trace(v)))


def identity_error(whitened: DataFrame, wanted: int) -> float:
    """How far the covariance of ``whitened`` is from the identity, at most."""
    entry = [F.get("whitened", F.lit(i)) for i in range(wanted)]
    mean = whitened.agg(*(F.avg(e) for e in entry)).first()
    centred = [e - m for e, m in zip(entry, mean, strict=True)]
    pairs = [(i, j) for i in range(wanted) for j in range(i + 1)]
    found = whitened.agg(*(F.avg(centred[i] * centred[j]) for i, j in pairs)).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(found, pairs, strict=True))


def whitened_rows(
    df: DataFrame, vec_id: str, embedding: str, wanted: int = COMPONENTS
) -> DataFrame:
    """A row per usable vector and component, with the whitened value.

    Vectors that are null or empty, or hold null or non-finite entries or entries of
    2^52 and more, are left out, and so are those of another length than the most
    frequent one (the longer of equally frequent ones): they have no covariance with the
    others. Repeated rows and null ids count and stay. ``deviation`` is null where a long
    cannot hold it. Components whose variance is no more than rounding errors do not
    exist, so equal rows alone, or a single one, give no rows, like an empty table.
    """
    vector = df[embedding].cast("array<double>")
    rows = df.select(df[vec_id].alias("id"), vector.alias("vector")).where(usable(vector))
    length = F.size("vector").alias("length")
    usual = rows.groupBy(length).count().orderBy(F.desc("count"), F.desc("length")).first()
    names = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
    kinds = ["int", "bigint", "bigint", "double", "double", "double"]
    nothing = rows.where(F.lit(False)).select(
        F.col("id").alias(vec_id),
        *(F.lit(None).cast(k).alias(c) for c, k in zip(names, kinds, strict=True)),
    )
    if usual is None:
        return nothing
    rows = rows.where(F.size("vector") == usual["length"])
    model = fit(rows, usual["length"], usual["count"], wanted)
    if not len(model.values):
        return nothing
    whitened = saved(model.apply(rows, "id"), "whitened")
    error = identity_error(whitened, len(model.values))
    shares = F.array(*(F.lit(float(v / model.trace)) for v in model.values))
    each = whitened.select(
        "id", "deviation", F.posexplode("whitened").alias("at", "whitened")
    )
    return each.select(
        F.col("id").alias(vec_id),
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )
