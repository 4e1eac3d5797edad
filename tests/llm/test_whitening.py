"""Eigenpairs, exact sums and whitened rows against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import whitening
from shopgrain.llm.whitening import below, leading, tridiagonal, whitened_rows

SCHEMA = "vec_id long, embedding array<double>"


def matrices():
    rng = np.random.default_rng(3)
    for n in (1, 2, 3, 5, 40, 150):
        a = rng.standard_normal((n, n))
        yield a @ a.T
        yield np.eye(n)
        yield np.diag(np.arange(n) * 1.0)
        yield np.ones((n, n)) + np.eye(n)
        yield 5 * np.eye(n) + 1e-9 * (a + a.T)
        yield (a @ a.T) * 1e12


@pytest.mark.parametrize("matrix", list(matrices()))
def test_eigenpairs(matrix):
    values, vectors = leading(matrix, 8)
    scale = max(np.abs(values).max(), 1e-290)
    want = np.linalg.eigvalsh(matrix)[::-1][:8]
    assert len(values) == min(8, len(matrix))
    assert np.abs(values - want).max() <= 1e-13 * scale + 1e-290
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * scale + 1e-290
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-12


def test_sturm_counts():
    a = np.random.default_rng(5).standard_normal((30, 30))
    diagonal, off, _ = tridiagonal(a + a.T)
    shifts = np.linspace(-12, 12, 50)
    want = [(np.linalg.eigvalsh(a + a.T) < s).sum() for s in shifts]
    assert below(diagonal, off, shifts).tolist() == want


def expected(rows, wanted=8):
    """n, sums, and per row its id, deviation and whitened values up to their signs."""
    good = [
        (i, v)
        for i, v in rows
        if v is not None
        and len(v)
        and all(c is not None and math.isfinite(c) and abs(c) < 2**52 for c in v)
    ]
    lengths = [len(v) for _, v in good]
    dim = max(set(lengths), key=lambda d: (lengths.count(d), d))
    good = [(i, [math.floor(1024 * c) + 100_000 for c in v]) for i, v in good if len(v) == dim]
    n = len(good)
    sums = [sum(x[k] for _, x in good) for k in range(dim)]
    centred = np.array([[c - s / n for c, s in zip(x, sums)] for _, x in good])
    v = centred.T @ centred / n
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    real = values > 1e-11 * values[0]
    projected = centred @ vectors[:, real] / np.sqrt(values[real])
    away = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in good]
    return n, [i for i, _ in good], away, projected, values[real] / np.trace(v)


def check(rows, df):
    got = whitened_rows(df, "vec_id", "embedding").collect()
    n, ids, away, projected, explained = expected(rows)
    assert len(got) == n * projected.shape[1] and {r.n for r in got} == {n}
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error <= 1e-4
    assert {r.component for r in got} == set(range(1, len(explained) + 1))
    for k, share in enumerate(explained):
        of = [r for r in got if r.component == k + 1]
        assert {round(r.explained / share, 9) for r in of} == {1.0}
        key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0, r[2])
        mine = sorted(((r.vec_id, r.deviation, r.whitened) for r in of), key=key)
        size = [d if d < 2**63 else None for d in away]
        fits = []
        for sign in (1, -1):
            plain = sorted(zip(ids, size, (sign * projected[:, k]).tolist()), key=key)
            assert [p[:2] for p in plain] == [m[:2] for m in mine]
            fits.append(np.allclose([p[2] for p in plain], [m[2] for m in mine], atol=1e-7))
        assert any(fits)


def test_rows_of_every_kind(spark):
    rng = np.random.default_rng(1)
    spread = np.linspace(3, 0.2, 12)
    rows = [(i, (rng.standard_normal(12) * spread).tolist()) for i in range(300)]
    rows += [(3, [9.0] * 12)] * 150
    rows += [(None, [-1.5] * 12), (400, [0.0] * 12), (401, [-0.0] * 12)]
    bad = [(500, None), (501, []), (502, [None] + [1.0] * 11), (503, [float("nan")] * 12)]
    bad += [(504, [float("inf")] * 12), (505, [1e300] * 12), (506, [1.0] * 5), (507, [2.0] * 13)]
    df = spark.createDataFrame(rows + bad, SCHEMA).repartition(6)
    for name in ("id", "vector", "whitened", "n", "part", "row", "at"):
        df = df.withColumn(name, F.lit("clash"))
    check(rows + bad, df)


def test_floats_and_few_entries(spark):
    rng = np.random.default_rng(2)
    vectors = rng.standard_normal((200, 3)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check(rows, df)


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(c) for c in rng.integers(-(2**44), 2**44, 4)]) for i in range(50)]
    rows += [(i, [float(c) for c in rng.integers(-(2**19), 2**19, 4)]) for i in range(50, 100)]
    check(rows, spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 5])
def test_nothing_to_whiten(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    assert whitened_rows(df, "vec_id", "embedding").collect() == []


def test_directions_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0, float(i % 5)]) for i in range(60)]
    check(rows, spark.createDataFrame(rows, SCHEMA))


def test_many_parts_are_added_in_two_steps(spark, monkeypatch):
    monkeypatch.setattr(whitening, "GROUPS", 3)
    rng = np.random.default_rng(6)
    rows = [(i, rng.standard_normal(5).tolist()) for i in range(200)]
    check(rows, spark.createDataFrame(rows, SCHEMA).repartition(17))


def test_given_vectors(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    check([(r.vec_id, r.embedding) for r in df.collect()], df)
