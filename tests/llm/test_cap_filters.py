"""Links, counts and classes against all cosines, and the recall of the filters."""

import faulthandler

import numpy as np
import pytest

from shopgrain.llm.cap_filters import Codes, by_length, cap_share, near_vectors, units_of

DATA = "/root/testdata"


def brute(rows):
    """n_links and component per row, over all pairs."""
    n = len(rows)
    usable = [
        v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for _, v in rows
    ]
    link = np.zeros((n, n), dtype=bool)
    for d in {len(v) for (_, v), u in zip(rows, usable, strict=True) if u}:
        at = [i for i in range(n) if usable[i] and len(rows[i][1]) == d]
        x = np.array([rows[i][1] for i in at], dtype=np.float64)
        norm = np.linalg.norm(x / np.abs(x).max(1, keepdims=True), axis=1, keepdims=True)
        x = x / np.abs(x).max(1, keepdims=True) / norm
        link[np.ix_(at, at)] = x @ x.T >= 0.9
    np.fill_diagonal(link, False)
    root = list(range(n))
    for i in range(n):
        for j in np.flatnonzero(link[i]):
            a, b = root[i], root[j]
            if a != b:
                root = [min(a, b) if r in (a, b) else r for r in root]
    out = []
    for i in range(n):
        ids = [rows[k][0] for k in range(n) if root[k] == root[i] and rows[k][0] is not None]
        component = min(ids, default=None)
        out.append((rows[i][0], int(link[i].sum()), component, rows[i][0] == component))
    return sorted(out, key=repr)


def clustered(rng, n, dim, centers, spread):
    c = rng.standard_normal((centers, dim))
    c /= np.linalg.norm(c, axis=1, keepdims=True)
    x = c[rng.integers(0, centers, n)] + spread * rng.standard_normal((n, dim)) / np.sqrt(dim)
    return x.astype(np.float32)


@pytest.mark.parametrize(("dim", "count"), [(64, 5_000), (64, 1_000_000), (16, 2_000), (384, 50_000)])
def test_decoding_equals_enumeration_and_neighbours_share_filters(dim, count):
    rng = np.random.default_rng(dim)
    codes = Codes(dim, count)
    x = units_of(rng.standard_normal((300, dim)))
    away = units_of(rng.standard_normal((300, dim)))
    away = units_of(away - (away * x).sum(1, keepdims=True) * x)
    y = 0.9 * x + np.sqrt(1 - 0.81) * away
    assert np.allclose((x * y).sum(1), 0.9)
    rx, fx = codes.decode(x)
    ry, fy = codes.decode(y)
    if len(codes.cuts) == 3 and codes.size < 700:
        expected = []
        for t, (rotation, (one, two)) in enumerate(codes.turns):
            a, b = np.split(x[:5] @ rotation, [codes.cuts[1]], axis=1)
            scores = (a @ one.T)[:, :, None] + (b @ two.T)[:, None, :]
            row, i, j = np.nonzero(scores >= codes.height)
            names = (t * codes.size + i) * codes.size + j
            expected += zip(row.tolist(), names.tolist(), strict=True)
        found = zip(rx.tolist(), fx.tolist(), strict=True)
        assert sorted(expected) == sorted((r, f) for r, f in found if r < 5)
    shared = [bool(set(fx[rx == i]) & set(fy[ry == i])) for i in range(300)]
    assert np.mean(shared) >= 0.95


@pytest.mark.parametrize("count", [1_000_000, 1_000_000_000])
@pytest.mark.parametrize("dim", [1, 2, 3, 8, 12, 16])
def test_short_vectors_reach_filters_of_large_tables(dim, count):
    faulthandler.dump_traceback_later(60, exit=True)
    rng = np.random.default_rng(dim)
    codes = Codes(dim, count)
    x = units_of(rng.standard_normal((300, dim)))
    y = x
    if dim > 1:
        away = units_of(rng.standard_normal((300, dim)))
        away = units_of(away - (away * x).sum(1, keepdims=True) * x)
        y = 0.9 * x + np.sqrt(1 - 0.81) * away
    (rx, fx), (ry, fy) = codes.decode(x), codes.decode(y)
    faulthandler.cancel_dump_traceback_later()
    assert np.mean([bool(set(fx[rx == i]) & set(fy[ry == i])) for i in range(300)]) >= 0.95
    assert len(rx) < 300 * 1000


def test_cap_share():
    assert cap_share(1, 0.8) == 0.5
    assert cap_share(2, 0.5) == pytest.approx(1 / 3, abs=1e-3)
    assert cap_share(3, 0.8) == pytest.approx(0.1, abs=1e-3)


def test_short_vectors_link_beside_many_long_ones(spark, monkeypatch):
    """Short ones of all lengths, as if there were a million vectors."""
    from shopgrain.llm import cap_filters

    monkeypatch.setattr(cap_filters, "linked_vectors", lambda v: linked_as_many(v, 1_000_000))
    rows = [
        (1, [1.0]), (2, [2.0]), (3, [-1.0]), (4, [1.0, 1.0]), (5, [3.0, 2.9]), (6, [1.0, -1.0]),
        (7, [1.0] * 8), (8, [1.0] * 7 + [1.1]), (9, [1.0, -1.0] * 4), (10, [0.5] * 16), (11, [0.5] * 15 + [0.6]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted(map(tuple, near_vectors(df, "vec_id", "embedding").collect()), key=repr)
    assert got == brute(rows)


def linked_as_many(vectors, count):
    from shopgrain.llm.cap_filters import FOUND, compare, filters, tiled

    keys = ["filter", "dim", "a", "b"]
    gathered = tiled(filters(vectors, count)).repartition(*keys).sortWithinPartitions(*keys)
    return gathered.select([*keys, "tile", "rep", "copies", "vector"]).mapInArrow(compare(count), FOUND)


def test_whole_table_recall(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet").collect()]
    df = spark.read.parquet(f"{DATA}/sf0.1/embeddings.parquet")
    got = sorted(map(tuple, near_vectors(df, "vec_id", "embedding").collect()), key=repr)
    expected = brute(rows)
    assert [g[0] for g in got] == [e[0] for e in expected]
    assert all(g[1] <= e[1] for g, e in zip(got, expected, strict=True))
    assert sum(g[1] for g in got) >= 0.98 * sum(e[1] for e in expected)
    assert np.mean([g == e for g, e in zip(got, expected, strict=True)]) >= 0.98


def test_large_filters_are_tiled(spark, monkeypatch):
    monkeypatch.setattr("shopgrain.llm.cap_filters.TILE", 40)
    rng = np.random.default_rng(3)
    x = clustered(rng, 300, 32, 3, 0.2)
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(map(tuple, near_vectors(df, "vec_id", "embedding").collect()), key=repr)
    expected = brute(rows)
    assert sum(g[1] for g in got) >= 0.99 * sum(e[1] for e in expected)
    assert [g[2] for g in got] == [e[2] for e in expected]


def test_edge_rows(spark):
    """Unusable vectors, equal and scaled ones, other lengths, repeated rows, no rows."""
    nan, inf = float("nan"), float("inf")
    base = [0.5, -1.0, 2.0, 0.25] * 4
    rows = [
        (5, base), (9, base), (9, base), (2, [2 * x for x in base]), (None, base), (None, [1.0] * 16),
        (11, None), (12, []), (13, [0.0] * 16), (14, [nan] + base[1:]), (15, [inf] + base[1:]),
        (16, [None] + base[1:]), (17, base[:8]), (18, [3e38] * 16), (19, [1e-44] * 16), (20, [-0.0] * 16),
    ]
    schema = "vec_id long, embedding array<float>, n_links int, rep string"
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], schema)
    got = sorted(map(tuple, near_vectors(df, "vec_id", "embedding").collect()), key=repr)
    assert got == brute(rows)
    assert near_vectors(df.limit(0), "vec_id", "embedding").count() == 0


def test_by_length():
    import pyarrow as pa

    lists = pa.array([[1.0, 2.0], [3.0], [4.0, 5.0]]).slice(1)
    found = {tuple(rows.tolist()): values.tolist() for rows, values in by_length(lists)}
    assert found == {(0,): [[3.0]], (1,): [[4.0, 5.0]]}
