"""Neighbours found through the tree against all cosines."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import kmeans_tree
from shopgrain.llm.kmeans_tree import Tree, fitted, nearest_vectors, units_of

SCHEMA = "vec_id long, embedding array<double>"


def brute(rows, nearest=5, asking=50):
    """(query_id, [(score, id), ...]) for every query row, all candidates compared."""
    good = [
        (i, np.array(v, dtype=float))
        for i, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v) and any(v)
    ]
    unit = [v / np.abs(v).max() for _, v in good]
    unit = [u / np.linalg.norm(u) for u in unit]
    out = []
    for a, (query, v) in enumerate(good):
        if query is None or query % asking:
            continue
        others = [
            (round(float(unit[a] @ unit[b]), 12), i)
            for b, (i, w) in enumerate(good)
            if b != a and len(w) == len(v)
        ]
        others.sort(key=lambda o: (-o[0], o[1] is None, o[1] or 0))
        out.append((query, others[:nearest]))
    return sorted(out, key=repr)


def found(df, **options):
    result = nearest_vectors(df, "vec_id", "embedding", **options)
    assert result.columns == ["query_id", "rank", "vec_id", "score"]
    queries = {}
    for r in sorted(result.collect(), key=lambda r: (r.query_id, r.rank)):
        queries.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    return queries


def check_exact(rows, df):
    """Small tables have one leaf, so everything must be found."""
    got, want = found(df), brute(rows)
    assert sorted(got) == sorted({q for q, near in want if near})
    for query, near in want:
        if near:
            assert [(round(s, 12), i) for _, s, i in got[query]] == near
            assert [r for r, _, _ in got[query]] == list(range(1, len(near) + 1))


def test_rows_of_every_kind(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(0, 300, 10)]
    rows += [(7, [1.0, 2.0, 3.0, 4.0]), (None, [1.0, 2.0, 3.0, 4.0]), (None, [4.0, 3.0, 2.0, 1.0])]
    rows += [(350, [1e300] * 4), (351, [1e-300] * 4), (352, [-0.0, 0.0, 1.0, 0.0])]
    rows += [(400, None), (450, []), (500, [0.0] * 4), (550, [float("nan")] * 4)]
    rows += [(600, [float("inf")] * 4), (650, [None, 1.0, 1.0, 1.0])]
    rows += [(700, [1.0, 1.0]), (701, [1.0, 2.0]), (750, [3.0])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for name in ("id", "rep", "leaf", "vector", "near", "dim", "first"):
        df = df.withColumn(name, F.lit("clash"))
    check_exact(rows, df)


def test_ties_and_copies_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0]) for i in range(0, 2000, 10)]
    rows += [(i, [0.0, 1.0]) for i in range(5, 400, 10)] + [(50, [1.0, 0.0]), (100, [5.0, 5.0])]
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(8))
    alone = brute(rows)
    for query, near in alone:
        if [q for q, _ in alone].count(query) == 1:
            assert [(round(s, 12), i) for _, s, i in got[query]] == near
    # The id 50 is there twice: each of the rows has the other among its neighbours.
    assert [i for _, _, i in got[50]] == [0, 0, 10, 10, 20, 20, 30, 30, 40, 40]


def test_fewer_candidates_than_asked_for(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])]
    check_exact(rows, spark.createDataFrame(rows, SCHEMA))


@pytest.mark.parametrize("rows", [[], [(0, [1.0])], [(1, [1.0]), (2, [1.0])], [(None, None)]])
def test_nothing_to_find(spark, rows):
    assert found(spark.createDataFrame(rows, SCHEMA)) == {}


def test_best_bins_come_first_and_every_leaf_once():
    rng = np.random.default_rng(2)
    units = units_of(rng.standard_normal((2000, 16)))
    tree = fitted(units)
    leaf = tree.leaf_of(units)
    tree.rows = np.bincount(leaf, minlength=tree.leaves)
    assert tree.leaves > 50 and tree.rows.sum() == 2000
    for unit, own in zip(units[:50], leaf[:50]):
        order = list(tree.visits(unit))
        assert sorted(order) == list(range(tree.leaves)) and order[0] == own
    assert len(tree.visited(units[0], 3, 0)) == 3
    wide = tree.visited(units[0], 1, 500)
    assert tree.rows[wide].sum() >= 500 > tree.rows[wide[:-1]].sum()
    assert (np.diff(tree.bins) >= 0).all()


def test_a_sample_of_copies_is_one_leaf():
    tree = fitted(units_of(np.ones((500, 4))))
    assert tree.leaves == 1 and list(tree.visits(np.ones(4))) == [0]
    assert Tree().leaf_of(np.ones((3, 2))).tolist() == [0, 0, 0]


def recall(rows, got):
    want = brute(rows)
    hits = sum(
        len({i for _, i in near} & {i for _, _, i in got[query]}) for query, near in want
    )
    for query, near in want:
        assert len(got[query]) == len(near)
        assert [r for r, _, _ in got[query]] == [1, 2, 3, 4, 5]
    exact = {query: dict((i, s) for s, i in near) for query, near in want}
    for query, near in got.items():
        scores = [s for _, s, _ in near]
        assert scores == sorted(scores, reverse=True)
        for _, s, i in near:
            assert abs(exact[query].get(i, s) - s) < 1e-11
    return hits / sum(len(near) for _, near in want)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_on_given_vectors(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    assert recall([(r.vec_id, r.embedding) for r in df.collect()], found(df)) >= 0.9


def test_tiles_and_a_hot_direction(spark, monkeypatch):
    monkeypatch.setattr(kmeans_tree, "TILE", 64)
    monkeypatch.setattr(kmeans_tree, "ASKED", 8)
    monkeypatch.setattr(kmeans_tree, "SAMPLE", 300)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((20, 12))
    x = centres[rng.integers(0, 20, 3000)] + 0.2 * rng.standard_normal((3000, 12))
    x[:1000] = centres[0] + 1e-3 * rng.standard_normal((1000, 12))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    assert recall(rows, found(spark.createDataFrame(rows, SCHEMA).repartition(8))) >= 0.9
