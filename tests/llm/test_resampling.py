"""Selection by importance weights: counts and order statistics, and held-out accuracy."""

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopgrain.llm import resampling
from shopgrain.llm.resampling import (
    BUCKET_BITS,
    EVIDENCE,
    SEED,
    SEGMENT,
    Features,
    Labels,
    fit,
    gumbel,
    labelled_rows,
    marked,
    resample,
    separated,
    sortable,
    top_place,
)

DATA = "/root/testdata/sf0.1"


def test_marks_count_repetitions():
    ids = np.array([100, 100, 100, 101, 102, 101, 102, 101], dtype=np.uint64)
    assert marked(ids, 1).tolist() == [100, 9, 10, 101, 102, 101, 102, 101]
    assert marked(ids, 2).tolist() == [100, 100, 17, 101, 102, 17, 18, 19]


def test_features_are_words_and_pairs():
    f = Features()
    for text in ("", None, "  ", "a", "a b a b a b", "x " * 50000):
        found = f(text)
        words = len((text or "").split())
        assert len(found) == max(0, 2 * words - 1)
        assert all(0 <= b < 1 << BUCKET_BITS for b in found.tolist())
    assert f("Word, word").tolist() == f("word,   WORD").tolist()


def plain_counts(texts):
    """Per bucket: uses in all and target texts, texts with a use in all and in the target."""
    f, sums = Features(), {}
    for text, target in texts:
        for b, n in Counter(f(text).tolist()).items():
            old = sums.get(b, (0, 0, 0, 0))
            sums[b] = tuple(np.add(old, (n, n * target, 1, target)).tolist())
    return sums


def plain_levels(texts):
    """Ratios per bucket and level."""
    sums = plain_counts(texts)
    uses, target_uses = (sum(s[i] for s in sums.values()) for i in (0, 1))
    n, m = len(texts), sum(t for _, t in texts)
    out = {}
    for b, (u, tu, d, td) in sums.items():
        e, ed = u * target_uses / uses, d * m / n
        ratio = math.log((tu + 0.5) / (e + 0.5))
        errors = abs(td - ed) / math.sqrt(ed + 0.5)
        out[b] = [ratio if errors >= level else 0.0 for level in EVIDENCE]
    return out


def test_weights_and_selection_row_by_row(spark):
    """Every row's weight at the level used, and the rows that stay, against a plain version."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    big = 2**53
    docs = docs.withColumn("doc_id", F.col("doc_id") + big)
    labels = labels.withColumn("doc_id", F.col("doc_id") + big)
    docs = docs.unionByName(docs.limit(5)).unionByName(docs.limit(3).withColumn("doc_id", F.lit(None)))
    out = {(r.doc_id, r.log_weight, r.key) for r in resample(docs, labels).collect()}
    known = labelled_rows(labels, "doc_id", "quality", "toxic")
    noise = F.xxhash64("doc_id", F.lit(SEED))
    rows = docs.select("doc_id", "text", noise.alias("noise")).collect()
    levels = plain_levels([(r.text, r.doc_id in known.fitted) for r in rows])
    f = Features()
    weights = [np.sum([levels[b] for b in f(r.text).tolist()] or [[0.0] * 5], axis=0) for r in rows]
    kinds = []
    for ids in (known.held_out, known.bad):
        least = {}
        for r, w in zip(rows, weights):
            if r.doc_id in ids:
                least[r.doc_id] = np.minimum(least.get(r.doc_id, np.inf), w)
        kinds.append(np.array(list(least.values())))
    gains = []
    for i in range(5):
        good, bad = kinds[0][:, i], kinds[1][:, i]
        share = {x: ((good >= x).mean(), (bad >= x).mean()) for x in {*good, *bad}}
        best = max(share, key=lambda x: (round(share[x][0] - share[x][1], 12), -x))
        g, b = share[best]
        least = g - b - math.sqrt(g * (1 - g) / len(good) + b * (1 - b) / len(bad))
        gains.append((g - b, -min(x for x, (g, b) in share.items() if g - b >= least)))
    level = max(range(5), key=lambda i: (round(gains[i][0], 12), i))
    w = np.array([x[level] for x in weights])
    keys = w + gumbel(np.array([r.noise for r in rows]))
    k = int((w >= -gains[level][1] - 1e-4).sum())
    last = np.sort(keys)[::-1][k - 1]
    expected = {r.doc_id for r, key in zip(rows, keys) if key >= last}
    assert {i for i, _, _ in out} == expected
    plain = {(r.doc_id, round(x, 2)) for r, x, key in zip(rows, w, keys) if key >= last}
    assert {(i, round(x, 2)) for i, x, _ in out} == plain


def test_few_labels_reject_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    assert resample(docs, labels).count() == docs.count()


def test_counts_of_tasks_are_added(spark):
    texts = [("a b a", 1), ("b c", 0), (None, 1), ("", 0), ("a " * 40, 0)] * 3
    rows = [(i, t) for i, (t, _) in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    good = frozenset(i for i, (_, g) in enumerate(texts) if g)
    seen = {}
    real = resampling.ratios
    resampling.ratios = lambda sums: seen.update(sums=sums) or real(sums)
    try:
        fit(df, "doc_id", "text", Labels(good, frozenset(), frozenset()))
    finally:
        resampling.ratios = real
    got, whole = {}, None
    for r in seen["sums"].collect():
        columns = list(zip(r.uses, r.target_uses, r.texts, r.target_texts))
        if r.segment < 0:
            whole = columns[0]
        else:
            got |= {r.segment * SEGMENT + at: c for at, c in zip(r["at"], columns)}
    want = plain_counts(texts)
    assert got == want
    assert whole == (*(sum(s[i] for s in want.values()) for i in (0, 1)), 15, 6)


def test_separation():
    assert separated(np.array([1.0, 2.0, 3.0]), np.array([-1.0, 0.0])) == (1.0, 1.0)
    # One good row in four below all bad ones is within a standard error of none.
    few = separated(np.array([-9.0, 4.0, 5.0, 6.0]), np.array([1.0, 2.0, 3.0, 4.5]))
    assert few[0] < 4 and few[1] == 0.5
    assert separated(np.array([0.0, 1.0]), np.array([0.0, 1.0]))[1] == 0


def test_places_keep_the_order_of_doubles():
    x = np.array([-np.inf, -5.5, -1e-300, -0.0, 0.0, 1e-300, 2.0, np.inf])
    assert (np.diff(sortable(x)) >= 0).all()
    assert sortable(np.array([-0.0]))[0] == sortable(np.array([0.0]))[0]
    g = gumbel(np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 100_000))
    assert abs(g.mean() - 0.5772) < 0.02 and np.isfinite(g).all()


@pytest.mark.parametrize("k", [1, 2, 7, 500, 999, 1000])
def test_top_place(spark, k):
    rng = np.random.default_rng(k)
    values = rng.integers(-(2**63), 2**63 - 1, 990).tolist() + [3, 3, 3, 0, -1, -(2**63), 2**63 - 1, 5, 5, 4]
    df = spark.createDataFrame([(v,) for v in values], "place long")
    assert top_place(df, k) == sorted(values, reverse=True)[k - 1]


def test_top_place_of_too_few(spark):
    df = spark.createDataFrame([(1,)], "place long")
    assert top_place(df, 0) is None and top_place(df, 2) is None


def test_labels_may_repeat_or_miss(spark):
    rows = [(1, 1, 0), (1, 0, 0), (2, 1, None), (3, None, 0), (4, 1, 1), (None, 1, 0), (5, 1, 0), (5, 1, 0)]
    df = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    known = labelled_rows(df, "doc_id", "quality", "toxic")
    assert known.fitted | known.held_out == {2, 5} and known.bad == {1, 4}
    assert not known.fitted & known.held_out
    assert not any(labelled_rows(df.limit(0), "doc_id", "quality", "toxic"))
    many = spark.range(4000).selectExpr("id as doc_id", "1 as quality", "0 as toxic")
    known = labelled_rows(many, "doc_id", "quality", "toxic")
    assert 0.2 < len(known.held_out) / 4000 < 0.3 and not known.bad


def test_edge_rows(spark):
    """Null and empty texts, null ids, repeated rows, clashing names, no rows, no labels."""
    rows = [(1, None, 0.0), (2, "", 0.0), (3, "x " * 60000, 0.0), (3, "x", 0.0), (None, "y", 0.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, key double")
    labels = spark.createDataFrame([(1, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    out = resample(df, labels)
    assert out.columns == ["doc_id", "log_weight", "key"]
    assert 0 < out.count() <= 5
    for some in ("quality > 1", "quality = 0", "quality = 1"):  # labels of one kind, or none
        assert resample(df, labels.where(some)).count() == 5
    assert resample(df.limit(0), labels).count() == 0
    again = resample(df.repartition(3), labels)
    assert sorted(map(str, again.collect())) == sorted(map(str, out.collect()))


@pytest.mark.parametrize("every", [1, 10])
def test_held_out_accuracy(spark, every):
    """Fitted on labels of even ids, all of them or a tenth of the good, judged on odd ids."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    good, junk, toxic = "quality = 1 and toxic = 0", "quality = 0", "toxic = 1"
    given = labels.where("doc_id % 2 = 0").where(f"not ({good}) or doc_id % {2 * every} = 0")
    kept = resample(docs, given).select("doc_id")
    held = labels.where("doc_id % 2 = 1")
    n = lambda df, c: df.where(c).count()
    stay = held.join(kept, "doc_id")
    assert n(stay, good) >= 0.95 * n(held, good)
    assert n(stay, junk) <= 0.05 * n(held, junk)
    # A few words make a text toxic: they are known once enough clean texts are labelled.
    assert n(stay, toxic) <= (0.35 if every == 1 else 0.75) * n(held, toxic)
