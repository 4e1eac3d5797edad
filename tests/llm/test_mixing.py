"""Mixes against their targets, and their parts against brute force."""

from collections import Counter

import numpy as np
import pytest

from shopgrain.llm import mixing
from shopgrain.llm.mixing import (
    PASSES,
    draws,
    mix64,
    mix_sources,
    permuted,
    plan_sources,
    taken_words,
    targets,
)


def test_targets_are_capped_and_reshared():
    assert targets([100, 100, 100], [5, 2, 1], 450, 2) == [200, 250 * 2 / 3, 250 / 3]
    assert targets([10, 100, 1000], [5, 2, 1], 1665, 2) == [20, 200, 1445]
    assert targets([0, 10], [5, 2], 15, 2) == [0, 15]
    assert targets([], [], 0, 2) == []


def test_sources_are_ordered_by_code_point_with_null_last():
    found = plan_sources([("b", 300), (None, 300), ("B", 300), ("é", 0)], 10)
    assert [s.source for s in found] == ["B", "b", "é", None]
    assert found[2].slots == found[2].blocks == 0
    assert sum(s.target for s in found) == pytest.approx(1350)
    assert all(s.slots <= 2 * s.blocks for s in found)


@pytest.mark.parametrize("slots", [[1, 0, 5], [1000, 10, 300], [0], []])
def test_draws_take_every_slot_once(slots):
    seen = [[] for _ in slots]
    for _, source, first, count in draws(slots, 16, 1):
        seen[source] += range(first, first + count)
    assert seen == [list(range(n)) for n in slots]


@pytest.mark.parametrize("size", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutations(size):
    index = np.arange(size)
    ones = np.ones(size, dtype=np.int64)
    a, b = (permuted(index, ones * size, (ones * k).astype(np.uint64)) for k in (1, 2))
    assert sorted(a.tolist()) == sorted(b.tolist()) == index.tolist()
    assert size < 64 or a.tolist() != b.tolist()


def documents(spark):
    rng = np.random.default_rng(1)
    rows = [
        (i, " ".join(["w"] * int(rng.integers(0, 400))), f"s{i % 7 if i % 3 else 0}", 1)
        for i in range(600)
    ]
    rows += [(600, "a\tb\n c", None, 1), (601, None, "s1", 1), (602, "", "s1", 1), (None, "x y", "s2", 1)]
    rows += [rows[5], rows[5], (700, "long " * 50_000, "s3", 1)]
    schema = "doc_id long, text string, source string, size int"
    return rows, spark.createDataFrame(rows, schema).repartition(5)


def test_mix_meets_its_targets(spark):
    """Null ids, texts and sources, repeated rows, a long text, clashing names."""
    rows, df = documents(spark)
    mix = mix_sources(df, "doc_id", "text", "source", block=32)
    out = taken_words(mix).collect()
    assert len(out) == len(rows)
    sizes = Counter((r[0], len((r[1] or "").encode().split())) for r in rows)
    assert Counter((r.doc_id, r["size"]) for r in out) == sizes
    assert all(0 <= r.taken <= 2 * r["size"] for r in out)
    of = {(r[0], len((r[1] or "").encode().split())): r[2] for r in rows}
    taken, target, size = Counter(), {}, Counter()
    for r in out:
        s = of[r.doc_id, r["size"]]
        taken[s] += r.taken
        size[s] += r["size"]
        target[s] = r.target, r.source_size
    assert all(target[s][1] == size[s] for s in target)
    assert sum(t for t, _ in target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s, (t, _) in target.items():
        assert abs(taken[s] - t) <= max(64, 0.05 * t), s
    again = taken_words(mix_sources(df.repartition(3), "doc_id", "text", "source", block=32))
    assert sorted(map(str, again.collect())) == sorted(map(str, out))


def test_pieces_cover_blocks(spark):
    _, df = documents(spark)
    mix = mix_sources(df, "doc_id", "text", "source", block=32)
    pieces = mix.pieces.toPandas()
    assert not pieces.duplicated(["source_no", "slot", "row"]).any()
    per_slot = pieces.groupby(["source_no", "slot"])["words"].sum()
    assert per_slot.max() == 32
    uses = pieces[["source_no", "slot", "block"]].drop_duplicates()
    times = uses.groupby(["source_no", "block"]).size()
    assert times.max() <= 2
    # No block is taken twice before all blocks of its source are taken once.
    for source, part in uses.groupby("source_no"):
        counts = times[source]
        blocks = -(-mix.documents.where(f"source_no = {source}").first().source_size // 32)
        assert counts.min() == counts.max() == 2 or len(counts) == blocks or counts.max() == 1


def plain_mix(rows, block, shards, seed):
    """Words taken per (id, size): the same mix, slot by slot and word by word."""
    sizes = [(r, len((r[1] or "").encode().split())) for r in rows]
    totals = Counter()
    for r, n in sizes:
        totals[r[2]] += n
    sources = plan_sources(list(totals.items()), block)
    number = {s.source: i for i, s in enumerate(sources)}
    taken_blocks = {i: Counter() for i in range(len(sources))}
    for _, source, first, count in draws([s.slots for s in sources], shards, seed):
        for slot in range(first, first + count):
            blocks = sources[source].blocks
            turn = slot // blocks
            key = (np.uint64(seed) << np.uint64(20)) + np.uint64(source)
            key = mix64(np.array([key * np.uint64(PASSES + 1) + np.uint64(turn)]))
            at = permuted(np.array([slot % blocks]), np.array([blocks]), key)
            taken_blocks[source][int(at[0])] += 1
    return sources, number, taken_blocks, sizes


def test_taken_words_equal_a_plain_mix(spark):
    """What each document gives, from its place in its source and the blocks drawn."""
    rows, df = documents(spark)
    with np.errstate(over="ignore"):
        sources, number, blocks, _ = plain_mix(rows, 32, 16, 5)
    mix = mix_sources(df, "doc_id", "text", "source", block=32, shards=16, seed=5)
    out = {r.row: r for r in mix.documents.collect()}
    covered = {i: [] for i in range(len(sources))}
    expected = {}
    for row, r in out.items():
        s = number[r.source]
        covered[s] += range(r.start, r.start + r["size"])
        at = (word // sources[s].block for word in range(r.start, r.start + r["size"]))
        expected[row] = sum(blocks[s][b] for b in at)
    # The documents of a source lie end to end.
    assert all(sorted(covered[i]) == list(range(s.size)) for i, s in enumerate(sources))
    got = mix.pieces.groupBy("row").agg({"words": "sum"}).collect()
    assert {r[0]: r[1] for r in got} == {row: n for row, n in expected.items() if n}


def test_small_sources_meet_their_targets(spark):
    rows = [(i, "w " * 100, f"s{i}") for i in range(3)] + [(9, "one two", "t")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for r in taken_words(mix_sources(df, "doc_id", "text", "source")).collect():
        assert abs(r.taken - r.target) <= 0.02 * r.target + 1


def test_runs_and_copies_are_listed_in_parts(spark, monkeypatch):
    """Many slots of a shard, and many copies of a row, go through rows of bounded runs."""
    rows, df = documents(spark)
    df = df.unionByName(df.where("doc_id = 7").crossJoin(spark.range(500)).drop("id"))
    whole = taken_words(mix_sources(df, "doc_id", "text", "source", block=32))
    want = sorted(map(str, whole.collect()))
    monkeypatch.setattr(mixing, "RUN", 7)
    monkeypatch.setattr(mixing, "TASK", 50)
    mix = mix_sources(df, "doc_id", "text", "source", block=32)
    assert sorted(map(str, taken_words(mix).collect())) == want


def test_no_rows(spark):
    _, df = documents(spark)
    assert taken_words(mix_sources(df.limit(0), "doc_id", "text", "source")).count() == 0
    nulls = df.where("text is null")
    assert taken_words(mix_sources(nulls, "doc_id", "text", "source")).first().taken == 0
