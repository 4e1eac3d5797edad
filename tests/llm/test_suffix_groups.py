"""Suffix orders against sorting, removed bytes against all strings of all documents."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest

from shopgrain.llm import suffix_groups
from shopgrain.llm.suffix_groups import (
    ANCHOR,
    HASH_BITS,
    LENGTH,
    WINDOW,
    ask_anchors,
    ask_contexts,
    gram_hashes,
    opened,
    packed,
    remove_repeats,
    repeated_spans,
    resolved_strings,
    smallest_ids,
    suffix_orders,
    text_anchors,
)


@pytest.mark.parametrize("symbols", [1, 2, 3, 26])
def test_suffix_orders(symbols):
    rng = np.random.default_rng(symbols)
    for _ in range(60):
        rows, width = int(rng.integers(1, 8)), int(rng.integers(1, 70))
        length = rng.integers(1, width + 1, rows)
        text = rng.integers(2, symbols + 2, (rows, width)).astype(np.int32)
        text[rng.random(text.shape) < 0.05] = 1
        text[np.arange(rows), length - 1] = 0
        got = suffix_orders(text, length)
        for r in range(rows):
            x = text[r, : length[r]].tolist()
            assert got[r, : length[r]].tolist() == sorted(range(len(x)), key=lambda i: x[i:])


def test_every_string_has_one_anchor(monkeypatch):
    monkeypatch.setattr(suffix_groups, "STEP", 200)
    rng = np.random.default_rng(1)
    values = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in (0, 10, 49, 50, 51, 150, 900, 1000)]
    values += [b"a" * 300, b""]
    rows = [set() for _ in values]
    for row, place, before, strings, hashes in text_anchors(pa.array(values)):
        for r, p, b, n, h in zip(row, place, before, strings, hashes, strict=True):
            grams = gram_hashes(np.frombuffer(values[r], np.uint8)) >> np.uint64(32)
            assert h == gram_hashes(np.frombuffer(values[r], np.uint8))[p]
            for start in range(p - b, p - b + n):
                assert start not in rows[r]
                rows[r].add(start)
                assert start + int(grams[start : start + WINDOW].argmin()) == p
    assert [len(r) for r in rows] == [max(0, len(v) - LENGTH + 1) for v in values]
    assert WINDOW + ANCHOR == LENGTH + 1


@pytest.mark.parametrize("parts", [32, 200])
def test_parts_of_anchors_are_even(parts):
    rng = np.random.default_rng(parts)
    texts = [bytes(rng.integers(97, 123, 4000).astype(np.uint8)) for _ in range(500)]
    batch = pa.record_batch([pa.array(range(500), pa.int64()), pa.array(texts)], ["t", "data"])
    many, seen = np.zeros(parts, dtype=np.int64), []
    for found in ask_anchors(parts)([batch]):
        for part, data in zip(*(c.to_pylist() for c in found.columns), strict=True):
            _, h, t, at = opened(data)
            many[part] += len(h)
            seen += zip(t.tolist(), (at >> 12).tolist(), h.tolist(), strict=True)
    assert many.max() < 1.5 * many.mean()
    whole = np.concatenate([x[-1] for x in text_anchors(pa.array(texts))])
    assert sorted(h for _, _, h in seen) == sorted((whole & np.uint64((1 << HASH_BITS) - 1)).tolist())
    for t, place, h in seen[::997]:
        assert h == int(gram_hashes(np.frombuffer(texts[t], np.uint8))[place]) & (1 << HASH_BITS) - 1


@pytest.mark.parametrize("most", [48, 3])
def test_smallest_ids(monkeypatch, most):
    monkeypatch.setattr(suffix_groups, "CONTEXTS", most)
    monkeypatch.setattr(suffix_groups, "BATCH", 2000)
    rng = np.random.default_rng(most)
    contexts, anchor = [], []
    for h in range(40):
        core = bytes(rng.integers(0, 256, 84).astype(np.uint8))
        for _ in range(int(rng.integers(1, 8))):
            x = bytearray(core)
            for _ in range(int(rng.integers(0, 3))):
                x[int(rng.integers(0, 84))] = int(rng.integers(0, 256))
            a = int(rng.integers(0, 17))
            contexts.append(bytes(x[a : a + int(rng.integers(50, 68))]))
            anchor.append(h)
    pairs = sorted(set(zip(contexts, anchor, strict=True)))
    contexts, anchor = [c for c, _ in pairs], np.array([h for _, h in pairs])
    first = rng.permutation(len(contexts))
    offset, least = smallest_ids(pa.array(contexts), anchor, first)
    ids = {}
    for c, h, f in zip(contexts, anchor.tolist(), first.tolist(), strict=True):
        for i in range(len(c) - LENGTH + 1):
            ids.setdefault((h, c[i : i + LENGTH]), []).append(f)
    for k, (c, h) in enumerate(zip(contexts, anchor.tolist(), strict=True)):
        got = least[offset[k] : offset[k + 1]].tolist()
        assert got == [min(ids[h, c[i : i + LENGTH]]) for i in range(len(c) - LENGTH + 1)]


def brute(rows):
    first = {}
    for doc, text in rows:
        data, d = (text or "").encode(), doc if doc is not None else float("inf")
        for i in range(len(data) - LENGTH + 1):
            s = data[i : i + LENGTH]
            first[s] = min(first.get(s, d), d)
    out = []
    for doc, text in rows:
        data, d = (text or "").encode(), doc if doc is not None else float("inf")
        gone = bytearray(len(data))
        for i in range(len(data) - LENGTH + 1):
            if first[data[i : i + LENGTH]] < d:
                gone[i : i + LENGTH] = b"\1" * LENGTH
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        digest = hashlib.sha256(kept).hexdigest()
        out.append((doc, len(data), sum(gone), spans, digest))
    return sorted(out, key=repr)


def corpus(rng, n):
    words = ["alpha", "beta", "gamma", "d", "éps", "zeta ", "eta", "th", "io", "kappa"]
    draw = lambda k: " ".join(rng.choice(words, k))
    shared = [draw(40) for _ in range(6)]
    rows = []
    for i in range(n):
        text = draw(int(rng.integers(1, 120)))
        if i % 3 == 0:
            text += shared[int(rng.integers(6))] + draw(5)
        if i % 7 == 0 and rows:
            text = rows[int(rng.integers(len(rows)))][1]
        if i % 11 == 0 and rows:
            other = rows[int(rng.integers(len(rows)))][1] or ""
            text = other[: len(other) // 2] + "!" + other[len(other) // 2 :]
        rows.append((i * 3 - 20, text))
    return rows


@pytest.mark.parametrize(("n", "parts", "batch"), [(60, 1, 10_000), (250, 5, 10_000), (200, 3, 7)])
def test_removed_bytes_equal_brute_force(spark, conf, n, parts, batch):
    """Small batches carry anchors and contexts over from one to the next."""
    conf(spark__sql__execution__arrow__maxRecordsPerBatch=str(batch))
    rows = corpus(np.random.default_rng(n), n)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    got = remove_repeats(df, "doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_edge_rows(spark):
    """Null, empty and periodic texts, null and repeated ids, clashing names, no rows."""
    a, b = "the quick brown fox jumps over the lazy dog " * 3, "0123456789" * 9
    rows = [
        (1, a, 0), (2, None, 0), (3, "", 0), (4, "x" * 500, 0), (5, "y" + "x" * 60, 0), (6, b, 0),
        (6, b + "!", 0), (6, b, 0), (7, b[:49], 0), (8, b[:50], 0), (None, a + "tail", 0), (None, a + "end", 0),
        (9, "x" * 49, 0), (10, a, 0), (-5, "z" + a, 0), (11, "é" * 40 + a, 0), (12, "é" * 40, 0),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, t int")
    out = remove_repeats(df, "doc_id", "text", content=True)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
    assert sorted((tuple(r)[:5] for r in out.collect()), key=repr) == brute([r[:2] for r in rows])
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in out.collect())
    assert remove_repeats(df.limit(0), "doc_id", "text").count() == 0


def test_long_texts(spark, monkeypatch):
    rng = np.random.default_rng(5)
    long = "".join(rng.choice(list("abcdefgh"), 200_000))
    rows = [(1, long), (2, long[50_000:150_000] + "!" + long[:70]), (3, "q" * 120_000), (4, "q" * 51)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, remove_repeats(df, "doc_id", "text").collect()))
    assert [g[:4] for g in got] == [
        (1, 200_000, 0, 0), (2, 100_071, 100_070, 2), (3, 120_000, 0, 0), (4, 51, 51, 1)
    ]


def phrase_in_all(rng, n):
    """Texts that hold one phrase, each amid other words, some of them repeated near it."""
    phrase, words = "a licence of markup bytes", [f"{x:05x}" for x in rng.integers(0, 1 << 20, 30)]
    out = []
    for i in range(n):
        near = " ".join(rng.choice(words, 9)) if i % 3 else " ".join(words[: 9 - i % 5])
        again = " once more" * (i % 40 if i % 9 == 0 else 0)
        end = " ".join(rng.choice(words[:3], 6))
        out.append(f"{rng.integers(1 << 60):015x} {near} {phrase} {end}{again}")
    return out


def in_batches(batches, size, *keys):
    """What a shuffle to one task, sorted by ``keys``, hands over."""
    table = pa.Table.from_batches([b for b in batches if b.num_rows])
    return table.sort_by([(k, "ascending") for k in keys]).combine_chunks().to_batches(size)


@pytest.mark.parametrize("rows", [40, 50_000])
def test_no_task_holds_a_frequent_phrase(monkeypatch, rows):
    """Batches of one to 90 texts, in which the anchors are crowded or not."""
    monkeypatch.setattr(suffix_groups, "CONTEXTS", 12)
    monkeypatch.setattr(suffix_groups, "ROWS", rows)
    monkeypatch.setattr(suffix_groups, "STRINGS", 500)
    held = []
    ordered = lambda c, a, f: held.append(np.bincount(np.unique(a, return_inverse=True)[1]).max()) or smallest_ids(c, a, f)  # noqa: E731, E501
    monkeypatch.setattr(suffix_groups, "smallest_ids", ordered)
    texts = [x.encode() for x in phrase_in_all(np.random.default_rng(rows), 400)]
    order = np.random.default_rng(3).permutation(400)
    values = pa.array(texts)
    at = [[] for _ in texts]
    for row, place, before, strings, _ in text_anchors(values):
        for r, x in zip(row.tolist(), packed(place, before, strings).tolist(), strict=True):
            at[r].append(x)
    names, batches, a = ["t", "u", "d", "data", "at", "doc_id"], [], 0
    for size in [90, 1, 5, 60, 11, 3, 80, 2, 9, 139]:
        ids = pa.array(order[a : a + size], pa.int64())
        t = pa.array(range(a, a + size), pa.int64())
        lists = pa.array(at[a : a + size], pa.list_(pa.int64()))
        batches.append(pa.record_batch([t, t, ids, values[a : a + size], lists, ids], names))
        a += size
    assert a == 400
    contexts = in_batches(ask_contexts(batches), 7, "h", "start")
    left = in_batches(repeated_spans(contexts), 7, "h", "context", "d")
    removed = [[] for _ in texts]
    for batch in resolved_strings(left):
        for x in batch.to_pylist():
            removed[x["k"]].append((x["start"], x["stop"]))
    least = {}
    for text, d in zip(texts, order.tolist(), strict=True):
        for i in range(len(text) - LENGTH + 1):
            x = text[i : i + LENGTH]
            least[x] = min(least.get(x, d), d)
    for text, d, got in zip(texts, order.tolist(), removed, strict=True):
        want = {j for i in range(len(text) - LENGTH + 1) if least[text[i : i + LENGTH]] < d
                for j in range(i, i + LENGTH)}
        assert {j for a, z in got for j in range(a, z)} == want
    # Of one anchor no more than batches below the limit send, or than may be held.
    assert max(held, default=0) <= min(12 * len(batches), rows + 7)


def test_frequent_phrase_in_spark(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="70")
    texts = phrase_in_all(np.random.default_rng(9), 500)
    rows = [(int(i), x) for i, x in zip(np.random.default_rng(4).permutation(500), texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = remove_repeats(df, "doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_a_repeating_text_asks_once():
    text = b" Is onhe." * 500
    values = pa.array([text, b"!" + text])
    lists = [[], []]
    for row, place, before, strings, _ in text_anchors(values):
        for r, x in zip(row.tolist(), packed(place, before, strings).tolist(), strict=True):
            lists[r].append(x)
    ids = pa.array([2, 1], pa.int64())
    columns = [ids, ids, ids, values, pa.array(lists, pa.list_(pa.int64())), ids]
    batch = pa.record_batch(columns, ["t", "u", "d", "data", "at", "doc_id"])
    contexts = in_batches(ask_contexts([batch]), 100, "h", "start")
    asking = [r for b in contexts for r in b.to_pylist() if r["context"] is not None]
    assert len(asking) < 20 and sum(len(r["more"] or b"") // 4 + 1 for r in asking) > 400
    left = in_batches(repeated_spans(contexts), 100, "h", "context", "d")
    got = [r for b in resolved_strings(left) for r in b.to_pylist()]
    assert got == [{"k": 2, "d": 2, "start": 0, "stop": len(text)}]
