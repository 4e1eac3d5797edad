"""Signatures and neighbours against a plain version of the same definition."""

import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from shopgrain.llm.order_minhash import (
    BIN_AT,
    PLACE_BITS,
    RANK_BITS,
    BINS,
    K,
    TUPLE,
    edited_fingerprints,
    fingerprint,
    range_of,
)

MASK = (1 << 64) - 1


def chained(parts):
    seed = 42
    for part in parts:
        seed = xxhash.xxh64_intdigest(part, seed=seed)
    return seed


def packed_long(x):
    return struct.pack("<q", x - (1 << 64) if x >> 63 else x)


def slow(text):
    """{bin: tuple of ranks in text order}, and the fingerprint's text."""
    tokens = [t.encode() for t in re.findall(r"[^ \t\n\x0b\f\r]{1,16}", text or "")]
    mers = [tokens[i : i + K] for i in range(len(tokens) - K + 1)] if len(tokens) >= K else []
    if tokens and not mers:
        mers = [tokens]
    seen, bins = {}, {}
    for place, mer in enumerate(mers):
        bits = 64 - PLACE_BITS
        h = chained(mer) >> PLACE_BITS
        h -= (h >> (bits - 1)) << bits  # an arithmetic shift keeps the sign
        number = seen[h] = seen.get(h, -1) + 1
        v = chained([packed_long(h & MASK), struct.pack("<i", number)])
        v = (v >> PLACE_BITS) & ((1 << RANK_BITS + 5) - 1)
        bins.setdefault(v >> RANK_BITS, []).append((v & ((1 << RANK_BITS) - 1), place))
    out = []
    for b in sorted(bins):
        chosen = sorted(bins[b])[:TUPLE]
        ranks = [rank for _, rank in sorted((place, rank) for rank, place in chosen)]
        entry = chained([struct.pack("<q", r) for r in ranks]) & ((1 << 35) - 1)
        out.append(f"{b << 35 | entry:010x}")
    return out


def alike(a, b):
    filled = {int(x, 16) >> 35 for x in a + b}
    return len(set(a) & set(b)) / len(filled) if filled else 1.0


def test_every_position_of_a_text_has_a_place_of_its_own():
    """A string holds less than 2^31 characters, and a token takes two with its space."""
    assert 1 << PLACE_BITS >= 2**31 // 2 and PLACE_BITS + RANK_BITS == BIN_AT
    assert BIN_AT + (BINS - 1).bit_length() <= 63


TEXTS = [
    "", None, " \n", "one", "one two", "a b c", "a b c d e f g h", "x " * 300, "ab " * 7 + "cd " * 9,
    "the cat sat on the mat and the cat sat on the hat " * 8, "é　ü" * 40, "y" * 1000,
    " ".join(f"w{i * i % 97}" for i in range(700)),
]


def test_fingerprints(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    got = {r.doc_id: r.fingerprint for r in fingerprint(df, "text", ["doc_id"]).collect()}
    assert got == {i: "".join(slow(t)) for i, t in enumerate(TEXTS)}
    assert all(len(slow(t)) <= BINS for t in TEXTS)


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words[200:] + words[:200]), " ".join(words[:396] + list("abcd"))]
    one, moved, changed = map(slow, texts)
    assert alike(one, moved) < 0.7 < alike(one, changed)


def expected(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = []
    for i, (doc, text) in enumerate(order):
        after = order[(i + 1) % len(order)][1] or ""
        text = text or ""
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = slow(text), slow(edited), slow(after)
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((doc, len(text), digest, "".join(a), "".join(b), alike(a, b), alike(a, c)))
    return out


@pytest.mark.parametrize("count", [1, 2, 13, 200])
def test_edited_texts(spark, count):
    """Null and empty texts, a null id, ids far apart; one row follows itself."""
    rows = [(i * i * 1000 - 5000, TEXTS[i % len(TEXTS)]) for i in range(count)]
    rows += [(None, "null id words are here")] if count > 2 else []
    df = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, n_chars int")
    got = edited_fingerprints(df.repartition(7), "doc_id", "text").collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert [tuple(r) for r in sorted(got, key=key)] == expected(rows)


def test_repeated_rows_long_texts_and_no_rows(spark):
    long = " ".join(f"w{i % 5000}" for i in range(30_000))
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (2, long)], "doc_id long, text string")
    got = sorted(map(tuple, edited_fingerprints(df, "doc_id", "text").collect()))
    assert [g[0] for g in got] == [1, 1, 2]
    assert {g[6] for g in got[:2]} >= {1.0}
    assert got[2][3] == "".join(slow(long))
    assert edited_fingerprints(df.limit(0), "doc_id", "text").count() == 0


def test_ranges(spark):
    for bounds in ([], [5], [1, 4, 9, 16, 25, 36, 49]):
        df = spark.range(60).select("id", range_of(F.col("id"), bounds).alias("r"))
        assert all(r.r == sum(b <= r.id for b in bounds) for r in df.collect())


def test_stays_in_the_jvm(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = edited_fingerprints(df, "doc_id", "text")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
