"""Quality selection by importance resampling.

Two hashed n-gram models count features: one over the target (rows labelled good), one
over the raw corpus, which is every row. A row's log weight is the sum of the log ratios
of its n-grams, repeats included; Gumbel noise from a hash of the id turns the weights
into a sample without replacement, of which the top k stay.

An n-gram that one long text repeats is no evidence about the others, so a ratio counts
only where the numbers of texts that hold the n-gram differ by enough standard errors.
How many are enough depends on how much is labelled: a quarter of the good labels is
kept out of the target, and of ``EVIDENCE`` the level is used at which weights tell
these rows best from those labelled bad. The same rows give the weight that separates
the two, and k is the number of all rows above it. So neither depends on how many rows
of each kind were labelled.

Features are words and marks, alone and in pairs. Texts that go on repeating
themselves are no matter of their vocabulary, so the n-th repetition of a token (or of
the token before the last) is written as a mark of its own.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.plans.saving import saved

from .arrow import STEP, map_rows, slices

#: Buckets of the hashed models (a power of two); they bound what the driver gathers.
BUCKET_BITS = 20
#: The most labelled rows the target model is fitted on, picked by a hash of the id.
LABELLED = 200_000
#: Buckets that a row of counts holds.
SEGMENT = 1 << 8
#: Standard errors by which a feature must differ to count: the levels that are tried.
EVIDENCE = (1.5, 2.0, 2.5, 3.0, 3.5)
#: One in so many good labels calibrates instead of being fitted on.
HELD_OUT = 4
#: Kolmogorov and Smirnov's critical value: one in a thousand samples of a kind differ so.
DOUBT = 1.95
#: Added to the counts of a ratio.
SMOOTHING = 0.5
#: Repetitions in a row that are told apart; later ones share a mark.
REPEATS = 8
SEED = 11
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Token hashes kept per task.
KEPT = 300_000


class Features:
    """Texts to the buckets of their features, repeats included."""

    def __init__(self) -> None:
        self.kept: dict[str, int] = {}

    def token(self, token: str) -> int:
        if len(self.kept) >= KEPT:
            self.kept.clear()
        # The first numbers are for marks.
        value = self.kept[token] = zlib.crc32(token.encode()) + 4 * REPEATS
        return value

    def __call__(self, text: str | None) -> np.ndarray:
        tokens = TOKEN.findall((text or "").lower())
        if not tokens:
            return np.zeros(0, dtype=np.int64)
        kept, token = self.kept, self.token
        ids = np.fromiter((kept.get(t) or token(t) for t in tokens), np.uint64, len(tokens))
        for lag in (2, 1):
            ids = marked(ids, lag)
        pairs = ids[:-1] * np.uint64(0x9E3779B97F4A7C15) + ids[1:] + np.uint64(1 << 40)
        mixed = np.concatenate((ids, pairs)) * np.uint64(0xD1B54A32D192ED03)
        mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def marked(ids: np.ndarray, lag: int) -> np.ndarray:
    """Write the n-th token in a row that equals the one ``lag`` before it as a mark."""
    same = np.zeros(len(ids), dtype=bool)
    same[lag:] = ids[lag:] == ids[:-lag]
    at = np.arange(len(ids))
    turn = at - np.maximum.accumulate(np.where(same, -1, at))
    turn = np.minimum(turn, REPEATS).astype(np.uint64)
    return np.where(same, np.uint64(lag * REPEATS) + turn, ids)


class Labels(NamedTuple):
    """Ids the target is fitted on, good ones kept out of it, and bad ones."""

    fitted: frozenset
    held_out: frozenset
    bad: frozenset

    def kind(self, doc_id) -> int:
        return 1 if doc_id in self.held_out else 2 if doc_id in self.bad else 0


class Model(NamedTuple):
    """Per bucket the log ratio and the standard errors that speak for it."""

    ratios: np.ndarray
    errors: np.ndarray

    def levels(self) -> np.ndarray:
        """The ratios that count, a column for each level of evidence."""
        enough = self.errors[:, None] >= np.array(EVIDENCE)
        return np.where(enough, self.ratios[:, None], 0).astype(np.float32)


def labelled_rows(labels: DataFrame, doc_id: str, quality: str, toxic: str) -> Labels:
    """Up to ``LABELLED`` labelled ids.

    An id is good if all of its labels say so; labels without a quality are left out, a
    null toxicity counts as none.
    """
    hashed = F.xxhash64("doc_id")
    one = (
        labels.where(labels[quality].isNotNull() & labels[doc_id].isNotNull())
        .groupBy(labels[doc_id].alias("doc_id"))
        .agg(
            (
                (F.min(labels[quality]) > 0) & (F.coalesce(F.max(labels[toxic]), F.lit(0)) < 1)
            ).alias("good")
        )
    )
    picked = one.orderBy(hashed, "doc_id").limit(LABELLED)
    rows = picked.select("doc_id", "good", F.pmod(hashed, F.lit(HELD_OUT)).alias("part")).collect()
    good = [r for r in rows if r.good]
    return Labels(
        frozenset(r.doc_id for r in good if r.part),
        frozenset(r.doc_id for r in good if not r.part),
        frozenset(r.doc_id for r in rows if not r.good),
    )


def fit(df: DataFrame, doc_id: str, text: str, labels: Labels) -> Model:
    """Count both models in one pass over all rows and form the ratios.

    A task sends its counts in packed segments of buckets; tasks add those up.
    """
    spark = df.sparkSession
    targets = spark.sparkContext.broadcast(labels.fitted)

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, ids = Features(), targets.value
        # Uses in all texts and in the target, texts with a use in all and in the target.
        sums = np.zeros((4, 1 << BUCKET_BITS), dtype=np.int64)
        rows = np.zeros(4, dtype=np.int64)
        for part in slices(batches):
            docs, texts = (c.to_pylist() for c in part.columns)
            for doc, t in zip(docs, texts, strict=True):
                found = features(t)
                bucket, uses = np.unique(found, return_counts=True)
                target = doc in ids
                sums[0, bucket] += uses
                sums[2, bucket] += 1
                if target:
                    sums[1, bucket] += uses
                    sums[3, bucket] += 1
                rows += (len(found), len(found) * target, 1, target)
        for k in range(0, 1 << BUCKET_BITS, SEGMENT):
            part = sums[:, k : k + SEGMENT]
            at = np.flatnonzero(part[0])
            if len(at):
                yield counts_batch(k // SEGMENT, at, part[:, at])
        # The sums over all buckets have a segment of their own.
        yield counts_batch(-1, np.zeros(1, dtype=np.int64), rows[:, None])

    counted = df.select(df[doc_id], df[text]).mapInArrow(count, COUNTS)
    sums = saved(counted.repartition("segment").mapInArrow(added, COUNTS), "counts")
    targets.unpersist()
    return ratios(sums)


COLUMNS = ("uses", "target_uses", "texts", "target_texts")
COUNTS = "segment int, at array<int>, " + ", ".join(f"{c} array<bigint>" for c in COLUMNS)


def counts_batch(segment: int, at: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    lists = [pa.array([row], pa.list_(pa.int64())) for row in sums]
    return pa.RecordBatch.from_arrays(
        [pa.array([segment], pa.int32()), pa.array([at], pa.list_(pa.int32())), *lists],
        names=["segment", "at", *COLUMNS],
    )


def counts_of(part: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    for row in range(part.num_rows):
        at, *sums = (part.column(c)[row].values.to_numpy() for c in ("at", *COLUMNS))
        yield part.column("segment")[row].as_py(), at, np.stack(sums)


def added(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per segment that these rows have."""
    totals: dict[int, np.ndarray] = {}
    for part in slices(batches, STEP):
        for segment, at, sums in counts_of(part):
            total = totals.setdefault(segment, np.zeros((len(COLUMNS), SEGMENT), dtype=np.int64))
            total[:, at] += sums
    for segment, total in totals.items():
        at = np.flatnonzero(total.any(axis=0))
        yield counts_batch(segment, at, total[:, at])


def ratios(sums: DataFrame) -> Model:
    """The log ratio of each bucket and its evidence.

    ``sums`` has a row per segment, the sums over all buckets at segment -1. Only buckets
    with evidence for any level come to the driver, one ratio each.
    """
    out = Model(*(np.zeros(1 << BUCKET_BITS, dtype=np.float32) for _ in range(2)))
    whole = sums.where("segment < 0").first()
    if whole is None or not whole["target_uses"] or not whole["target_uses"][0]:
        return out
    uses, target_uses, texts, target_texts = (whole[c][0] for c in COLUMNS)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, STEP):
            for segment, at, counts in counts_of(part):
                all_, target, in_all, in_target = counts.astype(np.float64)
                expected = all_ * (target_uses / uses)
                ratio = np.log((target + SMOOTHING) / (expected + SMOOTHING))
                expected = in_all * (target_texts / texts)
                errors = np.abs(in_target - expected) / np.sqrt(expected + SMOOTHING)
                kept = errors >= min(EVIDENCE)
                bucket = at[kept].astype(np.int64) + segment * SEGMENT
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(bucket.astype(np.int32)),
                        pa.array(ratio[kept].astype(np.float32)),
                        pa.array(errors[kept].astype(np.float32)),
                    ],
                    names=["bucket", "ratio", "errors"],
                )

    found = sums.where("segment >= 0").mapInArrow(run, "bucket int, ratio float, errors float")
    table = found.toArrow()
    bucket = table.column("bucket").to_numpy()
    out.ratios[bucket] = table.column("ratio").to_numpy()
    out.errors[bucket] = table.column("errors").to_numpy()
    return out


def sortable(x: np.ndarray) -> np.ndarray:
    """Whole numbers in the order of the doubles ``x``."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def gumbel(noise: np.ndarray) -> np.ndarray:
    """Gumbel noise from 64-bit hashes."""
    uniform = ((noise.view(np.uint64) >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return -np.log(-np.log(uniform))


def weigh(
    df: DataFrame, doc_id: str, text: str, model: Model, labels: Labels, keep: list[str]
) -> DataFrame:
    """``keep`` and ``label`` and, per level, the weight, the key and the key's order.

    The key is the log weight with Gumbel noise; ``label`` is 1 for rows that calibrate
    as good ones, 2 for bad ones.
    """
    context = df.sparkSession.sparkContext
    shared = context.broadcast((model, labels))
    noise = df.withColumn("gumbel_noise", F.xxhash64(df[doc_id], F.lit(SEED)))

    def make():
        features, (fitted, known) = Features(), shared.value
        levels = fitted.levels()

        def rows(ids, hashes, texts):
            weight = np.array([levels[features(t)].sum(axis=0, dtype=np.float64) for t in texts])
            key = weight + gumbel(np.array(hashes, dtype=np.int64))[:, None]
            return list(map(known.kind, ids)), list(weight), list(key), list(sortable(key))

        return rows

    outputs = "label int, log_weights array<double>, keys array<double>, places array<bigint>"
    return map_rows(noise, keep, [doc_id, "gumbel_noise", text], outputs, make)


def separated(good: np.ndarray, bad: np.ndarray) -> tuple[float, float]:
    """A weight to tell good rows from bad ones, and by how much their shares above differ.

    Of the weights at which the shares differ by the most, or by no more than a standard
    error less, it is the smallest: where few rows are labelled, more rows stay.
    """
    at = np.unique(np.concatenate((good, bad)))
    above = [1 - np.searchsorted(np.sort(x), at) / len(x) for x in (good, bad)]
    gain = above[0] - above[1]
    best = int(gain.argmax())
    error = math.sqrt(
        sum(a[best] * (1 - a[best]) / len(x) for a, x in zip(above, (good, bad), strict=True))
    )
    return float(at[gain >= gain[best] - error][0]), float(gain[best])


def calibrated(weighed: DataFrame, doc_id: str) -> tuple[int, float] | None:
    """The level of evidence and the weight that tell good rows from bad ones best.

    None without labelled rows of both kinds, or where they are too few to say that their
    weights differ at all (Kolmogorov and Smirnov's test). An id with several rows counts
    once, by the least of their weights.
    """
    levels = range(len(EVIDENCE))
    one = weighed.where("label > 0").groupBy(doc_id).agg(
        F.min("label").alias("label"),
        F.array(*(F.min(F.col("log_weights")[i]) for i in levels)).alias("weights"),
    )
    rows = one.select("label", "weights").collect()
    kinds = [np.array([r["weights"] for r in rows if r["label"] == kind]) for kind in (1, 2)]
    if not all(map(len, kinds)):
        return None
    found = [separated(kinds[0][:, i], kinds[1][:, i]) for i in levels]
    best = max(levels, key=lambda i: (found[i][1], i))
    chance = DOUBT * math.sqrt(sum(1 / len(x) for x in kinds))
    return (best, found[best][0]) if found[best][1] > chance else None


def top_place(places: DataFrame, k: int) -> int | None:
    """The k-th largest ``place``, sixteen bits at a time: four counts of bounded size."""
    if k < 1:
        return None
    # Digits of the place shifted to start at zero, by turning its sign bit.
    shifted = F.col("place").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))
    found, rank = 0, k
    for shift in (48, 32, 16, 0):
        upper = F.shiftrightunsigned(F.shiftrightunsigned(shifted, shift), 16)
        digit = F.shiftrightunsigned(shifted, shift).bitwiseAND(F.lit(0xFFFF))
        inside = places.where(upper == F.lit(found).cast("long"))
        counts = inside.groupBy(digit.alias("digit")).count().collect()
        for r in sorted(counts, key=lambda r: -r.digit):
            if rank <= r["count"]:
                found = found << 16 | r.digit
                break
            rank -= r["count"]
        else:
            return None
    return found - (1 << 63)


def resample(
    df: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    columns: tuple[str, str, str] = ("doc_id", "quality", "toxic"),
    keep: list[str] | None = None,
) -> DataFrame:
    """The rows of ``df`` that stay, with ``log_weight`` and ``key``.

    Null and empty texts have no features and weigh nothing (log weight 0); rows with
    one id share their noise and their label; rows tied with the k-th all stay; a null id
    is one more id, without a label. Where the labelled rows are not of both kinds, good
    and bad, or too few to tell them apart, nothing says what to reject and every row stays. An empty table gives no
    rows. Texts are read twice and never shuffled.
    """
    keep = keep or [doc_id]
    known = labelled_rows(labels, *columns)
    model = fit(df, doc_id, text, known)
    weighed = weigh(df, doc_id, text, model, known, [doc_id, *(c for c in keep if c != doc_id)])
    weighed = saved(weighed, "weighed")
    found = calibrated(weighed, doc_id)
    level, least = found or (len(EVIDENCE) - 1, -np.inf)
    ranked = weighed.select(
        *(weighed[c] for c in keep),
        F.col("log_weights")[level].alias("log_weight"),
        F.col("keys")[level].alias("key"),
        F.col("places")[level].alias("place"),
    )
    k = ranked.where(F.col("log_weight") >= float(least)).count()
    last = top_place(ranked.select("place"), k)
    chosen = ranked.where(F.col("place") >= F.lit(last)) if last is not None else ranked.limit(0)
    return chosen.drop("place")
