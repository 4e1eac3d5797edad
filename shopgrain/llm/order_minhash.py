"""Order MinHash fingerprints, in DataFrame functions only.

A text is a sequence of tokens: runs without ASCII white space, cut every sixteen
characters. Its k-mers of tokens are numbered by occurrence, so repeats count, and
hashed. The hash puts each into one of ``BINS`` bins and ranks it there; a bin selects
its ``TUPLE`` smallest, puts them back into text order and hashes the tuple. Two texts
agree in a bin if they select the same k-mers in the same order, which edits and
moved passages both prevent. Bins split one hash where separate permutations would
each read the whole text again.

All of it is arithmetic on arrays of longs that pack hash and position, sorted twice
per text: linear in the text up to the sorts, and inside the row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Tokens per k-mer, k-mers per tuple, bins per fingerprint (a power of two).
K, TUPLE, BINS = 3, 2, 32
TOKEN = r"\S{1,16}"

#: Bits of a position in a text: a string of 2^31 characters has no more tokens.
PLACE_BITS, RANK_BITS = 30, 28
PLACES = (1 << PLACE_BITS) - 1
#: A packed k-mer: five bits of bin, 28 of rank, 30 of position.
BIN_AT, RANK = PLACE_BITS + RANK_BITS, (1 << RANK_BITS) - 1
IN_BIN = ((BINS - 1) << BIN_AT) | (RANK << PLACE_BITS)
#: A signature entry: the bin over 35 bits of tuple hash.
ENTRY_BITS = 35
#: Ranges of ids per shuffle partition when texts meet their successors.
RANGES = 8


def long(x: int) -> Column:
    return F.lit(x - (1 << 64) if x >> 63 else x).cast("long")


def empty() -> Column:
    return F.array().cast("array<bigint>")


def indexes(array: Column) -> Column:
    """0 .. size - 1, for arrays that are not empty."""
    return F.sequence(F.lit(0), F.size(array) - 1)


def kmers(tokens: Column) -> Column:
    """The k-mers of ``tokens`` as hash (upper bits) and position, sorted."""

    def packed(token: Column, i: Column) -> Column:
        parts = [token, *(F.get(tokens, i + j) for j in range(1, K))]
        return F.xxhash64(*parts).bitwiseAND(long(~PLACES % (1 << 64))).bitwiseOR(i.cast("long"))

    whole = F.array(F.xxhash64(tokens).bitwiseAND(long(~PLACES % (1 << 64))))
    n = F.size(tokens)
    return F.sort_array(
        F.when(n == 0, empty())
        .when(n < K, whole)
        .otherwise(F.transform(F.slice(tokens, 1, n - (K - 1)), packed))
    )


def run_starts(mers: Column) -> Column:
    """Where runs of the same k-mer start in the sorted k-mers."""

    def starts(i: Column) -> Column:
        before, here = (F.shiftright(F.get(mers, at), PLACE_BITS) for at in (i - 1, i))
        return (i == 0) | (before != here)

    return F.when(F.size(mers) > 0, F.filter(indexes(mers), starts))


def numbered(mers: Column, starts: Column) -> Column:
    """Each occurrence as bin, rank and position, sorted."""

    def packed(mer: Column, occurrence: Column) -> Column:
        mixed = F.xxhash64(F.shiftright(mer, PLACE_BITS), occurrence)
        return mixed.bitwiseAND(long(IN_BIN)).bitwiseOR(mer.bitwiseAND(long(PLACES)))

    n = F.size(mers)

    def run(start: Column, i: Column) -> Column:
        return F.sequence(F.lit(0), F.coalesce(F.get(starts, i + 1), n) - start - 1)

    return F.sort_array(
        F.when(n == 0, empty())
        .when(F.size(starts) == n, F.transform(mers, lambda m: packed(m, F.lit(0))))
        .otherwise(F.zip_with(mers, F.flatten(F.transform(starts, run)), packed))
    )


def bin_of(packed: Column) -> Column:
    return F.shiftright(packed, BIN_AT)


def selected(occurrences: Column) -> Column:
    """The smallest of each bin, as bin, position and rank, sorted."""

    def small(x: Column, i: Column) -> Column:
        return (i < TUPLE) | (bin_of(F.get(occurrences, i - TUPLE)) != bin_of(x))

    def turned(x: Column) -> Column:
        bin_ = x.bitwiseAND(long((BINS - 1) << BIN_AT))
        place = F.shiftleft(x.bitwiseAND(long(PLACES)), RANK_BITS)
        rank = F.shiftright(x, PLACE_BITS).bitwiseAND(long(RANK))
        return bin_.bitwiseOR(place).bitwiseOR(rank)

    return F.sort_array(F.transform(F.filter(occurrences, small), turned))


def signature(chosen: Column) -> Column:
    """An entry per bin that has k-mers: the bin and the hash of its ordered tuple."""

    def first(i: Column) -> Column:
        return (i == 0) | (bin_of(F.get(chosen, i - 1)) != bin_of(F.get(chosen, i)))

    def entry(i: Column) -> Column:
        bin_ = bin_of(F.get(chosen, i))
        own = F.filter(F.slice(chosen, i + 1, TUPLE), lambda x: bin_of(x) == bin_)
        ranks = F.transform(own, lambda x: x.bitwiseAND(long(RANK)))
        tuple_hash = F.xxhash64(ranks).bitwiseAND(long((1 << ENTRY_BITS) - 1))
        return F.shiftleft(bin_, ENTRY_BITS).bitwiseOR(tuple_hash)

    filled = F.transform(F.filter(indexes(chosen), first), entry)
    return F.when(F.size(chosen) > 0, filled).otherwise(empty())


def with_signature(df: DataFrame, text: str, to: str) -> DataFrame:
    """Add ``to``, the signature (array<bigint>) of column ``text``; null texts are empty."""
    steps = [f"{to}_{i}" for i in range(4)]
    tokens, mers, starts, occurrences = steps
    text_ = F.coalesce(F.col(text), F.lit(""))
    made = (
        df.withColumn(tokens, F.regexp_extract_all(text_, F.lit(TOKEN), F.lit(0)))
        .withColumn(mers, kmers(F.col(tokens)))
        .drop(tokens)
        .withColumn(starts, run_starts(F.col(mers)))
        .withColumn(occurrences, numbered(F.col(mers), F.col(starts)))
        .drop(mers, starts)
        .withColumn(to, selected(F.col(occurrences)))
        .drop(occurrences)
    )
    return made.withColumn(to, signature(F.col(to)))


def written(sig: Column) -> Column:
    """A signature as text: ten hex digits per entry."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 10, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Bins with the same tuple, among the bins that either text fills; empty texts are equal."""
    filled = F.size(F.array_distinct(F.transform(F.concat(a, b), lambda x: F.shiftright(x, ENTRY_BITS))))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def fingerprint(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``fingerprint string`` of each row's text."""
    named = df.select(*keep, F.col(text).alias("omh_text"))
    made = with_signature(named, "omh_text", "omh_sig")
    return made.select(*keep, written(F.col("omh_sig")).alias("fingerprint"))


def range_of(key: Column, bounds: list[int]) -> Column:
    """The number of ``bounds`` that are at most ``key``, looked up in two steps."""
    step = max(1, math.isqrt(len(bounds)))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    if not parts:
        return F.lit(0)
    heads = F.array(*(F.lit(p[0]) for p in parts))
    part = F.size(F.filter(heads, lambda b: b <= key))
    inside = F.array(*(F.array(*map(F.lit, p)) for p in parts))
    found = F.size(F.filter(F.get(inside, part - 1), lambda b: b <= key))
    return F.when(part == 0, F.lit(0)).otherwise((part - 1) * step + found)


def beside_next(df: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, Window]:
    """Rows in ranges of ids such that every row's successor stands in the same range.

    Returns ``doc_id, text, guest`` and the window that orders a range. A range ends
    with a guest: a copy of the next range's first rows (after the last range: of the
    first's). Null ids come first; rows with one id are ordered by a hash of the text.
    Texts go through one shuffle; the driver holds the bounds of the ranges, whose
    number follows ``spark.sql.shuffle.partitions``.
    """
    spark = df.sparkSession
    ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    least = F.lit(-(1 << 63)).cast("long")
    rows = df.select(
        df[doc_id].cast("long").alias("doc_id"),
        F.coalesce(df[doc_id].cast("long"), least).alias("key"),
        F.coalesce(df[text], F.lit("")).alias("text"),
    )
    cuts = F.array(*(F.lit(i / ranges) for i in range(1, ranges)))
    found = rows.agg(F.percentile_approx("key", cuts, 10 * ranges)).first()[0]
    bounds = sorted(set(found or []))
    at = range_of(F.col("key"), bounds)
    firsts = rows.groupBy(at.alias("range")).agg(F.min("key").alias("key")).orderBy("range")
    firsts = [(r["range"], r["key"]) for r in firsts.collect()]
    before = {r: firsts[i - 1][0] for i, (r, _) in enumerate(firsts)}
    # Per range: its smallest key and the range before it; gaps name neither.
    smallest = dict(firsts)
    keys = F.array(*(F.lit(smallest.get(r)).cast("long") for r in range(len(bounds) + 1)))
    homes = F.array(*(F.lit(before.get(r)).cast("int") for r in range(len(bounds) + 1)))
    own = rows.withColumn("range", at)
    is_first = F.get(keys, F.col("range")) == F.col("key")
    own_place = F.struct(F.col("range"), F.lit(0).alias("guest"))
    guest_place = F.struct(F.get(homes, F.col("range")).alias("range"), F.lit(1).alias("guest"))
    places = F.when(is_first, F.array(own_place, guest_place)).otherwise(F.array(own_place))
    placed = own.select("doc_id", "key", "text", F.explode(places).alias("place")).select(
        "doc_id", "key", "text", "place.range", "place.guest"
    )
    window = Window.partitionBy("range").orderBy("guest", "key", "mark")
    return placed.withColumn("mark", F.xxhash64("text")), window


def edited_fingerprints(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Fingerprints of each text and of an edited copy, and how alike they are.

    The edited text ends with the beginning of the next document (by ascending id; the
    first follows the last) in place of its last quarter. Returns ``doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``. Null
    texts are empty; a null id comes first; repeated rows follow each other; a single
    row follows itself; an empty table gives no rows.
    """
    placed, window = beside_next(df, doc_id, text)
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")
    head = F.substring(F.lead("text").over(window), F.lit(1), quarter)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter), F.coalesce(head, F.lit("")))
    both = placed.withColumn("edited", edited).withColumn("n_chars", n.cast("long"))
    both = both.withColumn("edited", F.when(F.col("guest") == 0, F.col("edited")))
    signed = with_signature(both, "text", "sig").drop("text")
    signed = signed.withColumn("edited_sha256", F.sha2("edited", 256))
    signed = with_signature(signed, "edited", "edited_sig").drop("edited")
    beside = signed.withColumn("next_sig", F.lead("sig").over(window)).where("guest = 0")
    return beside.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        written(F.col("sig")).alias("fingerprint"),
        written(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
        likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )
