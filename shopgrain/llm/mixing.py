"""Mix sources to target weights.

The words of a source, document after document, are packed into blocks of a fixed
length, shorter ones where a source is so small that whole blocks would miss its target. Every output shard draws its source counts from a multinomial over what the
sources still owe; a slot of a source goes to the block that a pseudorandom
permutation of the source's block indices names, a new permutation for each pass.
Slots and blocks meet in a join on (source, block), keys that are even however large
a source is.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.plans.saving import saved

from .arrow import map_rows

#: Words per block, output shards, most passes over a source.
BLOCK, SHARDS, PASSES = 128, 256, 2
#: Blocks that a source has at least, down to blocks of one word.
FINEST = 64
#: Slots, or copies of a row, that one row stands for before they are listed; slots per task.
RUN, TASK = 1 << 16, 1 << 20
#: Sources weigh so, by code point and in turn.
WEIGHTS = (5, 2, 1)
#: Words the mix takes, as a multiple of all words.
SHARE = 1.5
#: Parts of a source whose words are counted apart, to number its words in parallel.
CHUNKS = 4096
SEED = 20240601
WORD = r"[^\x20\x09-\x0D]+"


class Source(NamedTuple):
    source: str | None
    size: int
    target: float
    block: int
    blocks: int
    slots: int


def targets(sizes: list[int], weights: list[float], total: float, most: float) -> list[float]:
    """Shares of ``total`` by weight; none above ``most`` times its size, the excess
    reshared by weight among the others until none is above."""
    out = [0.0] * len(sizes)
    open_ = list(range(len(sizes)))
    left = total
    while open_:
        weight = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / weight > most * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / weight
            break
        for i in over:
            out[i] = float(most * sizes[i])
        left -= sum(out[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def plan_sources(sizes: list[tuple[str | None, int]], block: int) -> list[Source]:
    """Targets, blocks and slots of the sources in the order of their weights."""
    ordered = sorted(sizes, key=lambda s: (s[0] is None, s[0] or ""))
    counts = [size for _, size in ordered]
    weights = [WEIGHTS[i % len(WEIGHTS)] for i in range(len(ordered))]
    shares = targets(counts, weights, SHARE * sum(counts), PASSES)
    out = []
    for (source, size), target in zip(ordered, shares, strict=True):
        own = max(1, min(block, size // FINEST))
        blocks = -(-size // own)
        slots = min(PASSES * blocks, round(target * blocks / size)) if size else 0
        out.append(Source(source, size, target, own, blocks, slots))
    return out


def draws(slots: list[int], shards: int, seed: int) -> Iterator[tuple[int, int, int, int]]:
    """``shard, source, first slot, slots``: multinomial counts of each shard.

    A count beyond what a source owes is drawn again among the others, so that all
    shards together take each source's slots exactly.
    """
    rng = np.random.default_rng(seed)
    left = np.array(slots, dtype=np.int64)
    taken = np.zeros_like(left)
    cuts = [round(i * int(left.sum()) / shards) for i in range(shards + 1)]
    for shard in range(shards):
        need = cuts[shard + 1] - cuts[shard]
        counts = np.zeros_like(left)
        while need:
            drawn = np.minimum(rng.multinomial(need, left / left.sum()), left)
            counts += drawn
            left -= drawn
            need -= int(drawn.sum())
        for source in np.flatnonzero(counts).tolist():
            yield shard, source, int(taken[source]), int(counts[source])
        taken += counts


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: xor-shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(index: np.ndarray, size: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Where a keyed permutation of range(size) sends ``index``, element by element.

    Four Feistel rounds over the next even number of bits; results outside the range
    go through them again until they fall inside.
    """
    bits = np.array([max(2, int(s - 1).bit_length()) for s in size.tolist()], dtype=np.uint64)
    half = (bits + np.uint64(1)) // np.uint64(2)
    low = (np.uint64(1) << half) - np.uint64(1)
    out, limit, key = (x.astype(np.uint64) for x in (index, size, key))
    todo = np.arange(len(out))
    while len(todo):
        x, h, m, k = out[todo], half[todo], low[todo], key[todo]
        left, right = x >> h, x & m
        for turn in range(4):
            turned = mix64(right + k + np.uint64(turn * 0x9E3779B97F4A7C15 % (1 << 64)))
            left, right = right, left ^ (turned & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= limit[todo]]
    return out.astype(np.int64)


def block_slots(sources: list[Source], spark, shards: int, seed: int) -> DataFrame:
    """``shard, slot, source_no, block, turn``: a row per slot of the mix.

    ``turn`` counts the passes over the source.
    """
    rows = [
        (shard, source, first, count, sources[source].blocks)
        for shard, source, first, count in draws([s.slots for s in sources], shards, seed)
    ]
    schema = "shard int, source_no int, first long, count long, blocks long"
    # Runs of bounded length, dealt to as many tasks as there are slots for.
    parts = sum(-(-count // RUN) for _, _, _, count, _ in rows)
    tasks = max(shards, sum(s.slots for s in sources) // TASK)
    runs = (
        spark.createDataFrame(rows, schema)
        .withColumn("part", F.explode(F.expr(f"sequence(0L, (count - 1) div {RUN})")))
        .withColumn("first", F.col("first") + F.col("part") * RUN)
        .withColumn("count", F.least(F.lit(RUN), F.col("count") - F.col("part") * RUN))
        .repartition(max(1, min(tasks, parts)))
    )
    slots = runs.select(
        "shard",
        "source_no",
        F.explode(F.sequence("first", F.expr("first + count - 1"))).alias("slot"),
        "blocks",
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shard, source, slot, blocks = (c.to_numpy() for c in batch.columns)
            turn = slot // blocks
            key = (np.uint64(seed) << np.uint64(20)) + source.astype(np.uint64)
            key = mix64(key * np.uint64(PASSES + 1) + turn.astype(np.uint64))
            at = permuted(slot % blocks, blocks, key)
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, (shard, slot, source, at, turn))],
                names=["shard", "slot", "source_no", "block", "turn"],
            )

    schema = "shard int, slot long, source_no int, block long, turn long"
    return slots.mapInArrow(run, schema)


class Mix(NamedTuple):
    """``documents``: ``row, <kept columns>, source, size, source_size, target``.
    ``pieces``: ``shard, slot, source_no, block, turn, row, first_word, words``, the parts
    of documents that the mix's blocks hold."""

    documents: DataFrame
    pieces: DataFrame


def mix_sources(
    df: DataFrame,
    doc_id: str,
    text: str,
    source: str,
    block: int = BLOCK,
    shards: int = SHARDS,
    seed: int = SEED,
) -> Mix:
    """Plan and join a mix of the words of ``df``.

    Null texts have no words and are never taken; null sources are one source, the
    last; repeated rows are documents of their own and a null id is one more id; an
    empty table gives an empty mix. Words are numbered by a hash of the id and the text,
    the id and the text's hash, so reruns agree; repeats of a row are numbered as one
    and told apart behind it. The driver holds one row per source and ``shards`` rows per
    source; all else stays distributed.
    """
    spark = df.sparkSession
    sized = df.select(
        df[doc_id].alias("doc_id"),
        df[source].alias("source"),
        F.xxhash64(df[text]).alias("mark"),
        F.coalesce(F.regexp_count(df[text], F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    same = ["doc_id", "source", "mark", "size"]
    sized = saved(sized.groupBy(*same).agg(F.count("*").alias("copies")), "sizes")
    words = F.col("size") * F.col("copies")
    totals = sized.groupBy("source").agg(F.sum(words).alias("size")).collect()
    sources = plan_sources([(r.source, r["size"]) for r in totals], block)
    named = spark.createDataFrame(
        [(i, s.source, s.size, s.target, s.block) for i, s in enumerate(sources)],
        "source_no int, source string, source_size long, target double, block_words long",
    ).withColumnRenamed("source", "of")
    numbered = sized.join(
        named, F.col("source").eqNullSafe(F.col("of")), "inner"
    ).drop("of").withColumn(
        "chunk", F.pmod(F.xxhash64("doc_id", "mark"), F.lit(CHUNKS)).cast("int")
    )
    ahead = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        numbered.groupBy("source_no", "chunk")
        .agg(F.sum(words).alias("words"))
        .select("source_no", "chunk", F.coalesce(F.sum("words").over(ahead), F.lit(0)).alias("before"))
    )
    inside = (
        Window.partitionBy("source_no", "chunk")
        .orderBy("doc_id", "mark", "size")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    own = F.coalesce(F.sum(words).over(inside), F.lit(0))
    placed = numbered.withColumn("own", own).join(parts, ["source_no", "chunk"])
    placed = placed.withColumn(
        "run", F.explode(F.expr(f"sequence(0L, (copies - 1) div {RUN})"))
    )
    if (sized.agg(F.max("copies")).first()[0] or 0) > RUN:
        placed = placed.repartition("source_no", "chunk", "run")
    last = F.least(F.col("copies"), (F.col("run") + 1) * RUN) - 1
    placed = placed.withColumn("nth", F.explode(F.sequence(F.col("run") * RUN, last)))
    documents = saved(
        placed.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id", "mark", "source", "source_no", "size", "source_size", "target",
            "block_words",
            (F.col("before") + F.col("own") + F.col("nth") * F.col("size")).alias("start"),
        ),
        "documents",
    )
    end = F.col("start") + F.col("size")
    spread = documents.where("size > 0").select(
        "row",
        "source_no",
        "start",
        end.alias("end"),
        "block_words",
        F.explode(
            F.expr("sequence(start div block_words, (start + size - 1) div block_words)")
        ).alias("block"),
    )
    first = F.greatest("start", F.col("block") * F.col("block_words"))
    cut = spread.select(
        "row",
        "source_no",
        "block",
        (first - F.col("start")).alias("first_word"),
        (F.least("end", (F.col("block") + 1) * F.col("block_words")) - first).alias("words"),
    )
    slots = block_slots(sources, spark, shards, seed)
    # Both sides grow with the data, whatever their estimates say: never broadcast.
    pieces = slots.join(cut.hint("merge"), ["source_no", "block"])
    return Mix(documents, pieces)


def taken_words(mix: Mix) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` per document of the mix."""
    taken = mix.pieces.groupBy("row").agg(F.sum("words").alias("taken"))
    return mix.documents.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )


def taken_texts(mix: Mix, df: DataFrame, doc_id: str, text: str, keep: list[str]) -> DataFrame:
    """``keep``, ``turn`` and ``text``: what the mix takes of each row of ``df``.

    A row per document and pass over its source; ``text`` joins the taken stretches,
    white space inside as it was, by line ends. Documents of which a pass takes nothing
    have no row for it. Texts go through one shuffle.
    """
    same = ["doc_id", "mark"]
    taken = mix.pieces.groupBy("row", "turn").agg(
        F.collect_list(F.struct("first_word", "words")).alias("parts")
    )
    nth = F.row_number().over(Window.partitionBy(*same).orderBy("row")).alias("nth")
    rows = mix.documents.select("row", *same, nth).join(taken, "row")
    texts = df.select(
        df[doc_id].alias("doc_id"),
        F.xxhash64(df[text]).alias("mark"),
        df[text].alias("whole"),
        F.struct(*(df[c] for c in keep)).alias("kept"),
    )
    order = Window.partitionBy(*same).orderBy(F.lit(0))
    texts = texts.withColumn("nth", F.row_number().over(order))
    on = texts.doc_id.eqNullSafe(rows.doc_id) & (texts.mark == rows.mark) & (texts.nth == rows.nth)
    met = texts.hint("merge").join(rows.hint("merge"), on).select("kept", "turn", "whole", "parts")

    def make():
        word = re.compile(WORD)

        def one(whole: str, parts: list[dict]) -> str:
            places = [m.span() for m in word.finditer(whole)]
            stretches: list[list[int]] = []
            for first, words in sorted((p["first_word"], p["words"]) for p in parts):
                if stretches and stretches[-1][1] == first:
                    stretches[-1][1] += words
                else:
                    stretches.append([first, first + words])
            return "\n".join(whole[places[a][0] : places[z - 1][1]] for a, z in stretches)

        return lambda wholes, parts: (list(map(one, wholes, parts)),)

    found = map_rows(met, ["kept", "turn"], ["whole", "parts"], "text string", make)
    return found.select("kept.*", "turn", "text")
