"""Embedding near-duplicates by spherical-cap filters.

A filter is a direction on the sphere; a vector passes those within a cap around it.
Directions come from random product codes: the rotated space is cut into blocks, each
with its own random unit vectors, and a direction joins one of them per block. So a
vector's scores with all directions are sums of a few block scores, and the
directions over the cap's height are list-decoded, never enumerated. Directions of one
code depend on each other, so there are several codes with rotations of their own.
Vectors with a cosine of 0.9 pass so many filters together that missing all of them is
unlikely; they meet in a join on filters, and the true cosine decides.

The cap follows the number of vectors, so a filter holds a bounded number of vectors
of a spread-out collection. A filter that holds more is cut into tiles, and pairs of
tiles are compared in separate tasks. Equal vectors are one node with a count.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.plans.saving import saved

from .arrow import slices
from .components import components

COSINE = 0.9
#: Vectors that a filter is meant to hold, filters that two linked vectors should share.
FILTER, SHARED = 256, 10
#: Share of random pairs at the threshold that must meet, pairs to measure it on.
RECALL, TRIALS = 0.985, 400
#: Independent product codes that the filters are spread over.
TURNS = 6
#: The highest share of all vectors in a cap.
WIDEST = 0.05
#: The highest cosine with a filter's direction that a cap may ask for. Short vectors would
#: reach no higher cap, however many directions there are.
STEEPEST = 0.8
#: Vectors of a tile, the largest number of code vectors in a block.
TILE, CODES = 2048, 1024
#: Vectors decoded, pairs compared at once.
STEP, PAIRS = 256, 1 << 22
SEED = 7

FOUND = "a bigint, b bigint, links bigint"


class Codes:
    """Directions for vectors of one length, for a collection of a given size."""

    def __init__(self, dim: int, count: int, seed: int = SEED):
        inside = min(WIDEST, FILTER / max(count, 1))
        normal = NormalDist()
        height = -normal.inv_cdf(inside)
        # A neighbour's score given that a vector just passes: its mean falls, it spreads.
        beside = sum(
            1 - normal.cdf((height - COSINE * z) / math.sqrt(1 - COSINE**2))
            for z in (-normal.inv_cdf(inside * (i + 0.5) / 200) for i in range(200))
        ) / 200
        wanted = max(4, SHARED / (inside * beside) / TURNS)
        cosine, least = height / math.sqrt(dim), 2
        if cosine > STEEPEST:
            # The cap is wider than the number of vectors asks for, and needs fewer filters.
            cosine, least = STEEPEST, 1
            wanted = max(4, SHARED / cap_share(dim, cosine) / TURNS)
        while True:
            blocks = min(dim, max(least, math.ceil(math.log(wanted) / math.log(CODES))))
            self.size = max(2, math.ceil(wanted ** (1 / blocks)))
            self.cuts = [round(i * dim / blocks) for i in range(blocks + 1)]
            self.height = cosine * math.sqrt(blocks)
            self.turns = [self.drawn(np.random.default_rng((seed, dim, t))) for t in range(TURNS)]
            # Few dimensions have thinner tails than the estimate: add directions.
            if dim < 2 or self.recall(np.random.default_rng((seed, dim))) >= RECALL:
                break
            wanted *= 1.3

    def recall(self, rng: np.random.Generator) -> float:
        """The share of random pairs with a cosine of just 0.9 that pass a filter together."""
        dim = self.cuts[-1]
        x, y = (units_of(rng.standard_normal((TRIALS, dim))) for _ in range(2))
        y = units_of(y - (x * y).sum(axis=1, keepdims=True) * x)
        y = COSINE * x + math.sqrt(1 - COSINE**2) * y
        passed = (set(zip(*(a.tolist() for a in self.decode(u)))) for u in (x, y))
        return len({row for row, _ in set.intersection(*passed)}) / TRIALS

    def drawn(self, rng: np.random.Generator) -> tuple[np.ndarray, list[np.ndarray]]:
        """A rotation and the code vectors of each block."""
        dim = self.cuts[-1]
        rotation, upper = np.linalg.qr(rng.standard_normal((dim, dim)))
        parts = []
        for a, z in zip(self.cuts, self.cuts[1:]):
            code = rng.standard_normal((self.size, z - a))
            parts.append(code / np.linalg.norm(code, axis=1, keepdims=True))
        return rotation * np.sign(np.diag(upper)), parts

    def decode(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, filter) of all filters that each unit vector passes."""
        found = [self.decode_turn(t, units) for t in range(TURNS)]
        row, name = (np.concatenate(x) for x in zip(*found))
        return row, name

    def decode_turn(self, turn: int, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The filters of one code.

        Blocks are added one by one; a partial sum goes on only if the best scores of
        the blocks to come can still lift it over the height.
        """
        rotation, codes_ = self.turns[turn]
        turned = units @ rotation
        spans = zip(self.cuts, self.cuts[1:], codes_)
        scores = [turned[:, a:z] @ code.T for a, z, code in spans]
        best = np.array([s.max(axis=1) for s in scores])
        ahead = np.concatenate((np.cumsum(best[::-1], axis=0)[::-1], np.zeros((1, len(units)))))
        row, name = np.arange(len(units)), np.full(len(units), turn, dtype=np.int64)
        total = np.zeros(len(units))
        for i, score in enumerate(scores):
            parts = []
            step = max(1, PAIRS // self.size)
            for start in range(0, max(1, len(row)), step):
                part = slice(start, start + step)
                sums = total[part, None] + score[row[part]]
                least = self.height - ahead[i + 1][row[part]]
                at, code = np.nonzero(sums >= least[:, None])
                names = name[part][at] * self.size + code
                parts.append((row[part][at], names, sums[at, code]))
            row, name, total = (np.concatenate(x) for x in zip(*parts))
        return row, name


def cap_share(dim: int, cosine: float) -> float:
    """The share of the sphere that has at least this cosine with a direction."""
    if dim < 2:
        return 0.5
    angles = (np.arange(1 << 14) + 0.5) * (math.pi / (1 << 14))
    weights = np.sin(angles) ** (dim - 2)
    return float(weights[np.cos(angles) >= cosine].sum() / weights.sum())


@lru_cache(8)
def codes(dim: int, count: int) -> Codes:
    return Codes(dim, count)


def units_of(vectors: np.ndarray) -> np.ndarray:
    x = vectors.astype(np.float64)
    # Scale first, so that squares neither overflow nor vanish.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def by_length(lists: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length and their values as a matrix."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        values = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield rows, values.reshape(len(rows), n)


def filters(vectors: DataFrame, count: int) -> DataFrame:
    """``rep, copies, vector`` once for each ``filter`` that the vector passes.

    The filter's number is joined with the vector's length, as vectors of different
    lengths have no cosine.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, STEP):
            for rows, values in by_length(part.column("vector")):
                row, name = codes(values.shape[1], count).decode(units_of(values))
                for at in range(0, len(row), 4096):
                    picked = pa.array(rows[row[at : at + 4096]])
                    taken = part.take(picked)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(name[at : at + 4096]),
                            pa.array(np.full(len(picked), values.shape[1], dtype=np.int32)),
                            *taken.columns,
                        ],
                        names=["filter", "dim", "rep", "copies", "vector"],
                    )

    kind = vectors.schema["vector"].dataType.simpleString()
    schema = f"filter bigint, dim int, rep bigint, copies bigint, vector {kind}"
    return vectors.select("rep", "copies", "vector").mapInArrow(run, schema)


def tiled(passed: DataFrame) -> DataFrame:
    """Add ``tile`` and ``a, b``: the pairs of tiles that a row takes part in.

    Filters of up to ``TILE`` vectors are one tile, compared with itself.
    """
    large = saved(
        passed.groupBy("filter", "dim").count().where(F.col("count") > TILE).select(
            "filter", "dim", F.ceil(F.col("count") / TILE).cast("int").alias("tiles")
        ),
        "large",
    )
    tiles = F.lit(1)
    if not large.isEmpty():
        passed = passed.join(large, ["filter", "dim"], "left")
        tiles = F.coalesce(F.col("tiles"), F.lit(1))
    tile = F.pmod(F.xxhash64("rep"), tiles).cast("int")
    pairs = F.transform(
        F.sequence(F.lit(0), tiles - 1),
        lambda t: F.struct(F.least(t, "tile").alias("a"), F.greatest(t, "tile").alias("b")),
    )
    spread = passed.withColumn("tile", tile).withColumn("pair", F.explode(pairs))
    return spread.select("filter", "dim", "rep", "copies", "vector", "tile", "pair.a", "pair.b")


def compare(count: int):
    """Linked pairs within runs of (filter, dim, a, b) of sorted batches.

    A pair that shares several filters belongs to the first of them. Returns the edges
    of a spanning forest (links null) and how many vectors each one links (b null).
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            new = pa.Table.from_batches([batch])
            held = new if held is None else pa.concat_tables([held, new])
            keys = [held.column(c).to_numpy() for c in ("filter", "dim", "a", "b")]
            change = np.zeros(max(0, held.num_rows - 1), dtype=bool)
            for key in keys:
                change |= key[1:] != key[:-1]
            ends = np.flatnonzero(change) + 1
            if len(ends):
                yield from runs(held.slice(0, int(ends[-1])), ends)
                held = held.slice(int(ends[-1])).combine_chunks()
        if held is not None and held.num_rows:
            yield from runs(held, np.array([held.num_rows]))

    def runs(rows: pa.Table, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = rows.combine_chunks()
        rep, copies, tile, name, a, b = (
            rows.column(c).to_numpy() for c in ("rep", "copies", "tile", "filter", "a", "b")
        )
        lists = rows.column("vector").chunk(0)
        out: list[tuple[np.ndarray, ...]] = []
        start = 0
        for end in ends.tolist():
            if end - start > 1:
                values = lists.slice(start, end - start).flatten().to_numpy(zero_copy_only=False)
                units = units_of(values.reshape(end - start, -1))
                within = tile[start:end]
                sides = (within == a[start], within == b[start])
                i, j = linked(units, *sides, a[start] == b[start], int(name[start]))
                i, j = i + start, j + start
                out.append((rep[i], rep[j], copies[i], copies[j]))
            start = end
        if out:
            yield summed(*(np.concatenate(x) for x in zip(*out)))

    def linked(units, left, right, same, name) -> tuple[np.ndarray, np.ndarray]:
        rows, cols = np.flatnonzero(left), np.flatnonzero(right)
        found = []
        step = max(1, PAIRS // max(1, len(cols)))
        for at in range(0, len(rows), step):
            part = rows[at : at + step]
            i, j = np.nonzero(units[part] @ units[cols].T >= COSINE)
            i, j = part[i], cols[j]
            found.append(np.stack([i, j])[:, i < j] if same else np.stack([i, j]))
        i, j = np.concatenate(found, axis=1) if found else np.zeros((2, 0), dtype=np.int64)
        if not len(i):
            return i, j
        # Only the first filter that both pass counts the pair.
        used, index = np.unique(np.concatenate((i, j)), return_inverse=True)
        row, filter_ = codes(units.shape[1], count).decode(units[used])
        width = int(np.bincount(row, minlength=len(used)).max())
        order = np.lexsort((filter_, row))
        table = np.full((len(used), width), -1, dtype=np.int64)
        place = np.arange(len(row)) - np.searchsorted(row[order], row[order])
        table[row[order], place] = filter_[order]
        first = np.zeros(len(i), dtype=bool)
        x, y = index[: len(i)], index[len(i) :]
        step = max(1, PAIRS // width**2)
        for at in range(0, len(i), step):
            p, q = table[x[at : at + step]], table[y[at : at + step]]
            common = (p[:, :, None] == q[:, None, :]).any(axis=2) & (p >= 0)
            lowest = np.where(common, p, np.iinfo(np.int64).max).min(axis=1)
            first[at : at + step] = lowest == name
        return i[first], j[first]

    return run


def summed(
    i: np.ndarray, j: np.ndarray, copies_i: np.ndarray, copies_j: np.ndarray
) -> pa.RecordBatch:
    """Links per vector, and a spanning forest of the pairs."""
    ends, index = np.unique(np.concatenate((i, j)), return_inverse=True)
    x, y = index[: len(i)], index[len(i) :]
    links = np.zeros(len(ends), dtype=np.int64)
    np.add.at(links, x, copies_j)
    np.add.at(links, y, copies_i)
    parent = np.arange(len(ends))
    a, b = np.maximum(x, y), np.minimum(x, y)
    while len(a):
        np.minimum.at(parent, a, b)
        while (parent[parent] != parent).any():
            parent = parent[parent]
        a, b = parent[a], parent[b]
        a, b = np.maximum(a, b)[a != b], np.minimum(a, b)[a != b]
    child = np.flatnonzero(parent != np.arange(len(ends)))
    first = np.concatenate((ends[child], ends))
    other = pa.array(
        np.concatenate((ends[parent[child]], ends)),
        mask=np.arange(len(first)) >= len(child),
    )
    sums = pa.array(
        np.concatenate((np.zeros(len(child), dtype=np.int64), links)),
        mask=np.arange(len(first)) < len(child),
    )
    return pa.RecordBatch.from_arrays([pa.array(first), other, sums], names=["a", "b", "links"])


def linked_vectors(vectors: DataFrame) -> DataFrame:
    """``a, b, links`` of distinct vectors (``rep, copies, vector``), as ``compare`` says."""
    count = vectors.count()
    passed = tiled(filters(vectors, count))
    keys = ["filter", "dim", "a", "b"]
    gathered = passed.repartition(*keys).sortWithinPartitions(*keys)
    columns = [*keys, "tile", "rep", "copies", "vector"]
    return gathered.select(columns).mapInArrow(compare(count), FOUND)


def near_vectors(df: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Rows link if the cosine of their vectors, in double precision, is at least 0.9.
    Vectors that are null, empty or zero or hold a null or non-finite component link
    with nothing, nor do vectors of different lengths. Equal vectors always link;
    repeated rows count as vectors of their own. A null id stays null, names no
    component and is kept if nothing else in its component has an id; an empty table
    gives no rows.
    """
    rows = df.select(df[vec_id].alias("vec_id"), df[embedding].alias("vector"))
    vector = F.col("vector")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    usable = vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)
    usable = F.coalesce(usable, F.lit(False))
    rows = rows.withColumn("vector", F.when(usable, F.col("vector")))
    distinct = rows.where("vector is not null").groupBy("vector").agg(
        F.count("*").alias("copies"), F.min("vec_id").alias("first")
    )
    distinct = saved(distinct.withColumn("rep", F.monotonically_increasing_id()), "distinct")
    found = saved(linked_vectors(distinct), "found")
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    roots = roots.withColumnsRenamed({"node": "rep"})
    known = distinct.join(links, "rep", "left").join(roots, "rep", "left").select(
        "vector",
        "first",
        F.coalesce("root", "rep").alias("root"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    known = saved(known, "known")
    smallest = known.groupBy("root").agg(F.min("first").alias("component_id"))
    known = saved(known.join(smallest, "root").drop("root", "first"), "named")
    component = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return (
        rows.join(known, "vector", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            component.alias("component_id"),
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
        .withColumnRenamed("vec_id", vec_id)
    )
