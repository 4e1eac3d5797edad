"""Nearest neighbours through a hierarchical k-means tree, best bins first.

The tree is fitted on a bounded sample of the distinct vectors: spherical k-means splits
a node into up to ``BRANCH`` children until few sampled vectors are left. Every vector
goes down to its leaf. A query takes the nodes of the tree from a priority queue, the
one whose centre is nearest first, and so lists leaves in the order in which they are
worth a visit. How many it visits is calibrated: some queries are answered exactly,
against all vectors in blocks, and visits widen until the calibrated share of their true
neighbours lies in the leaves visited. Visits go on beyond that while the leaves hold
fewer rows than were asked for.

Neighbouring leaves share a bin of a bounded number of vectors. A query goes once to each
bin in which it visits leaves, with their list, and is compared with the vectors of
these. A leaf that overfills a bin, and the queries of a much visited bin, are cut into
tiles, so a pair of tiles is bounded; the nearest of each pair are merged per query.
Equal vectors are one node with the few smallest of their ids, which are all that an
answer can name, and equal queries are asked once. Scores are the cosine of the original
vectors in double precision, summed in one order wherever a pair is met.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.plans.saving import saved

from .arrow import slices

#: Neighbours per query; queries are rows whose id this divides.
NEAREST, ASKING = 5, 50
#: Sampled vectors that the tree is fitted on at most (in expectation), and their entries.
SAMPLE, ENTRIES = 1 << 15, 1 << 22
#: Children of a node, sampled vectors of a leaf, rounds of k-means.
BRANCH, LEAF, ROUNDS = 12, 40, 8
#: Queries answered exactly to calibrate (in expectation), the share of neighbours wanted.
TRIALS, RECALL = 256, 0.95
#: Vectors of a bin or tile, queries of a tile.
TILE, ASKED = 4096, 4096
#: Rows turned into a matrix at once, entries of a block of scores.
STEP, BLOCK = 1024, 1 << 22
#: Scores of a product of matrices are this close to the exact sums.
CLOSE = 1e-12
SEED = 5
LAST = 2**63 - 1


def units_of(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The cosine of each row of ``x`` with its row of ``y``, the same whoever asks."""
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
    dot, xx, yy = (np.einsum("ij,ij->i", a, b) for a, b in ((x, y), (x, x), (y, y)))
    return np.clip(dot / (np.sqrt(xx) * np.sqrt(yy)), -1.0, 1.0)


@dataclass
class Node:
    """``centres`` of the children, which are ``Node`` or the number of a leaf."""

    centres: np.ndarray
    children: list


@dataclass
class Tree:
    """The tree over vectors of one length, or a single leaf where ``root`` is zero."""

    root: Node | int = 0
    leaves: int = 1
    #: Rows of each leaf, counted over all vectors.
    rows: np.ndarray = field(default_factory=lambda: np.zeros(1, dtype=np.int64))

    def leaf_of(self, units: np.ndarray) -> np.ndarray:
        """The leaf that each vector belongs to: the nearest child at every node."""
        leaf = np.zeros(len(units), dtype=np.int64)
        open_: list[tuple[Node | int, np.ndarray]] = [(self.root, np.arange(len(units)))]
        while open_:
            node, at = open_.pop()
            if not isinstance(node, Node):
                leaf[at] = node
                continue
            child = (units[at] @ node.centres.T).argmax(axis=1)
            open_ += [(node.children[c], at[child == c]) for c in np.unique(child).tolist()]
        return leaf

    def visits(self, unit: np.ndarray) -> Iterator[int]:
        """The leaves in the order of a best-bin-first traversal."""
        queue: list[tuple[float, int, Node | int]] = [(0.0, 0, self.root)]
        pushed = 0
        while queue:
            _, _, node = heapq.heappop(queue)
            if not isinstance(node, Node):
                yield node
                continue
            for score, child in zip((node.centres @ unit).tolist(), node.children):
                pushed += 1
                heapq.heappush(queue, (-score, pushed, child))

    @property
    def bins(self) -> np.ndarray:
        """The bin of each leaf: leaves that are neighbours in the tree, up to ``TILE`` rows."""
        bins, filled, last = [], 0, 0
        for n in self.rows.tolist():
            if filled and filled + n > TILE:
                last, filled = last + 1, 0
            bins.append(last)
            filled += n
        return np.array(bins)

    def visited(self, unit: np.ndarray, wanted: int, least: int) -> list[int]:
        """The first ``wanted`` leaves, and more until they hold ``least`` rows."""
        out, rows = [], 0
        for leaf in self.visits(unit):
            if not self.rows[leaf]:
                continue
            out.append(leaf)
            rows += int(self.rows[leaf])
            if len(out) >= wanted and rows >= least:
                break
        return out


def clustered(units: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means: centres and the one nearest to each row."""
    centres = units[rng.choice(len(units), min(BRANCH, len(units)), replace=False)]
    for _ in range(ROUNDS):
        nearest = (units @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        norms = np.linalg.norm(sums, axis=1)
        used = norms > 0
        centres = sums[used] / norms[used, None]
    return centres, (units @ centres.T).argmax(axis=1)


def fitted(units: np.ndarray) -> Tree:
    """A tree over a sample."""
    rng = np.random.default_rng(SEED)
    leaves = 0

    def grown(at: np.ndarray) -> Node | int:
        nonlocal leaves
        if len(at) > LEAF:
            centres, nearest = clustered(units[at], rng)
            parts = [at[nearest == c] for c in range(len(centres))]
            kept = [c for c, part in enumerate(parts) if len(part)]
            if len(kept) > 1:
                return Node(centres[kept], [grown(parts[c]) for c in kept])
        leaves += 1
        return leaves - 1

    root = grown(np.arange(len(units)))
    return Tree(root, leaves, np.zeros(leaves, dtype=np.int64))


def matrices(batch: pa.RecordBatch, name: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of equal length and their vectors as a matrix of doubles."""
    lists = batch.column(name)
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        values = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
        yield rows, values.astype(np.float64).reshape(len(rows), n)


def usable(vector: Column) -> Column:
    """Vectors that have a cosine: finite components, not all zero."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    taken = vector.isNotNull() & finite & F.exists(vector, lambda c: c != 0)
    return F.coalesce(taken, F.lit(False))


def distinct_vectors(rows: DataFrame, keep: int) -> DataFrame:
    """``rep, dim, first, ids, vector`` per different vector.

    ``ids`` are the ``keep`` smallest of its rows, nulls last, ``first`` the smallest.
    Other rows are cut before the shuffle already.
    """
    by_id = Window.partitionBy("vector").orderBy(F.asc_nulls_last("id"))
    few = rows.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= keep)
    listed = F.sort_array(F.collect_list(F.struct("nth", "id")))
    found = few.groupBy("vector").agg(F.transform(listed, lambda s: s["id"]).alias("ids"))
    return saved(
        found.select(
            F.monotonically_increasing_id().alias("rep"),
            F.size("vector").alias("dim"),
            F.coalesce(F.col("ids")[0], F.lit(LAST)).alias("first"),
            "ids",
            "vector",
        ),
        "distinct",
    )


def sampled(vectors: DataFrame, wanted: int, total: int, salt: int) -> DataFrame:
    """About ``wanted`` of ``total`` vectors, the same in every run."""
    share = min(1.0, wanted / max(total, 1))
    return vectors.where(
        F.pmod(F.xxhash64("vector", F.lit(salt)), F.lit(1 << 40)) < int(share * (1 << 40))
    )


def fit(vectors: DataFrame) -> dict[int, Tree]:
    """Trees by the length of vectors; lengths outside the sample have one leaf.

    The sample holds about ``SAMPLE`` vectors, fewer if they are long.
    """
    sizes = vectors.agg(F.count("*").alias("n"), F.avg("dim").alias("dim")).first()
    wanted = min(SAMPLE, ENTRIES / max(sizes["dim"] or 1, 1))
    rows = sampled(vectors, wanted, sizes["n"], 0).select("rep", "vector").toArrow()
    trees = {}
    if rows.num_rows:
        batch = rows.sort_by("rep").combine_chunks().to_batches()[0]
        for _, x in matrices(batch, "vector"):
            trees[x.shape[1]] = fitted(units_of(x))
    return trees


def assigned(vectors: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Add ``leaf``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, STEP):
            leaf = np.zeros(part.num_rows, dtype=np.int64)
            for rows, x in matrices(part, "vector"):
                leaf[rows] = trees.get(x.shape[1], Tree()).leaf_of(units_of(x))
            yield part.append_column("leaf", pa.array(leaf))

    given = vectors.select("rep", "dim", "first", "vector")
    kind = given.schema["vector"].dataType.simpleString()
    schema = f"rep bigint, dim int, first bigint, vector {kind}, leaf bigint"
    return given.mapInArrow(run, schema)


def best_of(
    query: np.ndarray,
    rows: np.ndarray,
    first: np.ndarray,
    keep: int,
    leaf: np.ndarray | None = None,
    visited: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score) of the ``keep`` nearest rows per query, ties to the smaller first.

    ``visited`` says which of the leaves that ``leaf`` numbers a query may look into. The
    product of the matrices leaves out what is clearly further away; the rest gets exact
    scores.
    """
    q_unit, r_unit = units_of(query), units_of(rows)
    found = []
    step = max(1, BLOCK // max(1, len(rows)))
    for start in range(0, len(query), step):
        rough = q_unit[start : start + step] @ r_unit.T
        if visited is not None:
            rough[~visited[start : start + step][:, leaf]] = -3.0
        if rough.shape[1] > keep:
            least = np.partition(rough, -keep, axis=1)[:, -keep]
        else:
            least = np.full(len(rough), -2.0)
        at, row = np.nonzero(rough >= np.maximum(least, -2.0)[:, None] - CLOSE)
        for a in range(0, len(at), STEP * 16):
            part = slice(a, a + STEP * 16)
            found.append(
                (at[part] + start, row[part], cosines(query[at[part] + start], rows[row[part]]))
            )
    q, r, score = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((first[r], -score, q))
    q, r, score = q[order], r[order], score[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    return q[place < keep], r[place < keep], score[place < keep]


def exact(leaves: DataFrame, asked: DataFrame, keep: int) -> DataFrame:
    """``q, leaf, score, first``: the true nearest of a bounded set of queries.

    Every task compares its vectors with all of the queries, in blocks, and sends on its
    own nearest.
    """
    batch = asked.select("rep", "vector").toArrow().combine_chunks().to_batches()
    queries = {}
    for part in batch:
        names = part.column("rep").to_numpy()
        for rows, x in matrices(part, "vector"):
            queries[x.shape[1]] = (names[rows], x)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, STEP * 4):
            names, leaf, first = (part.column(c).to_numpy() for c in ("rep", "leaf", "first"))
            for rows, x in matrices(part, "vector"):
                if x.shape[1] not in queries:
                    continue
                reps, asking = queries[x.shape[1]]
                q, r, score = best_of(asking, x, first[rows], keep + 1)
                other = names[rows[r]] != reps[q]
                q, r, score = q[other], rows[r[other]], score[other]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a) for a in (reps[q], leaf[r], score, first[r])],
                    names=["q", "leaf", "score", "first"],
                )

    local = leaves.select("rep", "leaf", "first", "vector").mapInArrow(
        run, "q bigint, leaf bigint, score double, first bigint"
    )
    nearest = Window.partitionBy("q").orderBy(F.desc("score"), "first")
    return local.withColumn("nth", F.row_number().over(nearest)).where(F.col("nth") <= keep)


def calibrated(leaves: DataFrame, asked: DataFrame, trees: dict[int, Tree], keep: int) -> int:
    """The fewest visits at which the wanted share of true neighbours is in visited leaves."""
    truth: dict[int, list[int]] = {}
    for row in exact(leaves, asked, keep).collect():
        truth.setdefault(row["q"], []).append(row["leaf"])
    needed = []
    for row in asked.collect():
        tree = trees.get(len(row["vector"]), Tree())
        unit = units_of(np.array([row["vector"]], dtype=np.float64))[0]
        filled = (leaf for leaf in tree.visits(unit) if tree.rows[leaf])
        order = {leaf: n for n, leaf in enumerate(filled, 1)}
        needed += [order[leaf] for leaf in truth.get(row["rep"], ())]
    visits, needed = 1, np.array(needed)
    while len(needed) and (needed <= visits).mean() < RECALL:
        visits += 1
    return visits


def routed(
    asked: DataFrame, trees: dict[int, Tree], visits: int, least: int
) -> DataFrame:
    """``rep, dim, vector, bin, visited`` once for each bin in which a query visits leaves."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = {dim: tree.bins for dim, tree in trees.items()}
        for part in slices(batches, STEP // 4):
            at, bin_, lists = [], [], []
            for rows, x in matrices(part, "vector"):
                dim = x.shape[1]
                tree, bin_of = trees.get(dim, Tree()), bins.get(dim, np.zeros(1, dtype=int))
                for row, unit in zip(rows.tolist(), units_of(x)):
                    seen = np.array(tree.visited(unit, visits, least) or [0])
                    for b in np.unique(bin_of[seen]).tolist():
                        at.append(row)
                        bin_.append(b)
                        lists.append(seen[bin_of[seen] == b])
            for start in range(0, len(at), STEP):
                some = slice(start, start + STEP)
                taken = part.take(pa.array(at[some], pa.int64()))
                taken = taken.append_column("bin", pa.array(bin_[some], pa.int64()))
                visited = pa.array(lists[some], pa.list_(pa.int64()))
                yield taken.append_column("visited", visited)

    kind = asked.schema["vector"].dataType.simpleString()
    given = asked.select("rep", "dim", "vector")
    schema = f"rep bigint, dim int, vector {kind}, bin bigint, visited array<bigint>"
    return given.mapInArrow(run, schema)


def tiled(rows: DataFrame, own: str, other: str, sizes: DataFrame) -> DataFrame:
    """Rows once for each tile of the other side; ``own`` and ``other`` number the tiles."""
    dealt = rows.join(sizes, ["dim", "bin"])
    mine = F.pmod(F.xxhash64("rep", F.lit(1)), F.col(f"{own}s")).cast("int")
    beside = F.explode(F.sequence(F.lit(0), F.col(f"{other}s") - 1))
    return dealt.withColumn(own, mine).withColumn(other, beside).drop(f"{own}s", f"{other}s")


def nearest_in_tiles(keep: int):
    """The nearest rows to each query within runs of (dim, bin, tile, part).

    Rows of a run come before its queries, which are answered batch by batch.
    """
    keys = ["dim", "bin", "tile", "part"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, rows = None, [], None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in keys]
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            change = asks[1:] != asks[:-1]
            for c in columns:
                change |= c[1:] != c[:-1]
            starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
            for a, z in zip(starts, starts[1:]):
                if a == z:
                    continue
                name = tuple(int(c[a]) for c in columns)
                if name != current:
                    current, held, rows = name, [], None
                part = batch.slice(a, z - a)
                vectors = part.column("vector").flatten().to_numpy(zero_copy_only=False)
                vectors = vectors.astype(np.float64).reshape(z - a, -1)
                reps, first = (part.column(c).to_numpy() for c in ("rep", "first"))
                visited = part.column("visited")
                leaves = visited.flatten().to_numpy()
                if not asks[a]:
                    held.append((reps, first, leaves, vectors))
                elif held or rows:
                    if rows is None:
                        rows, held = tuple(np.concatenate(x) for x in zip(*held)), []
                    yield nearest(rows, reps, vectors, visited, leaves)

    def nearest(rows, reps, vectors, visited, leaves) -> pa.RecordBatch:
        names, leaf = np.unique(rows[2], return_inverse=True)
        asker = np.repeat(np.arange(len(reps)), visited.value_lengths().to_numpy())
        place = np.minimum(np.searchsorted(names, leaves), len(names) - 1)
        here = names[place] == leaves
        may = np.zeros((len(reps), len(names)), dtype=bool)
        may[asker[here], place[here]] = True
        q, r, score = best_of(vectors, rows[3], rows[1], keep, leaf, may)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (reps[q], rows[0][r], rows[1][r], score)],
            names=["q", "rep", "first", "score"],
        )

    return run


def binned(leaves: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """Add ``bin``, and ``visited`` with the row's own leaf."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = {dim: tree.bins for dim, tree in trees.items()}
        for part in slices(batches, STEP * 4):
            dim, leaf = (part.column(c).to_numpy() for c in ("dim", "leaf"))
            bin_ = np.zeros(len(leaf), dtype=np.int64)
            for d in bins.keys() & set(np.unique(dim).tolist()):
                bin_[dim == d] = bins[d][leaf[dim == d]]
            yield part.append_column("bin", pa.array(bin_))

    kind = leaves.schema["vector"].dataType.simpleString()
    schema = f"rep bigint, dim int, first bigint, vector {kind}, leaf bigint, bin bigint"
    return leaves.mapInArrow(run, schema).withColumn("visited", F.array("leaf"))


def search(rows: DataFrame, asked: DataFrame, keep: int) -> DataFrame:
    """``q, rep, first, score``: the nearest distinct vectors that each routed query met."""
    per_bin = rows.groupBy("dim", "bin").agg(F.ceil(F.count("*") / TILE).alias("tiles"))
    per_ask = asked.groupBy("dim", "bin").agg(F.ceil(F.count("*") / ASKED).alias("parts"))
    sizes = saved(per_bin.join(per_ask, ["dim", "bin"]), "sizes")
    columns = ["dim", "bin", "tile", "part", "asks", "rep", "first", "visited", "vector"]
    given = tiled(rows, "tile", "part", sizes).withColumn("asks", F.lit(False))
    wanted = tiled(asked, "part", "tile", sizes).withColumn("asks", F.lit(True))
    both = given.select(columns).unionByName(
        wanted.withColumn("first", F.lit(0).cast("long")).select(columns)
    )
    keys = ["dim", "bin", "tile", "part"]
    gathered = both.repartition(*keys).sortWithinPartitions(*keys, "asks")
    found = gathered.mapInArrow(
        nearest_in_tiles(keep), "q bigint, rep bigint, first bigint, score double"
    )
    best = Window.partitionBy("q").orderBy(F.desc("score"), "first", "rep")
    few = found.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= keep)
    return few.drop("nth")


def answers(found: DataFrame, distinct: DataFrame, keep: int) -> DataFrame:
    """``rep, near``: the ``keep`` nearest rows to each query's vector, as (score, id, of)."""
    ids = distinct.select("rep", F.explode("ids").alias("id"))
    named = found.join(ids, "rep").select("q", "score", "id", F.col("rep").alias("of"))
    by = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"), "of")
    few = named.withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= keep)
    near = F.sort_array(F.collect_list(F.struct("nth", "score", "id", "of")))
    return few.groupBy(F.col("q").alias("rep")).agg(near.alias("near"))


def nearest_vectors(
    df: DataFrame, vec_id: str, embedding: str, nearest: int = NEAREST, asking: int = ASKING
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``nearest`` rows found for every query.

    Queries are the rows whose whole-number id ``asking`` divides, candidates all other
    rows; of repeated rows each is a query or candidate of its own. Nearest means the
    largest cosine; ties go to the smaller id, null ids last. A query has fewer rows only
    if there are fewer candidates. Vectors that are null, empty or zero or hold null or
    non-finite components take no part, and vectors of different lengths are no
    candidates for each other. Rows without an id are candidates and no queries. An empty
    table, or one without queries, gives no rows.
    """
    vector = df[embedding]
    rows = df.select(df[vec_id].cast("long").alias("id"), vector.alias("vector"))
    rows = rows.where(usable(F.col("vector")))
    distinct = distinct_vectors(rows, nearest + 1)
    queries = rows.where(F.col("id") % asking == 0)
    wanted = queries.select("vector").distinct()
    asked = saved(distinct.join(wanted, "vector", "left_semi").drop("ids"), "asked")
    trees = fit(distinct)
    leaves = saved(assigned(distinct, trees), "leaves")
    trials = saved(sampled(asked, TRIALS, asked.count(), 1), "trials")
    in_trees = leaves.where(F.col("dim").isin(list(trees)))
    for row in in_trees.groupBy("dim", "leaf").count().collect():
        trees[row["dim"]].rows[row["leaf"]] = row["count"]
    visits = calibrated(leaves, trials, trees, nearest)
    passed = saved(routed(asked, trees, visits, nearest + 1), "routed")
    found = saved(search(saved(binned(leaves, trees), "binned"), passed, nearest + 1), "found")
    near = answers(found, distinct, nearest + 1)
    near = saved(near.join(distinct.select("rep", "vector"), "rep"), "near")
    # A query's own row is one of those of its vector.
    own = F.array_position(
        F.transform("near", lambda s: (s["of"] == F.col("rep")) & s["id"].eqNullSafe(F.col("id"))),
        True,
    )
    others = F.filter("near", lambda s, i: i + 1 != own)
    each = F.posexplode(F.slice(others, 1, nearest)).alias("at", "s")
    return queries.join(near, "vector").select("id", each).select(
        F.col("id").alias("query_id"),
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("s.id").alias("vec_id"),
        F.col("s.score").alias("score"),
    )
