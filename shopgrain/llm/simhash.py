"""SimHash near-duplicates through a Gray-order hierarchical index.

A fingerprint is the bitwise majority over the hashes of a text's word shingles.
Fingerprints that differ in few bits agree in whole blocks of bits: with
``max_bits`` differences over ``max_bits + 2`` blocks at least two blocks are free
of them. So every pair of blocks is a top node of the index, split by its masked bit
pattern, and two linked fingerprints meet below one of them. Below a top node the
fingerprints are sorted by Gray rank; runs of neighbours become leaves and runs of
nodes become upper nodes, each factored into the bits that all of its members share.
Comparing two nodes adds up the differences of shared bits: a pair over the limit is
dropped as a whole, a pair that cannot exceed it is linked as a whole.

A top node with very many fingerprints is not gathered in one task: it is split again
by pairs of blocks of its remaining bits. Distinct fingerprints run out of free bits
after a few such turns, so the size of what a task gathers has a bound on any data.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.plans.saving import saved

from .arrow import map_rows
from .components import components

SEED = 42
BITS = 64
#: The most fingerprints that one task gathers below a top node.
NODE = 1 << 14
#: Fingerprints of a leaf, nodes of an upper node.
LEAF, FAN = 32, 8
#: Pairs of members looked at in one step.
PAIRS = 1 << 20


def fingerprint(text: str | None, words: int) -> int:
    """The 64-bit fingerprint, unsigned; zero without words.

    A-Z are lower-cased; words are runs of anything but ASCII white space; fewer words
    than a shingle has form one shingle.
    """
    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = ends[min(words, len(parts)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = [
        digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), last.tolist(), strict=False)
    ]
    ones = np.zeros(BITS, dtype=np.int64)
    for start in range(0, len(hashes), 1 << 15):
        part = np.array(hashes[start : start + (1 << 15)], dtype="<u8")
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    major = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(major.view("<u8")[0])


def fingerprints(df: DataFrame, text: str, keep: list[str], words: int) -> DataFrame:
    """``keep`` and ``fp bigint``, the fingerprint as a signed number."""

    def make():
        def rows(texts):
            made = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64)
            return (pa.array(made.view(np.int64)),)

        return rows

    return map_rows(df, keep, [text], "fp bigint", make)


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The places of binary words in the Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def block_masks(free: int, blocks: int, untouched: int) -> list[int]:
    """Masks of ``untouched`` of ``blocks`` even blocks of the set bits of ``free``."""
    bits = [i for i in range(BITS) if free >> i & 1]
    cuts = [round(i * len(bits) / blocks) for i in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[a:z]) for a, z in itertools.pairwise(cuts)]
    return [sum(chosen) for chosen in itertools.combinations(parts, untouched)]


def signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def nodes(prints: DataFrame, max_bits: int) -> DataFrame:
    """The next top nodes (``mask, pattern``) of each fingerprint (``fp, mask``)."""
    blocks = max_bits + 2
    shared = {0: block_masks((1 << BITS) - 1, blocks, 2)}
    if "mask" not in prints.columns:
        masks = F.array(*(F.lit(signed(m)) for m in shared[0]))
        spread = prints.select("fp", F.explode(masks).alias("mask"))
    else:
        # Below a split node: pairs of blocks of the bits that its mask leaves free.
        turns = prints.select("mask").distinct().orderBy("mask").collect()
        table = {r.mask: block_masks(~r.mask & ((1 << BITS) - 1), blocks, 2) for r in turns}
        pairs = itertools.chain.from_iterable(
            (F.lit(m), F.array(*(F.lit(signed((m & ((1 << BITS) - 1)) | x)) for x in found)))
            for m, found in table.items()
        )
        lookup = F.create_map(*pairs)
        spread = prints.select("fp", F.explode(lookup[F.col("mask")]).alias("mask"))
        spread = spread.distinct()
    return spread.withColumn("pattern", F.col("fp").bitwiseAND(F.col("mask")))


def links(prints: DataFrame, max_bits: int, node: int = NODE) -> DataFrame:
    """Edges ``a, b`` that connect distinct fingerprints (``fp``) as all pairs within
    ``max_bits`` would; only a spanning part of the pairs is returned."""
    found: list[DataFrame] = []
    work = nodes(prints, max_bits)
    while True:
        work = saved(work, "nodes")
        large = saved(
            work.groupBy("mask", "pattern").count().where(F.col("count") > node).drop("count"),
            "large",
        )
        split = not large.isEmpty()
        small = work.join(large, ["mask", "pattern"], "left_anti") if split else work
        gathered = small.repartition("mask", "pattern").sortWithinPartitions("mask", "pattern")
        found.append(saved(gathered.mapInArrow(link_groups(max_bits), "a bigint, b bigint"), "links"))
        if not split:
            break
        work = nodes(work.join(large, ["mask", "pattern"]).select("fp", "mask"), max_bits)
    return found[0] if len(found) == 1 else union(found)


def union(frames: list[DataFrame]) -> DataFrame:
    first, *rest = frames
    for df in rest:
        first = first.unionByName(df)
    return first


def link_groups(max_bits: int):
    """Link within runs of equal (mask, pattern) of sorted batches."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), dtype=np.int64)
        names = ("mask", "pattern", "fp")
        for batch in batches:
            new = np.stack([batch.column(n).to_numpy() for n in names])
            held = np.concatenate((held, new), axis=1)
            changes = np.flatnonzero((held[:2, 1:] != held[:2, :-1]).any(axis=0)) + 1
            if len(changes):
                yield pairs_batch(*grouped_links(held[:, : changes[-1]], max_bits))
                held = held[:, changes[-1] :]
        if held.shape[1]:
            yield pairs_batch(*grouped_links(held, max_bits))

    return run


def pairs_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])


def grouped_links(rows: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    starts = np.flatnonzero((rows[:2, 1:] != rows[:2, :-1]).any(axis=0)) + 1
    starts = np.concatenate(([0], starts))
    sizes = np.diff(np.concatenate((starts, [rows.shape[1]])))
    prints = rows[2].view(np.uint64)
    found_a, found_b = [], []
    for size in np.unique(sizes[(sizes > 1) & (sizes <= LEAF)]):
        # All groups of one size, each a leaf of its own, at once.
        first = starts[sizes == size]
        i, j = np.triu_indices(size, 1)
        step = max(1, PAIRS // len(i))
        for at in range(0, len(first), step):
            part = first[at : at + step, None]
            a, b = prints[part + i], prints[part + j]
            near = np.bitwise_count(a ^ b) <= max_bits
            found_a.append(a[near])
            found_b.append(b[near])
    for start, size in zip(starts[sizes > LEAF], sizes[sizes > LEAF], strict=True):
        a, b = Index(prints[start : start + size]).links(max_bits)
        found_a.append(a)
        found_b.append(b)
    empty = np.zeros(0, dtype=np.uint64)
    a = np.concatenate([empty, *found_a]).view(np.int64)
    return a, np.concatenate([empty, *found_b]).view(np.int64)


class Index:
    """The hierarchical index below one top node."""

    def __init__(self, prints: np.ndarray):
        self.prints = prints[np.argsort(gray_rank(prints), kind="stable")]
        self.levels = [self.factored(self.prints, np.full(len(prints), ~np.uint64(0)), LEAF)]
        while len(self.levels[-1][0]) > FAN:
            self.levels.append(self.factored(*self.levels[-1], FAN))
        self.parent = np.arange(len(prints))

    @staticmethod
    def factored(patterns: np.ndarray, masks: np.ndarray, fan: int):
        """Nodes over runs of ``fan`` members: the pattern and mask of their shared bits."""
        at = np.arange(0, len(patterns), fan)
        ones = np.bitwise_and.reduceat(patterns & masks, at)
        zeros = np.bitwise_and.reduceat(~patterns & masks, at)
        return ones, ones | zeros

    def roots(self, x: np.ndarray) -> np.ndarray:
        up = self.parent[x]
        while (up != x).any():
            self.parent[x] = self.parent[up]
            x, up = up, self.parent[up]
        return x

    def union(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            a, b = self.roots(a), self.roots(b)
            a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
            np.minimum.at(self.parent, b, a)

    def links(self, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
        top = len(self.levels) - 1
        i, j = np.triu_indices(len(self.levels[top][0]))
        stack = [(top, i, j)]
        while stack:
            level, i, j = stack.pop()
            fan = FAN if level else LEAF
            if len(i) > max(1, PAIRS // fan**2):
                half = len(i) // 2
                stack += [(level, i[half:], j[half:]), (level, i[:half], j[:half])]
                continue
            ones, masks = self.levels[level]
            both = masks[i] & masks[j]
            least = np.bitwise_count((ones[i] ^ ones[j]) & both).astype(np.int64)
            most = least + np.bitwise_count(~both)
            span = LEAF * FAN**level
            whole = most <= max_bits
            self.link_whole(i[whole], j[whole], span)
            open_ = (least <= max_bits) & ~whole & ~self.joined(i, j, span)
            i, j = i[open_], j[open_]
            if not len(i):
                continue
            if level:
                below = len(self.levels[level - 1][0])
                stack.append((level - 1, *children(i, j, fan, below, own=True)))
            else:
                ci, cj = children(i, j, fan, len(self.prints), own=False)
                near = np.bitwise_count(self.prints[ci] ^ self.prints[cj]) <= max_bits
                self.union(ci[near], cj[near])
        root = self.roots(np.arange(len(self.prints)))
        other = root != np.arange(len(root))
        return self.prints[other], self.prints[root[other]]

    def link_whole(self, i: np.ndarray, j: np.ndarray, span: int) -> None:
        """Everything below both nodes lies within the limit of each other."""
        for node in np.unique(np.concatenate((i, j))):
            members = np.arange(node * span, min((node + 1) * span, len(self.prints)))
            self.union(members[1:], np.full(len(members) - 1, members[0]))
        self.union(i * span, j * span)

    def joined(self, i: np.ndarray, j: np.ndarray, span: int) -> np.ndarray:
        """Whether all fingerprints below both nodes are in one component already."""
        if not len(i):
            return np.zeros(0, dtype=bool)
        root = self.roots(np.arange(len(self.prints)))
        at = np.arange(0, len(self.prints), span)
        low, high = np.minimum.reduceat(root, at), np.maximum.reduceat(root, at)
        one = low == high
        return one[i] & one[j] & (low[i] == low[j])


def children(
    i: np.ndarray, j: np.ndarray, fan: int, below: int, own: bool
) -> tuple[np.ndarray, np.ndarray]:
    """Each pair of members of node pairs once; ``own`` adds members with themselves."""
    x, y = np.divmod(np.arange(fan * fan), fan)
    ci, cj = (i[:, None] * fan + x).ravel(), (j[:, None] * fan + y).ravel()
    keep = (ci < below) & (cj < below) & (ci <= cj if own else ci < cj)
    return ci[keep], cj[keep]


def near_duplicates(
    df: DataFrame,
    doc_id: str,
    text: str,
    words: int = 4,
    max_bits: int = 4,
    keep: tuple[str, ...] = (),
    group: str | None = None,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` and the columns of ``keep`` for every row.

    ``group`` names a further column that tells components apart whatever their ids are.

    ``fingerprint`` has 16 lowercase hex digits; ``component_id`` is the smallest id
    that links of at most ``max_bits`` differing bits reach, the row's own included.
    Null and blank texts have fingerprint zero and link like any other; repeated rows
    stay; a null id stays null and names no component; an empty table gives no rows.
    Copies of a fingerprint are one node, so they cost no links.
    """
    kept = [f"kept_{i}" for i in range(len(keep))]
    named = fingerprints(df, text, [doc_id, *keep], words).toDF("doc_id", *kept, "fp")
    docs = saved(named, "fingerprints")
    firsts = saved(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(firsts.select("fp"), max_bits))
    rooted = firsts.join(roots, firsts.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    rooted = saved(rooted, "rooted")
    smallest = saved(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    by_print = saved(rooted.join(smallest, "root").drop("first"), "components")
    return docs.join(by_print, "fp").select(
        F.col("doc_id").alias(doc_id),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
        *(F.col(k).alias(c) for k, c in zip(kept, keep, strict=True)),
        *([F.col("root").alias(group)] if group else []),
    )
