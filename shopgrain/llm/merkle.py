"""A Merkle manifest that stores few of its levels and recomputes the others for proofs.

Every group of rows is a tree whose leaves are in the order of their keys, and the roots
of these trees are the leaves of one more tree. Three consecutive nodes make a parent.
Only every third level is written, packed by aligned subtree: a row holds the up to 27
stored nodes below one stored node. A proof goes from the top down: the nodes between
two stored levels are recomputed from the packed row, each stored node takes its
siblings from them and the rest of its way from the row above, and the recomputed nodes
are dropped with the row. A row that is read or made is bounded whatever the size of a
tree, so a tree that holds most of all leaves is spread like any other.

Places in a tree come from a range partitioning and a sum of counts over its partitions,
never from a window over a whole tree.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shopgrain.plans.saving import saved

#: Children of a node.
ARITY = 3
#: Levels from a stored one to the next.
EVERY = 3
#: Stored nodes of a packed row at most.
WIDTH = ARITY**EVERY


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """A field with its length in bytes, so that no two rows read alike."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def ranked(rows: DataFrame, by: list[str]) -> DataFrame:
    """Add ``pos``, the place in the ``tree`` in the order of ``by``, and the tree's ``size``.

    ``by`` must be a total order; nulls come first.
    """
    order = ["tree", *by]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = saved(dealt.withColumn("at", F.monotonically_increasing_id()), "sorted")
    dealt = dealt.withColumn("part", F.shiftright("at", 33))
    runs = dealt.groupBy("tree", "part").agg(F.min("at").alias("start"), F.count("*").alias("n"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        "tree",
        "part",
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("start")).alias("shift"),
        F.sum("n").over(tree).alias("size"),
    )
    placed = dealt.join(saved(runs, "runs"), ["tree", "part"])
    return placed.withColumn("pos", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def parents(nodes: Column) -> Column:
    """The digests a level above a list of digests; the last run may be shorter."""
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / ARITY).cast("int"))
    return F.transform(
        runs, lambda k: digest(F.array_join(F.slice(nodes, k * ARITY + 1, ARITY), ""))
    )


def depth() -> Column:
    """How many levels of its tree lie in a packed row, from the tree's size at its lowest."""
    below = [F.when(F.col("size") > ARITY**k, 1).otherwise(0) for k in range(EVERY)]
    return reduce(Column.__add__, below)


def packed(nodes: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """A row per aligned subtree: its stored nodes in order."""
    block = F.expr(f"pos div {WIDTH}").alias("block")
    members = F.sort_array(F.collect_list(F.struct("pos", "digest", *carry)))
    return nodes.groupBy("tree", block).agg(
        members.alias("members"), F.first("size").alias("size")
    )


def regrown(rows: DataFrame) -> DataFrame:
    """Add ``tiers``: the stored digests of a packed row and all levels above them."""
    lowest = F.transform("members", lambda m: m["digest"])
    turns = F.slice(F.array(*(F.lit(k) for k in range(EVERY))), 1, depth())
    tiers = F.aggregate(
        turns,
        F.array(lowest),
        lambda acc, _: F.concat(acc, F.array(parents(F.element_at(acc, -1)))),
    )
    return rows.withColumn("tiers", tiers)


def tops(rows: DataFrame) -> DataFrame:
    """The next stored level: the root of each packed row."""
    return regrown(rows).select(
        "tree",
        F.col("block").alias("pos"),
        F.ceil(F.col("size") / WIDTH).cast("long").alias("size"),
        F.element_at(F.element_at("tiers", -1), 1).alias("digest"),
    )


def siblings(j: Column) -> Column:
    """Per level of a packed row: what stands left and right in the run of member ``j``."""
    levels = F.array(*(F.struct(F.lit(k).alias("k"), F.lit(ARITY**k).alias("w")) for k in range(EVERY)))

    def step(level: Column) -> Column:
        at = F.floor(j / level["w"]).cast("int")
        tier, nth = F.get("tiers", level["k"]), at % ARITY
        return F.struct(
            F.array_join(F.slice(tier, at - nth + 1, nth), "").alias("left"),
            F.array_join(F.slice(tier, at + 2, F.lit(ARITY - 1) - nth), "").alias("right"),
        )

    return F.transform(F.slice(levels, 1, depth()), step)


def down(rows: DataFrame, above: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``pos``, ``digest`` and ``path`` of each stored node of packed rows.

    ``above`` has the path of each packed row's root as ``tree, block, path`` and what
    else its tree's rows shall have.
    """
    kept = [c for c in above.columns if c not in ("tree", "block", "path")]
    grown = regrown(rows.join(above, ["tree", "block"]))
    each = F.transform(
        "members",
        lambda m, j: F.struct(
            *(m[c].alias(c) for c in ("pos", "digest", *carry)),
            F.concat(siblings(j), "path").alias("path"),
        ),
    )
    return grown.select("tree", *kept, F.explode(each).alias("node")).select(
        "tree", *kept, "node.*"
    )


@dataclass
class Tree:
    """The stored levels of a set of trees, the lowest first; ``roots`` has ``tree, digest``."""

    tiers: list[DataFrame]
    roots: DataFrame
    carry: tuple[str, ...]

    def proofs(self, above: DataFrame) -> DataFrame:
        """``path`` of every leaf, up through the path of its tree's root in ``above``."""
        way = above.withColumn("block", F.lit(0).cast("long"))
        for tier in reversed(self.tiers[1:]):
            way = saved(down(tier, way).drop("digest").withColumnRenamed("pos", "block"), "paths")
        return down(self.tiers[0], way, self.carry)


def build(leaves: DataFrame, by: list[str], carry: tuple[str, ...] = ()) -> Tree:
    """Write the stored levels of all trees over ``leaves`` (``tree, digest``, ``by``, ``carry``).

    Levels are as many as the largest tree asks for; a smaller one, finished early, goes
    up unchanged.
    """
    tiers = [saved(packed(ranked(leaves, by), carry), "tier")]
    largest = tiers[0].agg(F.max("size")).first()[0] or 0
    while WIDTH ** len(tiers) < largest:
        tiers.append(saved(packed(tops(tiers[-1])), "tier"))
    return Tree(tiers, saved(tops(tiers[-1]).select("tree", "digest"), "roots"), carry)


def folded(start: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate("path", start, lambda h, s: digest(s["left"], h, s["right"]))


def manifest(leaves: DataFrame, by: list[str], carry: tuple[str, ...]) -> DataFrame:
    """``leaves`` with ``subroot``, ``root`` and ``path`` to the root of all trees.

    ``tree`` names each leaf's tree (a string, not null) and orders the trees; ``digest``
    is the leaf. A path has a struct of the digests ``left`` and ``right`` of the node per
    level, from the leaf up. No leaves give no rows.
    """
    trees = build(leaves, by, carry)
    roots = trees.roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    top = build(roots, ["name"], ("name",))
    root = top.roots.first()
    way = top.roots.select("tree", F.expr("cast(array() as array<struct<left: string, right: string>>)").alias("path"))
    above = top.proofs(way).select(
        F.col("name").alias("tree"), F.col("digest").alias("subroot"), "path"
    )
    found = trees.proofs(saved(above, "above"))
    return found.withColumn("root", F.lit(root and root["digest"]).cast("string"))


def document_proofs(
    df: DataFrame, doc_id: str, source: str, lang: str, n_chars: str, text: str
) -> DataFrame:
    """Digests, proof and verdict per document; some texts are tampered with to be caught.

    A leaf hashes id, source, language, length and text, each as its number of bytes in
    UTF-8 and its value, or ``-`` where it is null. Leaves of a source ascend by id, nulls
    first, then by digest; rows that are equal are leaves of their own and take any order.
    Rows without a source are a tree of their own. Where the CRC-32 of the id in decimals
    is even, the text loses its line feeds before it is verified; null texts and rows
    without an id are left as they are. Ids of any type count by their text; other columns
    are ignored. An empty table gives no rows.
    """
    given = df.select(
        df[doc_id].alias("id"),
        df[source].cast("string").alias("source"),
        df[lang].alias("lang"),
        df[n_chars].alias("n"),
        df[text].alias("text"),
    )
    even = F.crc32(F.col("id").cast("string").cast("binary")) % 2 == 0
    feeds = F.col("text").contains("\n")

    def leaf(content: Column) -> Column:
        return digest(*(framed(F.col(c)) for c in ("id", "source", "lang", "n")), framed(content))

    leaves = given.select(
        # The empty name is free for rows without a source and comes first.
        F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("tree"),
        "id",
        leaf(F.col("text")).alias("digest"),
        F.when(even & feeds, leaf(F.replace("text", F.lit("\n"), F.lit("")))).alias("tampered"),
        F.monotonically_increasing_id().alias("tie"),
    )
    proven = manifest(saved(leaves, "leaves"), ["id", "digest", "tie"], ("id", "tampered"))
    proof = F.transform("path", lambda s: F.concat(s["left"], s["right"]))
    return proven.select(
        F.col("id").alias(doc_id),
        F.col("digest").alias("leaf"),
        "subroot",
        "root",
        digest(F.array_join(proof, "")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "digest")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
