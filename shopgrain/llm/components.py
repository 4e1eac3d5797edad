"""Connected components by random contraction.

Every round gives each node a fresh pseudorandom priority and moves it onto the
member of its closed neighbourhood with the smallest one; edges move along, loops
and repeated edges go. The number of nodes with edges falls by a constant factor per
round in expectation, whatever the shape of the graph, so long chains and stars of
millions end alike. Rounds are written to the shared folder: lineage stays short and
a lost executor costs at most a round. Joins read written tables directly, the form
in which adaptive execution splits a node with very many edges.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.plans.saving import saved


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, both bigint).

    Nodes are connected exactly if they have the same root, which is one of them.
    Loops, repeated edges and both directions are allowed; edges with a null are
    left out; no edges give no rows.
    """
    left = saved(tidy(edges), "edges")
    rounds: list[DataFrame] = []
    while not left.isEmpty():
        moves = saved(moved(left, len(rounds)), "moves")
        rounds.append(moves)
        left = saved(tidy(contracted(left, moves)), "edges")
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = rounds.pop()
    while rounds:
        later = roots.select(F.col("node").alias("to"), F.col("root").alias("last"))
        earlier = rounds.pop().withColumnRenamed("root", "to")
        roots = saved(
            earlier.join(later, "to", "left").select(
                "node", F.coalesce("last", "to").alias("root")
            ),
            "roots",
        )
    return roots


def tidy(edges: DataFrame) -> DataFrame:
    ends = edges.where("a != b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    )
    return ends.distinct()


def moved(edges: DataFrame, turn: int) -> DataFrame:
    """Where each node goes in this round."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def priority(name: str):
        return F.xxhash64(F.col(name), F.lit(turn))

    best = both.groupBy("a").agg(F.min_by("b", priority("b")).alias("b"))
    chosen = F.when(priority("a") < priority("b"), F.col("a")).otherwise(F.col("b"))
    return best.select(F.col("a").alias("node"), chosen.alias("root"))


def contracted(edges: DataFrame, moves: DataFrame) -> DataFrame:
    def to(name: str) -> DataFrame:
        return moves.select(F.col("node").alias(name), F.col("root").alias(f"to_{name}"))

    half = edges.join(to("a"), "a").select(F.col("to_a").alias("a"), "b")
    return half.join(to("b"), "b").select("a", F.col("to_b").alias("b"))
