"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import shared_dir


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """(node, component) for the nodes of undirected edges (a, b): the component is its least node.

    Each round is two group-bys with partial aggregation and two joins over a number of edges that does not grow; its
    result is checkpointed in the shared folder. It ends when a round changes nothing (after about the logarithm of
    the largest component's size rounds) and fails after `rounds`. Null ends and loops are left out.
    """
    shared_dir(edges.sparkSession)
    now = edges.select("a", "b").filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = now.checkpoint(), None
    for _ in range(rounds):
        now = small_star(large_star(now)).checkpoint()
        row = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long")), F.bit_xor(F.xxhash64("a", "b"))).first()
        if before == row:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        before = row
    raise RuntimeError(f"no end of the components after {rounds} rounds")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the least of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("least"))
    out = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return out.filter("a <> b").distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are linked to the least of those; edges have the larger end in a."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    moved = edges.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b"))
    return moved.union(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()
