"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def _directed(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _least(edges: DataFrame) -> DataFrame:
    """Each node's least neighbour or itself; pre-aggregated before the shuffle."""
    return edges.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """``links``: a, b (longs). Returns node, root: every node with a link, and its component's least node.

    Each round cuts lineage in the shared checkpoint folder. Stars make the number of rounds grow
    with the logarithm of a component's width; where ``rounds`` are not enough an error is raised, as the
    result would be incomplete. No links give an empty table.
    """
    edges = cut(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    last = None
    for _ in range(rounds):
        both = _directed(edges)
        # Large star: a node's greater neighbours are linked to its least one.
        large = both.join(_least(both), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # Small star: a node and its lesser neighbours are linked to the least of them (edges run from greater to lesser).
        small = large.join(large.groupBy("a").agg(F.min("b").alias("m")), "a")
        edges = cut(small.select(F.col("b").alias("a"), F.col("m").alias("b")).union(small.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == last:
            break
        last = state
    else:
        raise RuntimeError(f"components are not settled after {rounds} rounds")
    found = edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return found.union(edges.select(F.col("b").alias("node"), F.col("b").alias("root"))).groupBy("node").agg(F.min("root").alias("root"))
