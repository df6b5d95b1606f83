"""Connected components of a link table, as Spark joins (large-star / small-star)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Every edge with its node's least neighbour ``m``.

    Joined on a mark made of the node, not on the node itself: the aggregate's partitioning then does
    not serve the join, the planner shuffles both sides for it, and AQE may split a node that holds a
    large share of all edges.
    """
    mark = F.col("a").bitwiseXOR(F.lit(1)).alias("mark")
    return edges.select("a", "b", mark).join(least.select("m", mark), "mark").drop("mark")


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours move to the least node it knows."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return _with_least(both, least).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours move to the least of them (edges point downwards)."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = _with_least(edges, least)
    return (moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``(node, root)`` for every node of the links ``(a, b)``; root: the component's least node.

    Alternates large-star and small-star until the table of edges stands still. Links stay in
    Spark throughout, and every round is checkpointed. Self links and repeated links are ignored;
    no links give no rows. Raises if ``max_rounds`` do not suffice (they grow with the logarithm
    of the table), rather than return part of an answer.
    """
    edges = (links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .distinct().checkpoint())
    before = None
    for _ in range(max_rounds):
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before = state
        edges = _small_star(_large_star(edges)).checkpoint()
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
