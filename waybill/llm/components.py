"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.join(least, "a").where("b > a and b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of an edge, the component being its smallest node.

    ``edges`` has columns ``a`` and ``b`` of one ordered type. Loops and rows
    with a null are no edges; repeated edges count once. Without edges the result
    is empty. Each round is a written table, so a lost executor costs one round.
    The rounds end when only stars are left; all steps aggregate and join by
    node, and a hot node is pre-aggregated before the shuffle.
    """
    now = edges.select("a", "b").where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now = written(now.distinct(), "edges")
    while not _settled(now):
        now = written(_small_star(_large_star(now)), "stars")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )


def _settled(edges: DataFrame) -> bool:
    """Whether all edges are stars: a node has one edge down, or else only edges up."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    return ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where(
        "down > 1 or (down = 1 and up = 1)").isEmpty()
