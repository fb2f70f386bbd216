"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def _lowest(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each ``u``, stored so that the join with it can split a hot ``u``."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "w"), "lowest")


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each larger neighbour to the smallest node around."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _lowest(both)
    return both.join(low, F.col("u") == F.col("w")).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its smaller neighbours to the smallest of them."""
    low = _lowest(edges)
    moved = edges.join(low, F.col("u") == F.col("w")).filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct()


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) for each node in the links (a, b); root is the smallest node of its component, itself included.

    Nodes are longs. Null ends and links of a node with itself are ignored; no links give no rows.
    """
    edges = links.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = stored(edges, "edges")
    mark = None
    for _ in range(rounds):
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        mark = now
    raise RuntimeError(f"components did not settle in {rounds} rounds")
