"""Connected components of an edge table, by star contraction in stored rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomframe.llm.shared import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("least"))
    return both.filter(F.col("b") > F.col("a")).join(least, "a") \
        .select(F.col("b").alias("a"), F.col("least").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("least"))
    return down.join(least, "a").select(F.col("b").alias("a"), F.col("least").alias("b")) \
        .unionByName(least.select("a", F.col("least").alias("b"))).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of edges (a, b): the smallest node it can reach.

    Rounds grow with the logarithm of the longest path. A node with very many neighbours
    is spread by map-side aggregates and by splitting skewed joins.
    """
    edges = stored(edges.filter("a <> b").distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    last = None
    while True:
        edges = stored(_small_star(_large_star(edges)))
        state = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if state == last:
            break
        last = state
    roots = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
