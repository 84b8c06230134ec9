"""Connected components of an undirected graph, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from parcelflow.llm.shared import written


def components(edges: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node of an edge; columns a and b, bigint.

    Each step links every node to the smallest of its neighbourhood, in two joins, and is written to the
    shared folder; the number of steps grows with the logarithm of the longest chain. A node with very
    many edges is a join key with very many rows, which Spark splits; nothing gathers a component in a task.
    """
    current = written(
        edges.filter("a <> b").select(F.greatest("a", "b").alias("src"), F.least("a", "b").alias("dst")).distinct(), "edges"
    )
    before = None
    while True:
        signature = tuple(current.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("src", "dst"))).first())
        if signature == before or signature[0] == 0:
            return current.select(F.col("src").alias("node"), F.col("dst").alias("component")).unionByName(
                current.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            )
        before = signature
        current = written(small_star(large_star(current)), "edges")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node linked to the smallest node of its neighbourhood."""
    both = edges.unionByName(edges.selectExpr("dst AS src", "src AS dst"))
    least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("least"))
    return both.join(least, "src").filter("dst > src").select(F.col("dst").alias("src"), F.col("least").alias("dst")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, linked to the smallest of them."""
    least = edges.groupBy("src").agg(F.min("dst").alias("least"))
    others = edges.join(least, "src").filter("dst <> least").select(F.col("dst").alias("src"), F.col("least").alias("dst"))
    return others.unionByName(least.select("src", F.col("least").alias("dst"))).distinct()
