"""Connected components of an edge list by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vetline.session import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's smallest neighbour (itself included)."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("m", "a"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node and its smaller neighbours are tied to the smallest of them; edges run from larger to smaller."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """From pairs (a, b) of ids: (node, label) with the smallest id that each node reaches.

    Direction, repeats and loops do not matter; pairs with a null are left out. No edges give no rows.
    Each round is a written table in the shared folder; rounds grow with the logarithm of the longest path.
    """
    edges = edges.toDF("a", "b").filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = materialize(edges, "edges"), None
    while True:
        count = edges.agg(F.count("*").alias("n"), F.expr("count(distinct b)").alias("roots"), F.expr("bit_xor(xxhash64(a, b))").alias("sum")).first()
        if before == tuple(count):
            break
        before = tuple(count)
        edges = materialize(_small_star(_large_star(edges)), "edges")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(edges.select("b", "b").distinct())
