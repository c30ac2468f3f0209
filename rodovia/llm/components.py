"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rodovia.llm.tables import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the edges (a, b) of bigint; component is the smallest node.

    Each step replaces edges by links to the smallest neighbour; the edge table never grows beyond its first
    size, and the number of steps grows with the logarithm of the number of nodes. Minima are pre-aggregated
    before the shuffle; the join with the minima is a plain sort-merge join, so AQE splits the partition of a
    node with very many neighbours.
    """
    edges = stored(_ordered(edges), "edges")
    while True:
        large = _large_star(edges)
        small = stored(_small_star(large), "edges")
        if small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty():
            break
        edges = small
    return (edges.select(F.col("low").alias("component"), F.col("high").alias("node"))
            .unionByName(edges.select(F.col("low").alias("component"), F.col("low").alias("node")).distinct())
            .select("node", "component"))


def _ordered(edges: DataFrame) -> DataFrame:
    return (edges.filter("a <> b").select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
            .distinct())


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the node's smallest neighbour (or itself)."""
    both = edges.select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(
        edges.select(F.col("high").alias("u"), F.col("low").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.filter("v > u").join(low, "u").select(F.col("m").alias("low"), F.col("v").alias("high"))
            .filter("low <> high").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Link a node and its smaller neighbours to the smallest of them."""
    low = edges.groupBy("high").agg(F.min("low").alias("m"))
    return (edges.join(low, "high").select("m", F.explode(F.array("low", "high")).alias("v"))
            .filter("m <> v").select(F.col("m").alias("low"), F.col("v").alias("high")).distinct())
