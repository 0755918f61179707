"""Connected components of a link table, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemark.session import cut_lineage


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of a link; the component is its smallest node.

    Alternates two star steps: every node hands its larger neighbours, then its smaller ones, to its
    smallest neighbour. Both keep the components and end in stars around the smallest nodes after a number
    of rounds that grows with the logarithm of the size. Each round is checkpointed, no round collects rows.
    """
    edges = cut_lineage(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    seen = None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if not state["n"] or tuple(state) == seen:
            break
        seen = tuple(state)
        edges = cut_lineage(_small_star(_large_star(edges)))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), "m")
    joined = edges.join(least, F.col("u") == F.col("x"))
    moved = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct()
