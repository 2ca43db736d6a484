"""Connected components of a graph that no machine holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stored


def _smallest(edges: DataFrame) -> DataFrame:
    """Per node ``u`` its smallest neighbour, written so that a join with a hub can be split."""
    return stored(edges.groupBy("u").agg(F.min("v").alias("m")), "components-min")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest node around it."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _smallest(both).select("u", F.least("m", "u").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest of them."""
    least = _smallest(edges)
    moved = edges.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, root) for every node of ``links``; the root is the component's smallest node.

    Alternates the large-star and small-star steps of Kiveris et al. until the
    edges stay the same. Each step moves at most a row per edge and never brings
    a component together; each round is written to the shared folder.
    """
    edges = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    edges = stored(edges, "components-edges")
    before = None
    while (now := _state(edges)) != before:
        before = now
        edges = stored(_small_star(_large_star(edges).distinct()).distinct(), "components-edges")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
