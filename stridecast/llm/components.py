"""Connected components of a graph that no machine holds whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stridecast.llm.tables import stage
from stridecast.operators.lookup import attach


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _with_least(links: DataFrame, neighbours: DataFrame) -> DataFrame:
    """``links`` with ``least``: of their end ``a`` and its neighbours the smallest.

    The smallest node of a large component has links to all of it: ``attach`` splits the
    links of such a node, if they are not joined by a broadcast.
    """
    least = neighbours.groupBy("a").agg(
        F.least(F.min("b"), F.col("a")).alias("least"), F.count(F.lit(1)).alias("n")
    )
    return attach(links, stage(least, "least"), ["a"], "n")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour."""
    near = _both_ways(edges)
    return _with_least(near.where("b > a"), near).select(F.col("b").alias("a"), F.col("least").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, are linked to the smallest."""
    smaller = edges.where("b < a")
    near = _with_least(smaller, smaller)
    ends = F.explode(F.array("a", "b")).alias("a")
    return near.select(ends, F.col("least").alias("b"))


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of the edges ``a, b``; root is the smallest node.

    Large-star and small-star steps alternate until the links no longer change; each
    round is written to the shared folder. Rows and repeated links never grow beyond
    the links given. Links with a null end and of a node to itself are left out.
    """
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "links",
    )
    before = None
    while True:
        large = stage(_large_star(edges), "large")
        edges = stage(_small_star(large).where("a <> b").distinct(), "links")
        state = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum")
        ).first()
        if state == before:
            break
        before = state
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return stars.unionByName(roots)
