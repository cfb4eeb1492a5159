"""Connected components as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fitmesh.llm.storage import cut, once


def _open(e: DataFrame) -> bool:
    """Whether some node has two smaller neighbours, or smaller and larger ones; else the edges are stars around their smallest nodes."""
    ends = e.select(F.col("hi").alias("u"), F.lit(1).alias("up")).unionAll(e.select(F.col("lo").alias("u"), F.lit(0).alias("up")))
    with once(e.sparkSession):
        return not ends.groupBy("u").agg(F.sum("up").alias("up"), F.min("up").alias("is_hi")).where("up > 1 or up = 1 and is_hi = 0").isEmpty()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, component)`` of every node that an edge names; the component is its smallest node.

    Alternating stars: each node hands its larger neighbours to the smallest node it knows, then its smaller ones.
    The number of edges never grows, a node's neighbours are never gathered in one row, and rounds grow with the
    logarithm of the longest path. Loops, repeated edges and edges with a null end are harmless: a null end is
    dropped, and a loop makes its node a component of its own unless other edges join it.
    """
    edges = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    lone = edges.where("a = b").select(F.col("a").alias("node"))
    e = cut(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct())
    while _open(e):
        both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionAll(e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).distinct()
        large = cut(large)
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        down = large.join(least, "hi").where("lo > m").select(F.col("m").alias("lo"), F.col("lo").alias("hi"))
        e = cut(down.unionAll(least.select(F.col("m").alias("lo"), "hi")).distinct())
    stars = e.select(F.col("hi").alias("node"), F.col("lo").alias("component"))
    roots = e.select(F.col("lo").alias("node")).distinct().select("node", F.col("node").alias("component"))
    alone = lone.distinct().join(stars.select("node").unionAll(roots.select("node")), "node", "left_anti")
    return stars.unionAll(roots).unionAll(alone.select("node", F.col("node").alias("component")))
