"""Connected components of an edge table, by alternating large and small stars.

Each round is a group-by and a join on the node (a star's centre is one row on one side, so a hub's
edges can be split over tasks) and writes its edges to the shared folder. Rounds grow with the
logarithm of the longest chain. No component is gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctlens.llm.store import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Join every node's neighbours to the smallest of them and itself: the larger neighbours, or the smaller ones and itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    near = both if large else both.filter("v < u")
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    if large:
        moved = near.filter("v > u").join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
    else:
        moved = near.join(least, "u").select(F.col("m").alias("a"), F.col("v").alias("b"))
        moved = moved.unionByName(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return moved.filter("a < b").distinct()


def _same(now: DataFrame, before: DataFrame) -> bool:
    """Whether two sets of edges are equal: as many, and none of the one missing in the other."""
    return now.count() == before.count() and now.join(before, ["a", "b"], "left_anti").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges(a, b)``; the component is its smallest node."""
    now = written(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges", few_files=True)
    while not now.isEmpty():
        before, now = now, written(_stars(_stars(now, True), False), "edges", few_files=True)
        if _same(now, before):
            break
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.unionByName(now.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
