"""Connected components of a graph in a DataFrame, by hooking and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.frames import cut


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component: the smallest node that each node of the edges reaches.

    Each round every node points to its smallest neighbour if that is smaller, pointers are
    followed twice, and the edges between what is left are drawn anew. Only nodes that no neighbour
    undercuts survive a round, so few rounds do; the frames between rounds are checkpointed.
    """

    def ordered(x, y) -> DataFrame:
        return F.least(x, y).alias("a"), F.greatest(x, y).alias("b")

    edges = cut(edges.select(*ordered(F.col(a), F.col(b))).where("a < b").distinct())
    labels = None
    while True:
        if edges.isEmpty():
            break
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        points = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("p"))
        for _ in range(2):
            further = points.select(F.col("u").alias("p"), F.col("p").alias("q"))
            points = points.join(further, "p").select("u", F.col("q").alias("p"))
        points = cut(points)
        if labels is None:
            labels = points.select(F.col("u").alias("node"), F.col("p").alias("component"))
        else:
            moved = points.select(F.col("u").alias("component"), F.col("p").alias("to"))
            labels = labels.join(moved, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
        ends = points.select(F.col("u").alias("a"), F.col("p").alias("x"))
        others = points.select(F.col("u").alias("b"), F.col("p").alias("y"))
        edges = cut(edges.join(ends, "a").join(others, "b").select(*ordered(F.col("x"), F.col("y"))).where("a < b").distinct())
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
