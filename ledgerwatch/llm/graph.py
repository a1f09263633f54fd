"""Connected components of an undirected graph, as joins and groupings of its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .base import Workspace


def _nearest(edges: DataFrame, work: Workspace) -> DataFrame:
    """Large step: every larger neighbour of a node moves to the smallest node around it."""
    both = edges.select(F.col("child").alias("node"), F.col("parent").alias("other")).unionByName(
        edges.select(F.col("parent").alias("node"), F.col("child").alias("other"))
    )
    least = both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
    least = work.stored(least, "least")  # a join of two plain shuffles, whose hot keys Spark splits
    moved = both.where("other > node").join(least, "node")
    return moved.where("other > least").select(F.col("other").alias("child"), F.col("least").alias("parent")).distinct()


def _gather(edges: DataFrame, work: Workspace) -> DataFrame:
    """Small step: a node and all its parents move to the smallest of them."""
    least = work.stored(edges.groupBy("child").agg(F.min("parent").alias("least")), "least")
    joined = edges.join(least, "child")
    return (
        joined.select(F.col("parent").alias("child"), F.col("least").alias("parent"))
        .where("child > parent")
        .unionByName(joined.select("child", F.col("least").alias("parent")))
        .distinct()
    )


def components(edges: DataFrame, work: Workspace, most_rounds: int = 60) -> DataFrame:
    """``child`` and ``parent``: each node but the smallest of its component, and that smallest.

    ``edges`` holds ``child`` > ``parent`` as longs. Both steps keep the
    components and only ever move edges towards smaller nodes; the number of
    rounds grows with the logarithm of a component's diameter. Each round is
    stored in the workspace, as is the result. The largest group of any step is only ever
    aggregated to its minimum, and joined by Spark's skew-splitting join.
    """
    edges = work.stored(edges.distinct(), "edges")
    for _ in range(most_rounds):
        # Done when every edge leads from a node with one parent to a node with none.
        many = edges.groupBy("child").count().where("count > 1").select(F.lit(1).alias("open")).limit(1)
        deep = edges.join(edges.select(F.col("parent").alias("child")).distinct(), "child", "left_semi").select(F.lit(1).alias("open")).limit(1)
        if many.isEmpty() and deep.isEmpty():
            return edges
        edges = work.stored(_gather(work.stored(_nearest(edges, work), "edges"), work), "edges")
    raise RuntimeError("components did not settle")
