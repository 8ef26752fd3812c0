"""Connected components of a graph given by its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import stored

MAX_ROUNDS = 64


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root`` for every node of ``edges(a, b)``; nodes of one component share a root.

    Each round points every node at its smallest neighbour (if smaller), follows the pointers to their
    ends, doubling the reach at each step, and replaces the edges by those between the ends. Only nodes
    without a smaller neighbour are left, at most half of them, and the edges are written anew: rounds
    grow with the logarithm of the nodes, steps with that of the longest chain, and a lost executor
    costs one step. Minima are combined before the shuffle and joins on a hub are split by Spark.
    """
    current = stored(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    roots: DataFrame | None = None
    for _ in range(MAX_ROUNDS):
        if current.isEmpty():
            break
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        nearest = both.groupBy("a").agg(F.min("b").alias("b"))
        parents = stored(nearest.select(F.col("a").alias("node"), F.least("a", "b").alias("up")), "parents")
        while True:
            above = parents.select(F.col("node").alias("up"), F.col("up").alias("top"))
            further = parents.join(above, "up").select("node", F.col("top").alias("up"), (F.col("top") < F.col("up")).alias("moved"))
            parents = stored(further, "parents")
            if parents.filter("moved").isEmpty():
                break
            parents = parents.select("node", "up")
        if roots is None:
            roots = parents.select("node", F.col("up").alias("root"))
        else:
            moved = parents.select(F.col("node").alias("root"), "up")
            roots = roots.join(moved, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
        roots = stored(roots, "roots")
        a = parents.select(F.col("node").alias("a"), F.col("up").alias("x"))
        b = parents.select(F.col("node").alias("b"), F.col("up").alias("y"))
        moved = current.join(a, "a").join(b, "b").filter("x <> y")
        current = stored(moved.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
    else:
        raise RuntimeError("components did not settle")
    if roots is None:
        return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots
