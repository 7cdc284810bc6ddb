"""Connected components of a graph given by edges, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm.common import keep


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each vertex's larger neighbours to the least vertex around it."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each vertex's smaller neighbours, and itself, to the least of them. Edges go downwards."""
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """``vertex`` and ``root`` for every vertex with an edge to another one; ``root`` is the least reachable.

    ``edges`` has the columns ``a`` and ``b`` of one whole-number type. Each round's edges, no
    more than there are vertices after the first, are written to the shared folder, which ends
    the lineage. The number of rounds grows with the logarithm of the longest path.
    """
    down = edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    stars, seen = keep(down, "edges"), None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.hash("a", "b").cast("long"))).first()
        if state == seen or state[0] == 0:
            return stars.select(F.col("a").alias("vertex"), F.col("b").alias("root"))
        seen, stars = state, keep(_small_star(_large_star(stars)), "edges")
