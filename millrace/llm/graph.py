"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import staged


def _large_star(edges: DataFrame) -> DataFrame:
    """Neighbours larger than a node go to the smallest node around it."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    return both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours go to the smallest of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("low"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(least.select("a", "low")).filter("a != b")


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node that has a link; the label is the smallest node around.

    Alternating stars: each round is written, and ends with one number on the driver.
    """
    edges, before = staged(links.filter("a != b").distinct(), "edges"), None
    while True:
        edges = staged(_small_star(_large_star(edges).distinct()).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
        edges.select("b", "b").distinct())
