"""One row per key, top rows, and ordered unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedupe(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in ``order``, which must leave no ties.

    Spark keeps only the first row of a key in every task before it shuffles
    (window group limit), so a key that fills the table moves one row per task.
    """
    ranked = df.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def latest(events: DataFrame, key: str = "asset", ts: str = "ts",
           tie: str = "event_id") -> DataFrame:
    """Latest event of every asset; equal times are settled by the event id."""
    return dedupe(events, [key], [F.col(ts).desc(), F.col(tie).desc()])


def preview(df: DataFrame, order: list[Column | str], n: int = 10) -> DataFrame:
    """First rows of a table in a stated order."""
    return df.orderBy(*order).limit(n)


def merge_edges(*edge_frames: DataFrame) -> DataFrame:
    """Edges of all sources, each once, at its first position.

    Sources count in the order given: all edges of the first come before those
    of the second. ``source`` and ``ord`` say where an edge was first seen, and
    sorting by them gives the dependency list of a consumer.
    """
    tagged = [edges.select("consumer", "dep", F.lit(i).alias("source"), F.col("ord").cast("bigint"))
              for i, edges in enumerate(edge_frames)]
    both = reduce(DataFrame.unionByName, tagged)
    # one plain minimum per source keeps this a hash aggregate, which a minimum of structs is not
    minima = [F.min(F.when(F.col("source") == i, F.col("ord"))).alias(f"_m{i}")
              for i in range(len(tagged))]
    first = both.groupBy("consumer", "dep").agg(F.min("source").alias("source"), *minima)
    return first.select("consumer", "dep", "source", F.coalesce(
        *[F.when(F.col("source") == i, F.col(f"_m{i}")) for i in range(len(tagged))]).alias("ord"))
