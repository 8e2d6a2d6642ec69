"""Table profiles and merged metadata."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def profile(df: DataFrame, table: str) -> DataFrame:
    """Column names and types with the row count, one row per column.

    Names and types come from the schema; only the rows are counted, for which
    Parquet needs no column data.
    """
    columns = F.array(*[
        F.struct(F.lit(i).alias("ord"), F.lit(f.name).alias("column"),
                 F.lit(f.dataType.simpleString()).alias("type"))
        for i, f in enumerate(df.schema.fields)])
    counted = df.agg(F.count(F.lit(1)).alias("row_count"))
    return counted.select(F.lit(table).alias("table"), "row_count", F.inline(columns))


def merge_metadata(user: DataFrame, auto: DataFrame) -> DataFrame:
    """Last write per asset and key; captured values never replace the user's.

    Both have ``(uri, key, value, seq)``. One aggregate over the union does what
    two aggregates and a full join would.
    """
    both = (user.select("uri", "key", "value", "seq", F.lit(True).alias("by_user"))
            .unionByName(auto.select("uri", "key", "value", "seq",
                                     F.lit(False).alias("by_user"))))
    by_user = F.col("by_user")

    def last(mine: Column) -> Column:
        # rows without an ordering value are left out of max_by
        return F.max_by("value", F.when(mine, F.col("seq")))
    return both.groupBy("uri", "key").agg(
        F.when(F.bool_or(by_user), last(by_user)).otherwise(last(~by_user)).alias("value"))
