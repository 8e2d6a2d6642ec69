"""Joins of facts, dimensions and one-row summaries.

No join here asks for a broadcast: Spark broadcasts a side when its measured
size is below ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles,
and AQE splits a shuffle partition in which one key holds too much.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.numbers import floor_ratio_or_zero

# Fixed value: currency of a region that has no data.
DEFAULT_CURRENCY = "USD"


def merge_kpis(*summaries: DataFrame) -> DataFrame:
    """One-row summaries side by side in one row.

    The rows are unioned and folded with one aggregate, so no product is
    planned and the summaries are computed side by side in one job. A name that
    two summaries use is an error: one of the two values would be lost.
    """
    names = [c.lower() for s in summaries for c in s.columns]
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"summaries share the columns {repeated}")
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), summaries)
    return stacked.agg(*[F.any_value(c, F.lit(True)).alias(c) for c in stacked.columns])


def daily_report(sales: DataFrame, customers: DataFrame, inventory: DataFrame,
                 amount: str, is_new: Column, is_active: Column, is_low: Column) -> DataFrame:
    """Sales, customer and inventory figures in one row.

    The figures are given, what counts as new, active or low is the caller's.
    """
    return merge_kpis(
        sales.agg(F.coalesce(F.sum(amount), F.lit(0)).alias("total"),
                  F.count(F.lit(1)).alias("count")),
        customers.agg(F.count_if(is_new).alias("new_signups"),
                      F.count_if(is_active).alias("active_users")),
        inventory.agg(F.count_if(is_low).alias("low_stock_items"),
                      F.count(F.lit(1)).alias("total_items")))


def enrich_orders(orders: DataFrame, customers: DataFrame, lines: DataFrame, parts: DataFrame,
                  order_key: str, customer_key: str, part_key: str) -> DataFrame:
    """Order lines with their order, customer and product columns.

    Customers and products are left joins, so an unknown key keeps its line.
    Orders meet their customers before the larger line table, when there are
    fewer rows to move.
    """
    known = orders.join(customers, customer_key, "left")
    return lines.join(known, order_key).join(parts, part_key, "left")


def feature_matrix(events: DataFrame, dims: DataFrame, key: str, kinds: list[str],
                   kind: str = "event_type", value: str = "value") -> DataFrame:
    """Event count and value sum per user and kind, joined to user attributes.

    Naming the kinds saves the job that would look them up. The aggregate runs
    before the join, so a user with very many events is one row by then.
    """
    counts = []
    for name in kinds:
        is_kind = F.col(kind) == name
        counts.append(F.count_if(is_kind).alias(f"{name}_count"))
        counts.append(F.coalesce(F.sum(F.when(is_kind, F.col(value))), F.lit(0.0))
                      .alias(f"{name}_value"))
    features = events.groupBy(key).agg(F.count(F.lit(1)).alias("events"), *counts)
    return features.join(dims, key, "left")


def _names(spark: SparkSession, names: list[str]) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], "region string")


def regional_report(df: DataFrame, regions: list[str], customers: str = "customers",
                    revenue: str = "revenue", currency: str = "currency") -> DataFrame:
    """Report for a fixed list of regions; one without data gets zeros and USD.

    The average is whole currency units, 0 without customers. Sums are made per region and
    currency, in hash tables; the few rows they leave meet the list in a second aggregate, so
    nothing is joined.
    """
    spent = df.filter(F.col("region").isin(*regions)).groupBy("region", currency).agg(
        F.sum(customers).cast("bigint").alias("customers"), F.sum(revenue).cast("double").alias("revenue"))
    nothing = _names(df.sparkSession, regions).select(
        "region", *[F.lit(None).cast(spent.schema[c].dataType).alias(c) for c in (currency, "customers", "revenue")])
    filled = spent.unionByName(nothing).groupBy("region").agg(
        F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"),
        F.coalesce(F.floor(F.sum("revenue")).cast("bigint"), F.lit(0)).alias("revenue"),
        F.coalesce(F.max(currency), F.lit(DEFAULT_CURRENCY)).alias("currency"))
    return filled.withColumn("average", floor_ratio_or_zero(F.col("revenue"), F.col("customers")))


def region_totals(df: DataFrame, regions: list[str], amount: str = "amount") -> DataFrame:
    """Total per region of a fixed list, 0 for a region without rows."""
    totals = df.filter(F.col("region").isin(*regions)).groupBy("region").agg(
        F.sum(amount).alias("total"))
    return (_names(df.sparkSession, regions).join(totals, "region", "left")
            .select("region", F.coalesce("total", F.lit(0)).alias("total")))


def external_assets(assets: DataFrame, edges: DataFrame, materialized: DataFrame) -> DataFrame:
    """Declared assets that something depends on and nothing materializes."""
    needed = edges.select(F.col("dep").alias("uri")).distinct()
    return (assets.select("uri").distinct()
            .join(needed, "uri", "left_semi")
            .join(materialized.select("uri"), "uri", "left_anti"))
