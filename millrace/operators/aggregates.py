"""Aggregates of records, markets, sales and customers.

All of them combine inside each task before the shuffle, so a key that holds
a large share of the rows arrives as one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import ratio_or_zero
from millrace.operators.transforms import TOP_TIER, with_spread

# Limits below which a market breaks the maker rules, and above
# or below which its profile is an anomaly.
MIN_SPREAD_PCT, MIN_MARKET_VOLUME = 0.5, 50000
MAX_SPREAD_MEAN, MIN_DEPTH_MEAN = 0.03, 20000


def _rows() -> Column:
    return F.count(F.lit(1))


def totals(df: DataFrame, value: str = "value") -> DataFrame:
    """Sum, row count and average; the average of no rows is null."""
    return df.agg(F.sum(value).alias("total_value"), _rows().alias("record_count"),
                  F.try_divide(F.sum(value), _rows()).alias("average_value"))


def category_counts(df: DataFrame, category: str = "value_category") -> DataFrame:
    return df.groupBy(category).agg(_rows().alias("records"))


def stats(df: DataFrame, value: str = "value") -> DataFrame:
    """Count, sum, average, minimum and maximum, all 0 on empty input."""
    def zero(c: Column) -> Column:
        return F.coalesce(c, F.lit(0))
    return df.agg(F.count(value).alias("count"), zero(F.sum(value)).alias("sum"),
                  zero(F.avg(value)).alias("avg"), zero(F.min(value)).alias("min"),
                  zero(F.max(value)).alias("max"))


def union_inputs(*inputs: DataFrame) -> DataFrame:
    """Inputs appended by column name, duplicates kept."""
    return reduce(DataFrame.unionByName, inputs)


def union_stats(a: DataFrame, b: DataFrame, value: str = "value") -> DataFrame:
    """Rows per side, rows, sum and average of two appended inputs."""
    both = union_inputs(a.select(value, F.lit("a").alias("side")),
                        b.select(value, F.lit("b").alias("side")))
    side = F.col("side")
    return both.agg(F.count_if(side == "a").alias("count_a"),
                    F.count_if(side == "b").alias("count_b"),
                    _rows().alias("total_count"), F.sum(value).alias("sum"),
                    F.try_divide(F.sum(value), _rows()).alias("average"))


def market_stats(book: DataFrame, *keys: Column | str) -> DataFrame:
    """Snapshots, average spread and volume per market (or the given keys)."""
    return with_spread(book).groupBy(*(keys or ("market_id",))).agg(
        _rows().alias("snapshot_count"),
        F.avg("spread_pct").alias("avg_spread_pct"),
        F.sum("total_volume").alias("total_market_volume"))


def rule_violations(per_market: DataFrame, min_spread: float = MIN_SPREAD_PCT,
                    min_volume: float = MIN_MARKET_VOLUME) -> DataFrame:
    """Markets with too thin a spread or too little volume."""
    return per_market.filter((F.col("avg_spread_pct") < min_spread)
                             | (F.col("total_market_volume") < min_volume))


def market_profile(df: DataFrame) -> DataFrame:
    """Price, volume, spread and depth statistics per market.

    The deviation is that of a sample, null for a single snapshot.
    """
    return df.groupBy("market_id").agg(
        F.avg("price").alias("price_mean"), F.stddev_samp("price").alias("price_std"),
        F.sum("volume").alias("volume_sum"), F.avg("volume").alias("volume_mean"),
        F.avg("spread").alias("spread_mean"), F.min("spread").alias("spread_min"),
        F.max("spread").alias("spread_max"),
        F.avg("liquidity_depth").alias("liquidity_depth_mean"))


def anomalies(profile: DataFrame, max_spread: float = MAX_SPREAD_MEAN,
              min_depth: float = MIN_DEPTH_MEAN) -> DataFrame:
    return profile.filter((F.col("spread_mean") > max_spread)
                          | (F.col("liquidity_depth_mean") < min_depth))


def market_corr(df: DataFrame, pairs: DataFrame, snapshot: str = "snapshot") -> DataFrame:
    """Correlation of the prices of each pair of markets over common snapshots.

    ``pairs(market_a, market_b)`` names the pairs to compare: correlating every
    market with every other grows with the square of the markets, so that is
    the caller's choice. Prices are averaged per market and snapshot first;
    after that a market has one row per snapshot, whatever its share of the
    input.
    """
    series = df.groupBy("market_id", snapshot).agg(F.avg("price").alias("price"))
    left = series.select(F.col("market_id").alias("market_a"), snapshot,
                         F.col("price").alias("price_a"))
    right = series.select(F.col("market_id").alias("market_b"), snapshot,
                          F.col("price").alias("price_b"))
    return (pairs.select("market_a", "market_b").join(left, "market_a")
            .join(right, ["market_b", snapshot])
            .groupBy("market_a", "market_b")
            .agg(_rows().alias("snapshots"),
                 F.corr("price_a", "price_b").alias("price_corr")))


def sales_totals(sales: DataFrame, customer: str = "customer_id",
                 amount: str = "amount") -> DataFrame:
    """Total, count and average per customer, and overall where customer is null.

    Customer totals are computed once from the sales; the overall row adds up
    those. A sale without a customer id belongs to the row with ``is_overall``
    false and a null customer.
    """
    per_customer = sales.groupBy(customer).agg(
        F.sum(amount).alias("total"), _rows().alias("count"))
    overall = per_customer.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"),
                               F.coalesce(F.sum("count"), F.lit(0)).alias("count"))
    rows = (per_customer.withColumn("is_overall", F.lit(False))
            .unionByName(overall.withColumn("is_overall", F.lit(True)),
                         allowMissingColumns=True))
    return rows.withColumn("average", ratio_or_zero(F.col("total"), F.col("count")))


def sales_by_quarter(sales: DataFrame, customer: str = "customer_id", quarter: str = "quarter",
                     amount: str = "amount") -> DataFrame:
    return sales.groupBy(customer, quarter).agg(
        F.sum(amount).alias("total"), _rows().alias("count"))


def customer_counts(customers: DataFrame, tier: str = "tier") -> DataFrame:
    return customers.agg(_rows().alias("total_count"),
                         F.count_if(F.col(tier) == TOP_TIER).alias("enterprise_count"))


def sales_metrics(sales: DataFrame, amount: str = "amount") -> DataFrame:
    """Overall revenue, deals and average deal, 0 when there are none."""
    revenue, deals = F.coalesce(F.sum(amount), F.lit(0)), _rows()
    return sales.agg(revenue.alias("total_revenue"), deals.alias("total_deals"),
                     ratio_or_zero(revenue, deals).alias("average_deal_size"))


def customer_metrics(kpis: DataFrame) -> DataFrame:
    """Revenue per customer and enterprise share, 0 without customers."""
    n = F.col("total_count")
    return kpis.select(
        n.alias("customer_count"), "total_revenue",
        ratio_or_zero(F.col("total_revenue"), n).alias("revenue_per_customer"),
        "enterprise_count",
        ratio_or_zero(F.col("enterprise_count"), n).alias("enterprise_share"))


def file_revenue(df: DataFrame, source: str = "source_file",
                 revenue: str = "revenue") -> DataFrame:
    """Records and revenue per input file; a missing revenue counts as 0."""
    return df.groupBy(source).agg(
        _rows().alias("record_count"),
        F.sum(F.coalesce(F.col(revenue), F.lit(0))).alias("total_revenue"))


def customer_metrics_mart(sales: DataFrame, customers: DataFrame, customer: str = "customer_id",
                          ts: str = "ts", amount: str = "amount") -> DataFrame:
    """Orders, distinct customers, revenue and average order per day.

    Four metrics at a daily grain are asked for; the choice is ours. Only sales
    of customers in the dimension count. Sales are summed per day and customer
    first, which also makes the distinct count a plain count.
    """
    per_day_customer = sales.groupBy(F.date_trunc("day", ts).alias("day"), customer).agg(
        _rows().alias("orders"), F.sum(amount).alias("revenue"))
    known = per_day_customer.join(customers.select(customer), customer, "left_semi")
    return known.groupBy("day").agg(
        F.sum("orders").alias("orders"), _rows().alias("customers"),
        F.sum("revenue").alias("revenue"),
        F.try_divide(F.sum("revenue"), F.sum("orders")).alias("average_order"))


def customer_insights(customers: DataFrame, sales: DataFrame, as_of: Column,
                      days: int = 90, tier: str = "tier", key: str = "customer_id",
                      ts: str = "ts", amount: str = "amount") -> DataFrame:
    """Customers, high-value customers, customers at risk and growth, as of a time.

    The four figures are given, their rules are ours: high value is the top
    tier, at risk is no order in the last ``days`` days, growth is the revenue
    of those days over that of the ``days`` before, in percent.
    """
    recent_from, earlier_from = as_of - F.expr(f"INTERVAL {days} DAYS"), \
        as_of - F.expr(f"INTERVAL {2 * days} DAYS")
    t = F.col(ts)
    recent = (t > recent_from) & (t <= as_of)
    earlier = (t > earlier_from) & (t <= recent_from)
    per_customer = sales.filter((t > earlier_from) & (t <= as_of)).groupBy(key).agg(
        F.count_if(recent).alias("recent_orders"),
        F.sum(F.when(recent, F.col(amount))).alias("recent_revenue"),
        F.sum(F.when(earlier, F.col(amount))).alias("earlier_revenue"))
    joined = customers.select(key, tier).join(per_customer, key, "left")
    return joined.agg(
        _rows().alias("total_customers"),
        F.count_if(F.col(tier) == TOP_TIER).alias("high_value_customers"),
        F.count_if(F.coalesce("recent_orders", F.lit(0)) == 0).alias("churn_risk"),
        (F.try_divide(F.sum("recent_revenue"), F.sum("earlier_revenue")) * 100 - 100)
        .alias("growth_rate"))


def map_sum(df: DataFrame, fn, value: str = "value") -> DataFrame:
    """Sum of a function (Column to Column) of every row, 0 on empty input."""
    return df.select(fn(F.col(value)).alias("mapped")).agg(
        F.coalesce(F.sum("mapped"), F.lit(0)).alias("total"))
