"""The test tables and the views on them that the queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

# The time the freshness and churn queries are asked at; events end the day before.
NOW = "2024-01-31 00:00:00"


class Tables:
    """``t.orders`` is the orders table of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


def as_book(lineitem: DataFrame) -> DataFrame:
    """Order lines as order-book snapshots of the supplier's market."""
    return lineitem.select(
        F.concat(F.lit("market_"), F.col("l_suppkey")).alias("market_id"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("snapshot_id"),
        F.col("l_shipdate").alias("ts"),
        F.col("l_extendedprice").alias("best_bid"),
        (F.col("l_extendedprice") * (F.lit(0.95) + F.col("l_discount"))).alias("best_ask"),
        (F.col("l_quantity") * 10).cast("bigint").alias("total_volume"))


def book(t: Tables) -> DataFrame:
    return as_book(t.lineitem)


def market_lines(t: Tables) -> DataFrame:
    """Order lines with the columns of a market profile."""
    return t.lineitem.select(
        F.concat(F.lit("market_"), F.col("l_suppkey")).alias("market_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_quantity") * 10).cast("bigint").alias("volume"),
        F.col("l_discount").alias("spread"),
        (F.col("l_quantity") * 1000).alias("liquidity_depth"))


def sales(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("ts"),
        F.concat(F.lit("Q"), F.quarter("o_orderdate")).alias("quarter"))


def places(t: Tables) -> DataFrame:
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("region"))


def customers(t: Tables) -> DataFrame:
    tier = F.when(F.col("c_acctbal") >= 5000, "enterprise").otherwise("standard")
    return t.customer.join(places(t), "c_nationkey").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"),
        "region", tier.alias("tier"))


def as_materializations(events: DataFrame) -> DataFrame:
    """Events as the log of asset materializations."""
    return events.select(
        F.concat(F.lit("asset_"), F.col("user_id")).alias("asset"), "event_id", "ts",
        (F.col("event_type") != "error").alias("success"))


def materializations(t: Tables) -> DataFrame:
    return as_materializations(t.events)


def edges(t: Tables) -> DataFrame:
    """Customers and suppliers depend on their nation, nations on their region."""
    def edge(df: DataFrame, kind: str, key: str, dep_kind: str, dep_key: str) -> DataFrame:
        return df.select(F.concat(F.lit(f"{kind}/"), F.col(key)).alias("consumer"),
                         F.concat(F.lit(f"{dep_kind}/"), F.col(dep_key)).alias("dep"),
                         F.lit(0).cast("bigint").alias("ord"))
    return (edge(t.customer, "customer", "c_custkey", "nation", "c_nationkey")
            .union(edge(t.supplier, "supplier", "s_suppkey", "nation", "s_nationkey"))
            .union(edge(t.nation, "nation", "n_nationkey", "region", "n_regionkey")))


def pipeline_edges(t: Tables) -> DataFrame:
    """A graph with depth, cycles and unknown inputs, from customers in groups of eight.

    The first of a group depends on its nation, each other one on the one before. In every
    fifth group the second depends on the fifth, in every seventh the third on something
    that is no asset.
    """
    key, first, group = F.col("c_custkey"), F.col("c_custkey") % 8, F.floor(F.col("c_custkey") / 8)
    name = lambda k: F.concat(F.lit("customer/"), k.cast("string"))
    there = t.customer.select((key + 1).alias("c_custkey"), F.lit(True).alias("_there"))
    rows = t.customer.join(there, "c_custkey", "left")
    chain = F.when((first > 0) & F.col("_there"), name(key - 1)).otherwise(F.concat(F.lit("nation/"), F.col("c_nationkey")))
    deps = F.array_compact(F.array(
        chain, F.when((group % 5 == 1) & (first == 2), name(key + 3)),
        F.when((group % 7 == 1) & (first == 3), F.concat(F.lit("missing/"), group.cast("string")))))
    return rows.select(name(key).alias("consumer"), F.explode(deps).alias("dep")).union(
        t.nation.select(F.concat(F.lit("nation/"), "n_nationkey"), F.concat(F.lit("region/"), "n_regionkey")))


def pipeline_assets(t: Tables) -> DataFrame:
    own = lambda df, kind, key: df.select(F.concat(F.lit(f"{kind}/"), key).alias("uri"))
    return own(t.customer, "customer", "c_custkey").union(own(t.nation, "nation", "n_nationkey")).union(
        own(t.region, "region", "r_regionkey"))


# The same views for the SQL checks.
V_BOOK = """v_book AS (
  SELECT 'market_' || l_suppkey AS market_id, l_orderkey * 10 + l_linenumber AS snapshot_id,
         l_shipdate AS ts, l_extendedprice AS best_bid,
         l_extendedprice * (0.95::DOUBLE + l_discount) AS best_ask,
         CAST(l_quantity * 10 AS BIGINT) AS total_volume
  FROM lineitem)"""
V_LINES = """v_lines AS (
  SELECT 'market_' || l_suppkey AS market_id, l_extendedprice AS price,
         CAST(l_quantity * 10 AS BIGINT) AS volume, l_discount AS spread,
         l_quantity * 1000 AS liquidity_depth
  FROM lineitem)"""
V_SALES = """v_sales AS (
  SELECT o_custkey AS customer_id, o_totalprice AS amount, o_orderdate AS ts,
         'Q' || quarter(o_orderdate) AS quarter
  FROM orders)"""
V_CUST = """v_cust AS (
  SELECT c_custkey AS customer_id, c_name AS name, r_name AS region,
         CASE WHEN c_acctbal >= 5000 THEN 'enterprise' ELSE 'standard' END AS tier
  FROM customer JOIN nation ON c_nationkey = n_nationkey
                JOIN region ON n_regionkey = r_regionkey)"""
V_MAT = """v_mat AS (
  SELECT 'asset_' || user_id AS asset, event_id, ts, event_type <> 'error' AS success
  FROM events)"""
V_EDGES = """v_edges AS (
  SELECT 'customer/' || c_custkey AS consumer, 'nation/' || c_nationkey AS dep,
         CAST(0 AS BIGINT) AS ord FROM customer
  UNION ALL SELECT 'supplier/' || s_suppkey, 'nation/' || s_nationkey, 0 FROM supplier
  UNION ALL SELECT 'nation/' || n_nationkey, 'region/' || n_regionkey, 0 FROM nation)"""
V_PIPELINE = """p_edges AS (
  SELECT 'customer/' || c_custkey AS consumer,
         CASE WHEN c_custkey % 8 > 0 AND c_custkey - 1 IN (SELECT c_custkey FROM customer)
              THEN 'customer/' || (c_custkey - 1) ELSE 'nation/' || c_nationkey END AS dep FROM customer
  UNION SELECT 'customer/' || c_custkey, 'customer/' || (c_custkey + 3) FROM customer
  WHERE (c_custkey // 8) % 5 = 1 AND c_custkey % 8 = 2
  UNION SELECT 'customer/' || c_custkey, 'missing/' || (c_custkey // 8) FROM customer
  WHERE (c_custkey // 8) % 7 = 1 AND c_custkey % 8 = 3
  UNION SELECT 'nation/' || n_nationkey, 'region/' || n_regionkey FROM nation),
p_assets AS (
  SELECT 'customer/' || c_custkey AS uri FROM customer UNION SELECT 'nation/' || n_nationkey FROM nation
  UNION SELECT 'region/' || r_regionkey FROM region)"""
