"""Projections, filters, joins, aggregates and windows on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import asset_key, json_or_default
from millrace.operators import aggregates as agg
from millrace.operators import joins, transforms, windows
from millrace.plans.registry import query, rounded, text_time
from millrace.plans.tables import (EVENT_TYPES, V_BOOK, V_CUST, V_EDGES, V_LINES, V_MAT, V_SALES,
                                   book, customers, edges, market_lines, materializations, sales)
from millrace.session import shared_dir
from millrace.sources import writers
from millrace.sources.readers import with_source_file

# ---- projections and filters


@query("proj_value_category", """
SELECT event_id, value, value * 2 AS value_doubled,
       CASE WHEN value > 150 THEN 'high' WHEN value <= 150 THEN 'low' END AS value_category
FROM events""")
def proj_value_category(t):
    return transforms.categorize(t.events.select("event_id", "value"))


@query("proj_double", "SELECT event_id, value * 2 AS value FROM events")
def proj_double(t):
    return transforms.double_values(t.events.select("event_id", "value"))


@query("proj_double_array", """
SELECT vec_id, CAST(pos AS INTEGER) AS pos, x * 2 AS doubled,
       x + 1 AS plus_one
FROM (SELECT vec_id, unnest(range(1, len(embedding) + 1)) AS pos, unnest(CAST(embedding AS DOUBLE[])) AS x
      FROM embeddings)""")
def proj_double_array(t):
    numbers = t.embeddings.select("vec_id", F.col("embedding").cast("array<double>")
                                  .alias("embedding"))
    both = transforms.double_array(numbers, "embedding", "doubled")
    both = transforms.increment_array(both, "embedding", "plus_one")
    zipped = both.select("vec_id", F.posexplode(F.arrays_zip("doubled", "plus_one")))
    return zipped.select("vec_id", (F.col("pos") + 1).alias("pos"),
                         "col.doubled", "col.plus_one")


def _flagged_events(t):
    return t.events.select("event_id", "value", (F.col("event_type") != "error").alias("valid"))


@query("filter_valid", """
SELECT event_id, value, TRUE AS valid FROM events
WHERE event_type <> 'error' AND value IS NOT NULL AND value >= 0""")
def filter_valid(t):
    return transforms.clean_records(_flagged_events(t))[0]


@query("filter_valid_counts", """
SELECT count(*) FILTER (WHERE event_type <> 'error' AND value >= 0) AS records_kept,
       count(*) - count(*) FILTER (WHERE event_type <> 'error' AND value >= 0)
         AS records_removed,
       count(*) AS records
FROM events""")
def filter_valid_counts(t):
    return transforms.clean_records(_flagged_events(t))[1]


@query("filter_min_length", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS length FROM documents
WHERE length(text) >= 100""")
def filter_min_length(t):
    kept, _ = transforms.filter_min(t.documents.select("doc_id", "text"), "text", 100)
    return kept.drop("text")


@query("filter_min_length_counts", """
SELECT count(*) FILTER (WHERE length(text) >= 100) AS kept,
       count(*) FILTER (WHERE length(text) < 100) AS dropped, count(*) AS total
FROM documents""")
def filter_min_length_counts(t):
    return transforms.filter_min(t.documents.select("text"), "text", 100)[1]


@query("filter_max_price", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice <= 100000""")
def filter_max_price(t):
    return transforms.filter_max(t.orders.select("o_orderkey", "o_totalprice"),
                                 "o_totalprice", 100000)[0]


@query("filter_max_price_counts", """
SELECT count(*) FILTER (WHERE o_totalprice <= 100000) AS kept_count,
       count(*) FILTER (WHERE o_totalprice > 100000) AS dropped_count,
       count(*) AS total_count
FROM orders""")
def filter_max_price_counts(t):
    return transforms.filter_max(t.orders, "o_totalprice", 100000)[1]


@query("route_threshold", """
SELECT event_id, value,
       CASE WHEN value > 100 THEN 'process_large' ELSE 'process_small' END AS route
FROM events""")
def route_threshold(t):
    large, small = transforms.route(t.events.select("event_id", "value"))
    return large.unionByName(small)


@query("route_threshold_written", """
SELECT event_id, value,
       CASE WHEN value > 100 THEN 'process_large' ELSE 'process_small' END AS route
FROM events""")
def route_threshold_written(t):
    """Both branches written to their own folders in one pass over the input."""
    path, rows = shared_dir(t.spark, "routes"), t.events.select("event_id", "value")
    writers.write_routes(rows, path, transforms.route_label(F.col("value")))
    return t.spark.read.schema("event_id bigint, value double, route string").parquet(path)


@query("proj_name_upper", """
SELECT customer_id, upper(name) AS name FROM v_cust""", (V_CUST,))
def proj_name_upper(t):
    return transforms.upper_names(customers(t).select("customer_id", "name"))


@query("proj_tier_score", """
SELECT customer_id, name, region, tier,
       CASE WHEN tier = 'enterprise' THEN 100 ELSE 50 END AS score,
       lower(region) AS region_code
FROM v_cust""", (V_CUST,))
def proj_tier_score(t):
    return transforms.enrich_customers(customers(t))


@query("proj_customer_clean", r"""
SELECT c_custkey AS customer_id,
       upper(substr(c_name, 1, 1)) || lower(substr(c_name, 2)) || ' ' ||
         upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)) AS name,
       regexp_matches(lower(c_mktsegment) || CASE WHEN c_acctbal < 0 THEN '' ELSE '@' END
         || replace(c_name, '#', '.') || '.example.com',
         '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$') AS email_valid,
       CASE WHEN c_acctbal >= 5000 THEN 100 ELSE 50 END AS score
FROM customer""")
def proj_customer_clean(t):
    raw = t.customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.concat(F.lit("  "), F.lower("c_name"), F.lit(" \t "), F.upper("c_mktsegment"),
                 F.lit(" ")).alias("name"),
        F.concat(F.lower("c_mktsegment"), F.when(F.col("c_acctbal") < 0, "").otherwise("@"),
                 F.replace(F.col("c_name"), F.lit("#"), F.lit(".")),
                 F.lit(".example.com")).alias("email"),
        F.when(F.col("c_acctbal") >= 5000, "enterprise").otherwise("standard").alias("tier"))
    return transforms.validate_customers(raw).select("customer_id", "name", "email_valid", "score")


@query("proj_spread_pct", """
SELECT snapshot_id, market_id, round((best_ask - best_bid) / best_bid * 100 + 1e-7, 4) AS spread_pct
FROM v_book""", (V_BOOK,))
def proj_spread_pct(t):
    return rounded(transforms.with_spread(book(t)).select("snapshot_id", "market_id",
                                                          "spread_pct"))


def _dated_orders(t):
    """Order dates as text, those of open orders written the wrong way round."""
    pattern = F.when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "dd/MM/yyyy"))
    return t.orders.select("o_orderkey", F.coalesce(
        pattern, F.date_format("o_orderdate", "yyyy-MM-dd")).alias("date"))


@query("proj_run_date", """
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS date,
       strftime(o_orderdate, '%A') AS weekday
FROM orders WHERE o_orderstatus <> 'O'""")
def proj_run_date(t):
    good, _ = transforms.with_run_date(_dated_orders(t))
    return good.select("o_orderkey", "date", "weekday")


@query("proj_run_date_rejects", """
SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS date
FROM orders WHERE o_orderstatus = 'O'""")
def proj_run_date_rejects(t):
    return transforms.with_run_date(_dated_orders(t))[1]


@query("limit_records", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 100""")
def limit_records(t):
    return transforms.limit_ordered(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
                                    100, "o_orderkey")


@query("asset_key_path", r"""
WITH uris AS (
  SELECT url AS uri FROM pages
  UNION ALL SELECT 's3://lake/' || p_brand || '/' || p_name || '.v' || p_size || '.parquet'
  FROM part
  UNION ALL SELECT p_type || ' ' || p_name FROM part),
cut AS (
  SELECT uri, lower(regexp_extract(uri, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
         regexp_replace(uri, '^[A-Za-z][A-Za-z0-9+.-]*:', '') AS rest FROM uris),
pieces AS (
  SELECT uri, CASE WHEN scheme = '' THEN [uri] ELSE
      list_concat([scheme, regexp_extract(rest, '^//([^/?#]*)', 1)],
                  regexp_split_to_array(
                    regexp_extract(rest, '^(?://[^/?#]*)?([^?#]*)', 1), '[/.]')) END AS parts
  FROM cut)
SELECT uri, array_to_string(
         [CASE WHEN trim(regexp_replace(x, '[^A-Za-z0-9]+', '_', 'g'), '_') = '' THEN 'seg'
          ELSE trim(regexp_replace(x, '[^A-Za-z0-9]+', '_', 'g'), '_') END
          FOR x IN parts IF x <> ''], '/') AS asset_key
FROM pieces""")
def asset_key_path(t):
    uris = (t.pages.select(F.col("url").alias("uri"))
            .union(t.part.select(F.concat(F.lit("s3://lake/"), "p_brand", F.lit("/"), "p_name",
                                          F.lit(".v"), "p_size", F.lit(".parquet"))))
            .union(t.part.select(F.concat("p_type", F.lit(" "), "p_name"))))
    return uris.select("uri", F.array_join(asset_key(F.col("uri")), "/").alias("asset_key"))


@query("src_json_default", """
SELECT event_id, CAST(coalesce(json_extract_string(props, '$.k'), '0') AS BIGINT) AS k,
       'none' AS ref
FROM events""")
def src_json_default(t):
    schema = "k bigint, ref string"
    return t.events.select(
        "event_id",
        json_or_default(F.col("props"), schema, "k", F.lit(0).cast("bigint")).alias("k"),
        json_or_default(F.col("props"), schema, "ref", F.lit("none")).alias("ref"))


# ---- joins


@query("join_merge_kpis", """
SELECT (SELECT count(*) FROM v_cust) AS total_count,
       (SELECT count(*) FROM v_cust WHERE tier = 'enterprise') AS enterprise_count,
       round(sum(amount), 4) AS total_revenue, count(*) AS total_deals,
       round(avg(amount) + 1e-7, 4) AS average_deal_size
FROM v_sales""", (V_CUST, V_SALES))
def join_merge_kpis(t):
    return rounded(joins.merge_kpis(agg.customer_counts(customers(t)),
                                    agg.sales_metrics(sales(t))))


@query("agg_revenue_per_customer", """
, c AS (SELECT count(*) AS n, count(*) FILTER (WHERE tier = 'enterprise') AS e FROM v_cust),
s AS (SELECT sum(amount) AS r FROM v_sales)
SELECT n AS customer_count, round(r, 4) AS total_revenue,
       round(CASE WHEN n > 0 THEN r / n ELSE 0 END + 1e-7, 4) AS revenue_per_customer,
       e AS enterprise_count, round(CASE WHEN n > 0 THEN e / n ELSE 0 END + 1e-7, 4) AS enterprise_share
FROM c, s""", (V_CUST, V_SALES))
def agg_revenue_per_customer(t):
    kpis = joins.merge_kpis(agg.customer_counts(customers(t)), agg.sales_metrics(sales(t)))
    return rounded(agg.customer_metrics(kpis))


@query("join_daily_kpis", """
WITH per_customer AS (
  SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
  FROM orders GROUP BY o_custkey)
SELECT (SELECT round(sum(o_totalprice), 4) FROM orders) AS total,
       (SELECT count(*) FROM orders) AS count,
       (SELECT count(*) FROM per_customer WHERE first_order >= TIMESTAMP '1996-01-01')
         AS new_signups,
       (SELECT count(*) FROM per_customer WHERE last_order >= TIMESTAMP '2001-01-01')
         AS active_users,
       (SELECT count(*) FROM part WHERE p_size < 5) AS low_stock_items,
       (SELECT count(*) FROM part) AS total_items""")
def join_daily_kpis(t):
    per_customer = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"))
    return rounded(joins.daily_report(
        t.orders, per_customer, t.part, "o_totalprice",
        F.col("first_order") >= F.to_timestamp(F.lit("1996-01-01")),
        F.col("last_order") >= F.to_timestamp(F.lit("2001-01-01")), F.col("p_size") < 5))


def enriched(t):
    return joins.enrich_orders(
        t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_totalprice",
                        "o_orderstatus"),
        t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment"),
        t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber",
                          F.col("l_partkey").alias("p_partkey"), "l_extendedprice",
                          "l_discount"),
        t.part.select("p_partkey", "p_name", "p_brand"),
        "o_orderkey", "c_custkey", "p_partkey")


@query("join_enrich_orders", """
SELECT o_orderkey, l_linenumber, l_partkey AS p_partkey, l_extendedprice, l_discount,
       o_custkey AS c_custkey, o_totalprice, o_orderstatus, c_name, c_acctbal, c_mktsegment,
       p_name, p_brand
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
     LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN part ON l_partkey = p_partkey""")
def join_enrich_orders(t):
    return enriched(t)


@query("join_feature_matrix", """
SELECT user_id, count(*) AS events,
""" + ",\n".join(
    f"""       count(*) FILTER (WHERE event_type = '{e}') AS {e}_count,
       round(coalesce(sum(value) FILTER (WHERE event_type = '{e}'), 0), 4) AS {e}_value"""
    for e in EVENT_TYPES) + """,
       any_value(c_mktsegment) AS c_mktsegment, any_value(c_acctbal) AS c_acctbal
FROM events LEFT JOIN customer ON user_id = c_custkey
GROUP BY user_id""")
def join_feature_matrix(t):
    dims = t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_acctbal")
    return rounded(joins.feature_matrix(t.events, dims, "user_id", EVENT_TYPES))


REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "ATLANTIS"]
REGION_SQL = ", ".join(f"('{r}')" for r in REGIONS)


def _customer_revenue(t):
    """One row per customer with region, currency and summed orders."""
    spent = sales(t).groupBy("customer_id").agg(F.sum("amount").alias("revenue"))
    currency = (F.when(F.col("region") == "EUROPE", "EUR").when(F.col("region") == "ASIA", "JPY")
                .otherwise("USD"))
    return customers(t).join(spent, "customer_id", "left").select(
        "region", F.lit(1).alias("customers"), currency.alias("currency"),
        F.coalesce("revenue", F.lit(0.0)).alias("revenue"))


@query("join_region_default", f"""
, wanted(region) AS (VALUES {REGION_SQL}),
spent AS (SELECT customer_id, sum(amount) AS revenue FROM v_sales GROUP BY customer_id),
per_region AS (
  SELECT region, count(*) AS customers, CAST(floor(sum(revenue)) AS BIGINT) AS revenue
  FROM v_cust LEFT JOIN spent USING (customer_id) GROUP BY region)
SELECT region, coalesce(customers, 0) AS customers,
       CAST(coalesce(revenue, 0) AS BIGINT) AS revenue,
       CASE WHEN customers IS NULL THEN 'USD' WHEN region = 'EUROPE' THEN 'EUR'
            WHEN region = 'ASIA' THEN 'JPY' ELSE 'USD' END AS currency,
       CAST(CASE WHEN customers > 0 THEN floor(revenue / customers) ELSE 0 END AS BIGINT)
         AS average
FROM wanted LEFT JOIN per_region USING (region)""", (V_CUST, V_SALES))
def join_region_default(t):
    return joins.regional_report(_customer_revenue(t), REGIONS)


@query("join_total_by_region", """
, wanted(region) AS (VALUES ('EUROPE'), ('AMERICA'), ('ATLANTIS'))
SELECT region, round(coalesce(sum(amount), 0), 4) AS total
FROM wanted LEFT JOIN v_cust USING (region) LEFT JOIN v_sales USING (customer_id)
GROUP BY region""", (V_CUST, V_SALES))
def join_total_by_region(t):
    per_customer = _customer_revenue(t).withColumnRenamed("revenue", "amount")
    return rounded(joins.region_totals(per_customer, ["EUROPE", "AMERICA", "ATLANTIS"]))


@query("join_external_assets", """
, assets AS (SELECT consumer AS uri FROM v_edges
             UNION SELECT 'region/' || r_regionkey FROM region
             UNION SELECT 'part/' || p_partkey FROM part)
SELECT uri FROM assets
WHERE uri IN (SELECT dep FROM v_edges) AND uri NOT IN (SELECT consumer FROM v_edges)
""", (V_EDGES,))
def join_external_assets(t):
    e = edges(t)
    built = e.select(F.col("consumer").alias("uri"))
    assets = (built.union(t.region.select(F.concat(F.lit("region/"), "r_regionkey")))
              .union(t.part.select(F.concat(F.lit("part/"), "p_partkey"))))
    return joins.external_assets(assets, e, built)


# ---- aggregates


@query("agg_totals", """
SELECT round(sum(value), 4) AS total_value, count(*) AS record_count,
       round(sum(value) / count(*) + 1e-7, 4) AS average_value
FROM events""")
def agg_totals(t):
    return rounded(agg.totals(t.events))


@query("agg_category_counts", """
SELECT CASE WHEN value > 150 THEN 'high' WHEN value <= 150 THEN 'low' END AS value_category,
       count(*) AS records
FROM events GROUP BY 1""")
def agg_category_counts(t):
    return agg.category_counts(transforms.categorize(t.events))


@query("agg_stats_zero", """
SELECT count(value) AS count, round(sum(value), 4) AS sum, round(avg(value) + 1e-7, 4) AS avg,
       min(value) AS min, max(value) AS max
FROM events WHERE event_type <> 'error' AND value >= 0""")
def agg_stats_zero(t):
    return rounded(agg.stats(transforms.clean_records(_flagged_events(t))[0]))


@query("agg_stats_zero_empty", """
SELECT count(value) AS count, coalesce(sum(value), 0) AS sum, coalesce(avg(value), 0) AS avg,
       coalesce(min(value), 0) AS min, coalesce(max(value), 0) AS max
FROM events WHERE value < 0""")
def agg_stats_zero_empty(t):
    return agg.stats(t.events.filter("value < 0"))


def _balances(t):
    return (t.customer.select(F.col("c_acctbal").alias("value")),
            t.supplier.select(F.col("s_acctbal").alias("value")))


@query("agg_union_stats", """
WITH both_sides AS (SELECT 'a' AS side, c_acctbal AS value FROM customer
                    UNION ALL SELECT 'b', s_acctbal FROM supplier)
SELECT count(*) FILTER (WHERE side = 'a') AS count_a,
       count(*) FILTER (WHERE side = 'b') AS count_b, count(*) AS total_count,
       round(sum(value), 4) AS sum, round(sum(value) / count(*) + 1e-7, 4) AS average
FROM both_sides""")
def agg_union_stats(t):
    return rounded(agg.union_stats(*_balances(t)))


@query("set_union_inputs", """
SELECT c_acctbal AS value FROM customer UNION ALL SELECT s_acctbal FROM supplier""")
def set_union_inputs(t):
    return agg.union_inputs(*_balances(t))


MARKETS = """
, stats AS (
  SELECT market_id, count(*) AS snapshot_count,
         avg((best_ask - best_bid) / best_bid * 100) AS spread,
         CAST(sum(total_volume) AS BIGINT) AS total_market_volume
  FROM v_book GROUP BY market_id)
SELECT market_id, snapshot_count, round(spread + 1e-7, 4) AS avg_spread_pct, total_market_volume
FROM stats"""


@query("agg_market_stats", MARKETS, (V_BOOK,))
def agg_market_stats(t):
    return rounded(agg.market_stats(book(t)))


@query("agg_rule_violations",
       MARKETS + " WHERE spread < 0.05 OR total_market_volume < 145000", (V_BOOK,))
def agg_rule_violations(t):
    return rounded(agg.rule_violations(agg.market_stats(book(t)), 0.05, 145000))


@query("agg_rule_violations_default",
       MARKETS + " WHERE spread < 0.5 OR total_market_volume < 50000", (V_BOOK,))
def agg_rule_violations_default(t):
    return rounded(agg.rule_violations(agg.market_stats(book(t))))


PROFILE = """
, profile AS (
  SELECT market_id, avg(price) AS price_mean, stddev_samp(price) AS price_std,
         CAST(sum(volume) AS BIGINT) AS volume_sum, avg(volume) AS volume_mean,
         avg(spread) AS spread_mean, min(spread) AS spread_min, max(spread) AS spread_max,
         avg(liquidity_depth) AS liquidity_depth_mean
  FROM v_lines GROUP BY market_id)
SELECT market_id, round(price_mean + 1e-7, 4) AS price_mean, round(price_std + 1e-7, 4) AS price_std,
       volume_sum, round(volume_mean + 1e-7, 4) AS volume_mean, round(spread_mean + 1e-7, 4) AS spread_mean,
       round(spread_min, 4) AS spread_min, round(spread_max, 4) AS spread_max,
       round(liquidity_depth_mean + 1e-7, 4) AS liquidity_depth_mean
FROM profile"""


@query("agg_market_profile", PROFILE, (V_LINES,))
def agg_market_profile(t):
    return rounded(agg.market_profile(market_lines(t)))


@query("agg_anomalies", PROFILE + " WHERE spread_mean > 0.051 OR liquidity_depth_mean < 25000",
       (V_LINES,))
def agg_anomalies(t):
    return rounded(agg.anomalies(agg.market_profile(market_lines(t)), 0.051, 25000))


@query("agg_market_corr", """
, series AS (
  SELECT market_id, date_trunc('month', ts) AS snapshot, avg(best_bid) AS price
  FROM v_book GROUP BY 1, 2),
pairs AS (SELECT 'market_' || s_suppkey AS market_a, 'market_' || (s_suppkey + 1) AS market_b
          FROM supplier)
SELECT market_a, market_b, count(*) AS snapshots, round(corr(a.price, b.price) + 1e-7, 4) AS price_corr
FROM pairs JOIN series a ON a.market_id = market_a
           JOIN series b ON b.market_id = market_b AND b.snapshot = a.snapshot
GROUP BY market_a, market_b""", (V_BOOK,))
def agg_market_corr(t):
    """Every market with the next one, over monthly average prices."""
    monthly = book(t).select("market_id", F.date_trunc("month", "ts").alias("snapshot"),
                             F.col("best_bid").alias("price"))
    pairs = t.supplier.select(
        F.concat(F.lit("market_"), "s_suppkey").alias("market_a"),
        F.concat(F.lit("market_"), F.col("s_suppkey") + 1).alias("market_b"))
    return rounded(agg.market_corr(monthly, pairs))


@query("agg_customer_totals", """
SELECT customer_id, round(sum(amount), 4) AS total, count(*) AS count,
       grouping(customer_id) = 1 AS is_overall, round(sum(amount) / count(*) + 1e-7, 4) AS average
FROM v_sales GROUP BY GROUPING SETS ((customer_id), ())""", (V_SALES,))
def agg_customer_totals(t):
    return rounded(agg.sales_totals(sales(t)))


@query("agg_customer_quarter", """
SELECT customer_id, quarter, round(sum(amount), 4) AS total, count(*) AS count
FROM v_sales GROUP BY customer_id, quarter""", (V_SALES,))
def agg_customer_quarter(t):
    return rounded(agg.sales_by_quarter(sales(t)))


@query("agg_enterprise_count", """
SELECT count(*) AS total_count, count(*) FILTER (WHERE tier = 'enterprise') AS enterprise_count
FROM v_cust""", (V_CUST,))
def agg_enterprise_count(t):
    return agg.customer_counts(customers(t))


@query("agg_file_revenue", """
SELECT 'customer.parquet' AS source_file, count(*) AS record_count,
       round(sum(CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END), 4) AS total_revenue
FROM customer
UNION ALL
SELECT 'supplier.parquet', count(*),
       round(sum(CASE WHEN s_acctbal < 0 THEN 0 ELSE s_acctbal END), 4)
FROM supplier""")
def agg_file_revenue(t):
    """A negative balance stands for a missing revenue."""
    def balances(table, column):
        return with_source_file(t.spark.read.parquet(t.path(table))).select(
            F.substring_index("source_file", "/", -1).alias("source_file"),
            F.when(F.col(column) >= 0, F.col(column)).alias("revenue"))
    both = balances("customer", "c_acctbal").union(balances("supplier", "s_acctbal"))
    return rounded(agg.file_revenue(both))


@query("agg_metrics_mart", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS orders,
       count(DISTINCT customer_id) AS customers, round(sum(amount), 4) AS revenue,
       round(sum(amount) / count(*) + 1e-7, 4) AS average_order
FROM v_sales JOIN v_cust USING (customer_id) GROUP BY 1""", (V_SALES, V_CUST))
def agg_metrics_mart(t):
    mart = agg.customer_metrics_mart(sales(t), customers(t))
    return rounded(mart.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
                   .withColumn("orders", F.col("orders").cast("bigint")))


@query("agg_customer_insights", """
, per_customer AS (
  SELECT customer_id,
         count(*) FILTER (WHERE ts > TIMESTAMP '2001-08-01' - INTERVAL 90 DAY) AS recent_orders,
         sum(amount) FILTER (WHERE ts > TIMESTAMP '2001-08-01' - INTERVAL 90 DAY) AS recent,
         sum(amount) FILTER (WHERE ts <= TIMESTAMP '2001-08-01' - INTERVAL 90 DAY) AS earlier
  FROM v_sales
  WHERE ts > TIMESTAMP '2001-08-01' - INTERVAL 180 DAY AND ts <= TIMESTAMP '2001-08-01'
  GROUP BY customer_id)
SELECT count(*) AS total_customers,
       count(*) FILTER (WHERE tier = 'enterprise') AS high_value_customers,
       count(*) FILTER (WHERE coalesce(recent_orders, 0) = 0) AS churn_risk,
       round(sum(recent) / sum(earlier) * 100 - 100 + 1e-7, 4) AS growth_rate
FROM v_cust LEFT JOIN per_customer USING (customer_id)""", (V_SALES, V_CUST))
def agg_customer_insights(t):
    return rounded(agg.customer_insights(customers(t), sales(t),
                                         F.lit("2001-08-01").cast("timestamp_ntz")))


@query("agg_map_sum", "SELECT round(sum(value * 2), 4) AS total FROM events")
def agg_map_sum(t):
    return rounded(agg.map_sum(t.events, lambda v: v * 2))


# ---- windows, top rows, ordered union


@query("win_dedupe_customers", """
SELECT o_custkey, o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ordered
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""")
def win_dedupe_customers(t):
    newest = windows.dedupe(
        t.orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderdate"),
        ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()])
    return newest.withColumn("ordered", text_time("o_orderdate")).drop("o_orderdate")


@query("win_latest_materialization", """
SELECT asset, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, success
FROM v_mat QUALIFY row_number() OVER (PARTITION BY asset ORDER BY ts DESC, event_id DESC) = 1
""", (V_MAT,))
def win_latest_materialization(t):
    return windows.latest(materializations(t)).withColumn("ts", text_time("ts"))


@query("topk_preview", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 10""")
def topk_preview(t):
    return windows.preview(t.orders.select("o_orderkey", "o_custkey", "o_totalprice"),
                           [F.col("o_totalprice").desc(), "o_orderkey"])


def _order_edges(t):
    """Order lines depend on their part, and on their supplier's nation again."""
    parts = t.lineitem.select(F.concat(F.lit("order/"), "l_orderkey").alias("consumer"),
                              F.concat(F.lit("part/"), "l_partkey").alias("dep"),
                              F.col("l_linenumber").cast("bigint").alias("ord"))
    again = t.supplier.select(F.concat(F.lit("supplier/"), "s_suppkey"),
                              F.concat(F.lit("nation/"), "s_nationkey"), F.col("s_suppkey"))
    return parts.union(again)


@query("set_merge_edges", """
, both_kinds AS (
  SELECT 0 AS source, consumer, dep, ord FROM v_edges
  UNION ALL SELECT 1, 'order/' || l_orderkey, 'part/' || l_partkey, l_linenumber FROM lineitem
  UNION ALL SELECT 1, 'supplier/' || s_suppkey, 'nation/' || s_nationkey, s_suppkey
  FROM supplier)
SELECT consumer, dep, source, ord FROM both_kinds
QUALIFY row_number() OVER (PARTITION BY consumer, dep ORDER BY source, ord) = 1""", (V_EDGES,))
def set_merge_edges(t):
    return windows.merge_edges(edges(t), _order_edges(t))
