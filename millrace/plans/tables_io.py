"""Sources, sinks, profiles, metadata and lineage on the test tables."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.operators.lineage import topo_levels, upstream
from millrace.operators.partitions import assign_partition
from millrace.operators.profile import merge_metadata, profile
from millrace.plans.registry import query, rounded, text_time
from millrace.plans.tables import (TABLES, V_CUST, V_EDGES, V_PIPELINE, customers, edges, pipeline_assets,
                                   pipeline_edges)
from millrace.session import shared_dir
from millrace.sources import readers, writers
from millrace.sources.assets import compact_logs, materialize, read_asset, read_log


@query("src_json_records", """
SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS extracted_at,
       l_orderkey * 10 + l_linenumber AS id, CAST(l_quantity AS BIGINT) AS value FROM lineitem
UNION ALL
SELECT strftime(l_shipdate, '%Y-%m-%d %H:%M:%S'), l_partkey, l_suppkey FROM lineitem""")
def src_json_records(t):
    """Every order line becomes a document of two records."""
    documents = t.lineitem.select(
        text_time("l_shipdate").alias("extracted_at"),
        F.array(F.struct((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
                         F.col("l_quantity").cast("bigint").alias("value")),
                F.struct(F.col("l_partkey").alias("id"), F.col("l_suppkey").alias("value")))
        .alias("records"))
    path = shared_dir(t.spark, "envelopes")
    writers.save_json(documents, path)
    return readers.read_records(t.spark, path, "id bigint, value bigint", multi_line=False)


DOCUMENT_RECORDS = 500


@query("src_json_variant", f"""
SELECT 'b' || (c_custkey // {DOCUMENT_RECORDS}) AS source,
       CAST(row_number() OVER (PARTITION BY c_custkey // {DOCUMENT_RECORDS} ORDER BY c_custkey) - 1 AS INTEGER) AS pos,
       c_custkey AS id, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance,
       concat_ws(',', CASE WHEN c_acctbal < 0 THEN 'balance' END, CASE WHEN c_custkey % 3 = 0 THEN 'segment' END) AS missing,
       CASE WHEN c_custkey % 3 = 1 THEN 'segment' ELSE '' END AS nulls
FROM customer""")
def src_json_variant(t):
    """A pretty-printed document for every 500 customers, whose records differ in their fields.

    A balance below zero is left out, and a segment is left out, null or there by turns."""
    key = F.col("c_custkey")
    segment = F.when(key % 3 == 0, "").when(key % 3 == 1, ',\n  "segment": null').otherwise(
        F.concat(F.lit(',\n  "segment": "'), "c_mktsegment", F.lit('"')))
    balance = F.when(F.col("c_acctbal") >= 0, F.concat(F.lit(',\n  "balance": '), F.col("c_acctbal").cast("string"))).otherwise("")
    record = F.concat(F.lit('{"id": '), key, balance, segment, F.lit("}"))
    # keys are distinct, so a document has no more records than it may
    lists = t.customer.groupBy(F.floor(key / DOCUMENT_RECORDS).alias("block")).agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct(key, record.alias("text")))), lambda r: r["text"]), ",\n").alias("list"))
    texts = lists.select(F.concat(F.lit('{\n"source": "b'), "block", F.lit('",\n"records": ['), "list", F.lit("]\n}")).alias("value"), "block")
    path = shared_dir(t.spark, "variants")
    # one document a file
    texts.write.partitionBy("block").text(path)
    records = readers.read_variant_records(t.spark, f"{path}/*")
    checked = quality.required_in_variant(records, "record", ["id", "balance", "segment"])
    return checked.select(
        *readers.variant_fields(F.col("envelope"), {"source": "string"}), "pos",
        *readers.variant_fields(F.col("record"), {"id": "bigint", "balance": "double"}),
        F.array_join("missing", ",").alias("missing"), F.array_join("nulls", ",").alias("nulls"))


@query("src_api_pages", """
WITH listing AS (
  SELECT p_partkey * 2 AS id, p_name AS title, p_size AS n, p_brand, p_type FROM part
  UNION ALL SELECT p_partkey * 2 + 1, p_type, p_size + 1, p_brand, p_type FROM part)
SELECT id, title, '2024-01-01' AS published_at, 'https://example.com/' || id AS url,
       CAST(n AS BIGINT) AS comments_count, CAST(n * 2 AS BIGINT) AS positive_reactions_count,
       p_type || ',' || p_brand AS tag_list, p_brand AS "user.username"
FROM listing""")
def src_api_pages(t):
    """Every part becomes a page of two articles."""
    def article(item, title, n):
        return F.struct(
            item.alias("id"), title.alias("title"), F.lit("2024-01-01").alias("published_at"),
            F.concat(F.lit("https://example.com/"), item).alias("url"),
            n.cast("bigint").alias("comments_count"),
            (n * 2).cast("bigint").alias("positive_reactions_count"),
            F.array("p_type", "p_brand").alias("tag_list"),
            F.struct(F.col("p_brand").alias("username"), title.alias("name")).alias("user"),
            F.lit("not kept").alias("body"))
    key, size = F.col("p_partkey"), F.col("p_size")
    pages = t.part.select(F.array(article(key * 2, F.col("p_name"), size),
                                  article(key * 2 + 1, F.col("p_type"), size + 1))
                          .alias("articles"))
    flat = readers.flatten_pages(pages)
    return flat.withColumn("tag_list", F.array_join("tag_list", ","))


@query("src_table_limit", """
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_custkey LIMIT 10""")
def src_table_limit(t):
    t.customer.select("c_custkey", "c_name", "c_acctbal").createOrReplaceTempView(
        "millrace_users")
    return readers.read_table(t.spark, "millrace_users", 10, ["c_custkey"])


@query("src_file_lineage", """
SELECT c_custkey, c_name, 'customer.parquet' AS source_file FROM customer""")
def src_file_lineage(t):
    tagged = readers.with_source_file(t.customer)
    return tagged.select("c_custkey", "c_name",
                         F.substring_index("source_file", "/", -1).alias("source_file"))


PART = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


@query("sink_csv_preview", PART)
def sink_csv_preview(t):
    part, path = t.part, shared_dir(t.spark, "csv")
    writers.save_csv(part, path)
    return t.spark.read.schema(part.schema).option("header", True).csv(path)


@query("sink_csv_preview_rows", f"""
SELECT *, (SELECT count(*) FROM part) AS row_count FROM ({PART}) ORDER BY p_partkey DESC LIMIT 5""")
def sink_csv_preview_rows(t):
    """What is logged of a written CSV table: its row count and first rows."""
    count, preview = writers.save_csv(t.part, shared_dir(t.spark, "csv"), [F.desc("p_partkey")])
    return preview.withColumn("row_count", F.lit(count).cast("bigint"))


@query("sink_json", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_orderpriority
FROM orders""")
def sink_json(t):
    orders, path = t.orders.withColumn("o_orderdate", text_time("o_orderdate")), \
        shared_dir(t.spark, "json")
    writers.save_json(orders, path)
    return t.spark.read.schema(orders.schema).json(path)


@query("sink_format_dispatch", f"""
WITH part_rows AS ({PART})
SELECT 'json' AS format, * FROM part_rows UNION ALL SELECT 'csv', * FROM part_rows
UNION ALL SELECT 'xml', * FROM part_rows""")
def sink_format_dispatch(t):
    part, written = t.part, []
    for fmt in writers.OUTPUT_FORMATS:
        path = shared_dir(t.spark, fmt)
        writers.save_as(part, path, fmt)
        reader = t.spark.read.schema(part.schema).format(fmt)
        if fmt == "csv":
            reader = reader.option("header", True)
        elif fmt == "xml":
            reader = reader.option("rowTag", "record")
        written.append(reader.load(path).withColumn("format", F.lit(fmt)))
    return reduce(DataFrame.unionByName, written)


@query("sink_copy_into", """
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer""")
def sink_copy_into(t):
    """Customers arrive as CSV in a table that already holds the suppliers."""
    table, stage = shared_dir(t.spark, "table"), shared_dir(t.spark, "stage")
    schema = "id bigint, name string, balance double"
    t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                      F.col("s_acctbal").alias("balance")).write.parquet(table)
    t.customer.select("c_custkey", "c_name", "c_acctbal").write.csv(stage)
    writers.copy_into(t.spark, stage, table, schema)
    return t.spark.read.schema(schema).parquet(table)


@query("sink_partitioned", """
SELECT strftime(ts, '%Y-%m-%d') AS date, count(*) AS row_count,
       round(sum(CASE WHEN strftime(ts, '%Y-%m-%d') = '2024-01-15' THEN value * 2
                      ELSE value END), 4) AS total
FROM events GROUP BY 1""")
def sink_partitioned(t):
    """All days are written, then one of them is replaced with doubled values."""
    path = shared_dir(t.spark, "daily")
    days = assign_partition(t.events.select("event_id", "value", "ts"), "ts", output="date")
    writers.write_partition(days, path, "date", rebalance=True)
    writers.run_partition(days, "date", path, "2024-01-15", ts="ts",
                          transform=lambda rows: rows.withColumn("value", F.col("value") * 2))
    stored = t.spark.read.schema("event_id bigint, value double, date string").parquet(path)
    return rounded(stored.groupBy("date").agg(F.count(F.lit(1)).alias("row_count"),
                                              F.sum("value").alias("total")))


URI = "s3://lake/curated/customers.parquet"


@query("materialize", f"""
, facts AS (SELECT count(*) AS n FROM v_cust)
SELECT '{URI}' AS uri, 's3/lake/curated/customers/parquet' AS asset_key, n AS row_count,
       check_name AS "check", passed, status, error
FROM facts, (VALUES ('not_empty', TRUE, NULL, NULL),
                    ('tier_known', TRUE, NULL, NULL),
                    ('all_enterprise', FALSE, NULL, 'only enterprise customers expected'),
                    ('has_name', FALSE, 'not evaluated (prior assert failed)', NULL))
     AS v(check_name, passed, status, error)""", (V_CUST,))
def materialize_customers(t):
    _, logs = _materialized(t)
    runs = read_log(t.spark, "materializations", logs).filter("row_count > 0").select(
        "uri", F.array_join("key", "/").alias("asset_key"), "row_count")
    checks = read_log(t.spark, "checks", logs).drop("ord")
    return runs.join(checks, "uri")


def _materialized(t):
    """An empty version without checks, then one of all customers; logs are compacted in between."""
    path, logs = shared_dir(t.spark, "customers"), shared_dir(t.spark, "logs")
    rows = customers(t)
    materialize(rows.filter("false"), URI, path, logs, datetime(2024, 1, 30, tzinfo=timezone.utc))
    compact_logs(t.spark, logs)
    materialize(
        rows, URI, path, logs, datetime(2024, 1, 31, tzinfo=timezone.utc),
        deps=["postgres://warehouse/public/customers"],
        checks=[("not_empty", F.lit(True), "no customers"),
                ("tier_known", F.col("tier").isin("enterprise", "standard"), "unknown tier"),
                ("all_enterprise", F.col("tier") == "enterprise",
                 "only enterprise customers expected"),
                ("has_name", F.col("name") != "", "customer without a name")],
        metadata={"source": "customer"}, preview_order=["customer_id"])
    return path, logs


@query("materialize_logs", f"""
, n AS (SELECT count(*) AS n FROM v_cust)
SELECT 'columns' AS log, '{URI}' AS uri, k AS ord, c AS name, t AS value, v AS runs
FROM (VALUES (0, 'customer_id', 'bigint', 2), (1, 'name', 'string', 2), (2, 'region', 'string', 2), (3, 'tier', 'string', 2)) x(k, c, t, v)
UNION ALL SELECT 'edges', '{URI}', 0, 'postgres://warehouse/public/customers', NULL, 1
UNION ALL SELECT 'metadata', '{URI}', NULL, 'source', 'customer', 1
UNION ALL SELECT 'metadata', '{URI}', NULL, 'row_count', CAST(n AS VARCHAR), 1 FROM n
UNION ALL SELECT 'metadata', '{URI}', NULL, 'row_count', '0', 1
UNION ALL (SELECT 'previews', '{URI}', CAST(row_number() OVER (ORDER BY customer_id) - 1 AS INTEGER), NULL,
       CAST(to_json({{'customer_id': customer_id, 'name': name, 'region': region, 'tier': tier}}) AS VARCHAR), 1
  FROM v_cust ORDER BY customer_id LIMIT 10)""", (V_CUST,))
def materialize_logs(t):
    """Profile, inputs, metadata and preview of both versions; ``runs`` counts equal rows."""
    _, logs = _materialized(t)
    log = lambda name, column, value, ord="ord": read_log(t.spark, name, logs).select(
        F.lit(name).alias("log"), F.col("uri" if name != "edges" else "consumer").alias("uri"), F.expr(ord).cast("int").alias("ord"),
        F.expr(column).cast("string").alias("name"), F.expr(value).cast("string").alias("value"))
    rows = [log("columns", "column", "type"), log("edges", "dep", "null"), log("metadata", "key", "value", "null"),
            log("previews", "null", "row")]
    return reduce(DataFrame.unionByName, rows).groupBy("log", "uri", "ord", "name", "value").agg(
        F.count(F.lit(1)).cast("int").alias("runs"))


@query("materialize_newest", "SELECT * FROM v_cust", (V_CUST,))
def materialize_newest(t):
    """What a reader of the asset sees."""
    _, logs = _materialized(t)
    return read_asset(t.spark, URI, logs)


SPARK_TYPES = """CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int'
  WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'TIMESTAMP' THEN 'timestamp_ntz'
  WHEN 'FLOAT[]' THEN 'array<float>' ELSE column_type END"""


@query("profile_schema", "\nUNION ALL ".join(f"""
SELECT '{name}' AS "table", (SELECT count(*) FROM {name}) AS row_count, column_name AS "column",
       {SPARK_TYPES} AS type
FROM (DESCRIBE {name})""" for name in TABLES))
def profile_schema(t):
    return reduce(DataFrame.unionByName,
                  [profile(getattr(t, name), name) for name in TABLES]).drop("ord")


@query("metadata_merge", """
WITH writes AS (
  SELECT user_id AS uri,
         CASE WHEN event_type IN ('purchase', 'click') THEN 'click' ELSE event_type END AS key,
         value, event_id, event_type IN ('click', 'view') AS by_user
  FROM events)
SELECT uri, key, value FROM writes
QUALIFY row_number() OVER (PARTITION BY uri, key ORDER BY by_user DESC, event_id DESC) = 1""")
def metadata_merge(t):
    """Purchases are captured under a key that users also write themselves."""
    kind = F.col("event_type")
    writes = t.events.select(F.col("user_id").alias("uri"),
                             F.when(kind == "purchase", "click").otherwise(kind).alias("key"),
                             "value", F.col("event_id").alias("seq"), "event_type")
    by_user = kind.isin("click", "view")
    return merge_metadata(writes.filter(by_user), writes.filter(~by_user))


# shortest paths are no longer than a group, a nation and a region
@query("lin_upstream", """
, closure AS (
  SELECT consumer AS asset, dep AS upstream, 1 AS depth FROM p_edges
  UNION
  SELECT asset, e.dep, depth + 1 FROM closure JOIN p_edges e ON e.consumer = upstream WHERE depth < 11)
SELECT asset, upstream, min(depth) AS depth FROM closure GROUP BY asset, upstream
""", (V_PIPELINE,), recursive=True)
def lin_upstream(t):
    return upstream(pipeline_edges(t))


@query("lin_upstream_some", """
, closure AS (
  SELECT consumer AS asset, dep AS upstream, 1 AS depth FROM v_edges WHERE consumer IN (
    SELECT 'customer/' || c_custkey FROM customer WHERE c_acctbal > 5000)
  UNION
  SELECT asset, e.dep, depth + 1 FROM closure JOIN v_edges e ON e.consumer = upstream)
SELECT asset, upstream, min(depth) AS depth FROM closure GROUP BY asset, upstream
""", (V_EDGES,), recursive=True)
def lin_upstream_some(t):
    """Only for customers with much on their account."""
    asked = t.customer.filter("c_acctbal > 5000").select(F.concat(F.lit("customer/"), "c_custkey").alias("asset"))
    return upstream(edges(t), start=asked)


@query("lin_order", """
, closure AS (
  SELECT consumer AS uri, dep FROM p_edges
  UNION
  SELECT uri, e.dep FROM closure c JOIN p_edges e ON e.consumer = c.dep),
in_cycle AS (SELECT uri FROM closure WHERE uri = dep),
lost AS (SELECT uri FROM closure WHERE dep NOT IN (SELECT uri FROM p_assets)),
reasons AS (
  SELECT uri, CASE WHEN uri IN (SELECT uri FROM in_cycle) THEN 'cycle'
                   WHEN uri IN (SELECT uri FROM lost) THEN 'unknown dependency'
                   WHEN uri IN (SELECT c.uri FROM closure c JOIN in_cycle i ON c.dep = i.uri) THEN 'behind a cycle'
              END AS rejected
  FROM p_assets),
paths AS (
  SELECT uri, 0 AS depth FROM reasons WHERE rejected IS NULL AND uri NOT IN (SELECT consumer FROM p_edges)
  UNION
  SELECT r.uri, depth + 1 FROM paths JOIN p_edges e ON e.dep = paths.uri JOIN reasons r ON r.uri = e.consumer
  WHERE r.rejected IS NULL)
SELECT uri, CASE WHEN rejected IS NULL THEN max(depth) END AS level, rejected
FROM reasons LEFT JOIN paths USING (uri) GROUP BY uri, rejected""", (V_PIPELINE,), recursive=True)
def lin_order(t):
    return topo_levels(pipeline_edges(t), pipeline_assets(t))
