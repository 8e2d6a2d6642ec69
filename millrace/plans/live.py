"""The streams on the test tables, which arrive as eight files in eight batches.

Each query runs its stream until everything that has arrived is processed and reads back
what was written. The order of the files is not that of the events, so most batches hold
rows behind the windows closed before. Windows still open at the end are not in the result.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from millrace.plans.registry import query, rounded, text_time
from millrace.plans.tables import NOW, V_BOOK, V_CUST, as_book, as_materializations, customers
from millrace.session import shared_dir
from millrace.streaming import streams


FILES = 8


def _stream(t, name):
    """A table dealt to files by a hash of its rows, one file a batch."""
    rows, path = getattr(t, name), shared_dir(t.spark, f"arriving-{name}")
    columns = [c for c, kind in rows.dtypes if "<" not in kind]
    rows.repartition(FILES, F.xxhash64(*columns)).write.parquet(path)
    return streams.read_stream(t.spark, path, rows.schema, files_per_batch=1)


@query("st_order_book", """
, closed AS (
  SELECT date_trunc('hour', ts) AS window_start, market_id, count(*) AS snapshot_count,
         avg((best_ask - best_bid) / best_bid * 100) AS spread,
         CAST(sum(total_volume) AS BIGINT) AS total_market_volume
  FROM v_book
  WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR
        <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM v_book)
  GROUP BY 1, 2)
SELECT strftime(window_start, '%Y-%m-%d %H:%M:%S') AS window_start, market_id, snapshot_count,
       round(spread + 1e-7, 4) AS avg_spread_pct, total_market_volume
FROM closed WHERE spread < 0.05 OR total_market_volume < 100""", (V_BOOK,))
def st_order_book(t):
    path = shared_dir(t.spark, "order-book")
    book = streams.event_time(as_book(_stream(t, "lineitem")))
    streams.order_book_stream(book, path, shared_dir(t.spark, "progress"), 0.05, 100, bucket="year")
    return rounded(streams.violations(t.spark, path).withColumn("window_start", text_time("window_start")))


@query("st_asset_trigger", """
SELECT 'refresh_' || customer_id || ':' || event_id AS run_key, 'refresh_' || customer_id AS job,
       'asset_' || user_id AS asset, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
FROM events JOIN v_cust ON user_id = customer_id
WHERE tier = 'enterprise' AND event_type <> 'error'""", (V_CUST,))
def st_asset_trigger(t):
    """Every event is delivered twice, in one batch and again in a stream after that, and must start one run."""
    path = shared_dir(t.spark, "runs")
    watch = customers(t).filter("tier = 'enterprise'").select(
        F.concat(F.lit("asset_"), "customer_id").alias("asset"), F.concat(F.lit("refresh_"), "customer_id").alias("job"))
    for stream in (_stream(t, "events"), _stream(t, "events")):
        log = streams.event_time(as_materializations(stream.union(stream)))
        streams.trigger_stream(log, watch, path, shared_dir(t.spark, "progress"), prefixes=8)
    return streams.run_ledger(t.spark, path).drop("prefix", "part").withColumn("ts", text_time("ts"))


@query("st_ingest_hourly", """
SELECT strftime(ts, '%Y-%m-%d') AS date, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS records,
       round(sum(value), 4) AS total
FROM events GROUP BY 1, 2""")
def st_ingest_hourly(t):
    path, schema = shared_dir(t.spark, "landed"), t.events.schema
    streams.ingest_stream(_stream(t, "events"), path, shared_dir(t.spark, "progress"))
    streams.compact_hours(t.spark, path, schema, datetime.fromisoformat(NOW))
    stored = streams.landed(t.spark, path, schema)
    return rounded(stored.groupBy("date", "hour").agg(
        F.count(F.lit(1)).alias("records"), F.sum("value").alias("total")))


@query("st_alerts", """
SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) AS records, round(sum(value), 4) AS sum,
       CAST(printf('%.2f', avg(value)) AS DOUBLE) AS average
FROM events
WHERE date_trunc('day', ts) + INTERVAL 1 DAY
      <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)
GROUP BY date_trunc('day', ts)""")
def st_alerts(t):
    path = shared_dir(t.spark, "alerts")
    streams.alert_stream(streams.event_time(_stream(t, "events")), path, shared_dir(t.spark, "progress"), "daily_totals")
    return rounded(streams.alerts(t.spark, path).drop("stream").withColumn("window_start", text_time("window_start")))
