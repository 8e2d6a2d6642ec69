"""Partitions, freshness and run reports on the test tables."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import freshness, partitions
from millrace.operators.partitions import assign_partition
from millrace.plans.registry import query, rounded, text_time
from millrace.plans.tables import NOW, V_MAT, V_SALES, materializations, sales
from millrace.session import shared_dir
from millrace.sources.writers import run_partition


def _calendar_sql(cadence: str, unit: str, fmt: str) -> str:
    return f"""
SELECT '{cadence}' AS cadence, event_type, strftime(p, '{fmt}') AS partition_key,
       strftime(p, '%Y-%m-%d %H:%M:%S') AS period_start,
       strftime(p + INTERVAL 1 {unit}, '%Y-%m-%d %H:%M:%S') AS period_end
FROM (SELECT event_type, hi, unnest(generate_series(
        CASE WHEN date_trunc('{unit}', lo) = lo THEN lo
             ELSE date_trunc('{unit}', lo) + INTERVAL 1 {unit} END,
        date_trunc('{unit}', hi) - INTERVAL 1 {unit}, INTERVAL 1 {unit})) AS p FROM bounds)"""


CADENCES = [("hourly", "hour", "%Y-%m-%d-%H:%M"), ("daily", "day", "%Y-%m-%d"),
            ("weekly", "week", "%Y-%m-%d"), ("monthly", "month", "%Y-%m-%d")]


@query("part_calendar", """
WITH bounds AS (SELECT event_type, TIMESTAMP '2023-11-15' AS lo,
                       max(ts) + INTERVAL 2 DAY AS hi FROM events GROUP BY event_type)
""" + "\nUNION ALL\n".join(_calendar_sql(*c) for c in CADENCES))
def part_calendar(t):
    """Calendars per event type, from a declared start to two days after its last event."""
    bounds = t.events.groupBy("event_type").agg(
        (F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("hi")).withColumn(
        "lo", F.to_timestamp(F.lit("2023-11-15")))
    calendars = [
        partitions.partition_calendar(bounds, "lo", "hi", cadence).select(
            F.lit(cadence).alias("cadence"), "event_type", "partition_key",
            text_time("period_start").alias("period_start"),
            text_time("period_end").alias("period_end"))
        for cadence, _, _ in CADENCES]
    return reduce(DataFrame.unionByName, calendars)


@query("part_assign", """
SELECT event_id, strftime(ts, '%Y-%m-%d') AS day_key,
       strftime(date_trunc('week', ts), '%Y-%m-%d') AS week_key,
       strftime(date_trunc('month', ts), '%Y-%m-%d') AS month_key,
       strftime(date_trunc('hour', ts - INTERVAL 5 HOUR), '%Y-%m-%d-%H:%M') AS ny_hour_key
FROM events""")
def part_assign(t):
    keyed = t.events.select("event_id", "ts")
    for cadence, tz, output in [("daily", "UTC", "day_key"), ("weekly", "UTC", "week_key"),
                                ("monthly", "UTC", "month_key"),
                                ("hourly", "America/New_York", "ny_hour_key")]:
        keyed = assign_partition(keyed, "ts", cadence, tz, output=output)
    return keyed.drop("ts")


@query("part_static", """
SELECT event_id, event_type, value FROM events WHERE event_type IN ('click', 'view', 'refund')""")
def part_static(t):
    return partitions.filter_static(t.events.select("event_id", "event_type", "value"),
                                    "event_type", ["click", "view", "refund"])


@query("part_dynamic", """
SELECT DISTINCT user_id FROM events
WHERE user_id NOT IN (SELECT user_id FROM events
                      WHERE ts < TIMESTAMP '2024-01-01 06:00:00' AND user_id IS NOT NULL)
  AND user_id IS NOT NULL""")
def part_dynamic(t):
    """Users seen in the first six hours are registered, the others are new."""
    registry = t.events.filter(F.col("ts") < F.lit("2024-01-01 06:00:00").cast("timestamp_ntz")).select(
        "user_id").distinct()
    return partitions.new_partitions(t.events, "user_id", registry)


@query("part_params", """
SELECT 'standard' AS params, count(*) AS kept, round(sum(o_totalprice), 4) AS total
FROM orders WHERE o_totalprice <= 100000
UNION ALL
SELECT 'strict', count(*), round(sum(o_totalprice), 4) FROM orders WHERE o_totalprice <= 50000""")
def part_params(t):
    params = [{"name": "standard", "max_price": 100000.0}, {"name": "strict", "max_price": 50000.0}]
    return rounded(partitions.run_for_params(
        t.orders, params, lambda p: F.col("o_totalprice") <= p["max_price"],
        [F.count(F.lit(1)).alias("kept"), F.sum("o_totalprice").alias("total")]))


@query("part_factory", """
SELECT customer_id, count(*) AS records, round(sum(amount), 4) AS total, TRUE AS transformed,
       'success' AS status
FROM v_sales GROUP BY customer_id""", (V_SALES,))
def part_factory(t):
    per_customer = partitions.run_by_key(sales(t), "customer_id", [
        F.count(F.lit(1)).alias("records"), F.sum("amount").alias("total")])
    return rounded(per_customer.withColumns({"transformed": F.lit(True),
                                             "status": F.lit("success")}))


@query("part_run_one", """
SELECT event_id, value, '2024-01-30' AS date, TRUE AS transformed FROM events
WHERE ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31'""")
def part_run_one(t):
    """Only the last day finished before now is processed."""
    path = shared_dir(t.spark, "one-day")
    days = assign_partition(t.events.select("event_id", "value", "ts"), "ts", output="date")
    run_partition(days, "date", path, now=datetime.fromisoformat(NOW), ts="ts",
                  transform=lambda rows: rows.withColumn("transformed", F.lit(True)))
    return t.spark.read.schema(
        "event_id bigint, value double, transformed boolean, date string").parquet(path)


@query("part_backfill", """
WITH hours AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00',
                                             INTERVAL 1 HOUR)) AS h),
types AS (SELECT DISTINCT event_type FROM events)
SELECT event_type, strftime(h, '%Y-%m-%d-%H:%M') AS partition_key
FROM hours, types
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.event_type = types.event_type
                  AND date_trunc('hour', e.ts) = h)""")
def part_backfill(t):
    bounds = t.events.select("event_type").distinct().withColumns({
        "lo": F.to_timestamp(F.lit("2024-01-01")), "hi": F.to_timestamp(F.lit(NOW))})
    calendar = partitions.partition_calendar(bounds, "lo", "hi", "hourly")
    existing = assign_partition(t.events.select("event_type", "ts"), "ts", "hourly")
    return partitions.missing_partitions(
        calendar.select("event_type", "partition_key"), existing, "event_type", "partition_key")


@query("part_backfill_ranges", """
, flags AS (
  SELECT event_type, h, EXISTS (SELECT 1 FROM events e WHERE e.event_type = types.event_type
                                AND date_trunc('hour', e.ts) = h) AS there
  FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-30 23:00', INTERVAL 1 HOUR)) AS h),
       (SELECT DISTINCT event_type FROM events) AS types),
runs AS (
  SELECT *, count(*) FILTER (WHERE there) OVER (PARTITION BY event_type ORDER BY h) AS run FROM flags)
SELECT event_type, strftime(min(h), '%Y-%m-%d-%H:%M') AS first_key, strftime(max(h), '%Y-%m-%d-%H:%M') AS last_key,
       count(*) AS periods
FROM runs WHERE NOT there GROUP BY event_type, run""", ("own AS (SELECT 1)",))
def part_backfill_ranges(t):
    """The missing hours as ranges to run again."""
    bounds = t.events.select("event_type").distinct().withColumns({
        "lo": F.lit("2024-01-01").cast("timestamp_ntz"), "hi": F.lit(NOW).cast("timestamp_ntz")})
    calendar = partitions.partition_calendar(bounds, "lo", "hi", "hourly")
    existing = assign_partition(t.events.select("event_type", "ts"), "ts", "hourly")
    return partitions.missing_ranges(calendar, existing, "event_type", "partition_key")


# Minutes that the clocks of zones without clock changes are ahead of UTC.
AHEAD = {"Asia/Kolkata": 330, "Asia/Kathmandu": 345}


@query("part_zones", "\nUNION ALL\n".join(f"""
SELECT '{tz}' AS zone, strftime(date_trunc('hour', ts + INTERVAL {m} MINUTE), '%Y%m%d %H') AS partition_key,
       strftime(date_trunc('hour', ts + INTERVAL {m} MINUTE) - INTERVAL {m} MINUTE, '%Y-%m-%d %H:%M:%S') AS period_start,
       count(*) AS events
FROM events GROUP BY ALL""" for tz, m in AHEAD.items()))
def part_zones(t):
    """Events per hour by clocks off the full hour, each joined to its period of the calendar."""
    edge = t.events.agg((F.min("ts") - F.expr("INTERVAL 2 HOURS")).alias("lo"),
                        (F.max("ts") + F.expr("INTERVAL 2 HOURS")).alias("hi"))
    found = []
    for tz in AHEAD:
        periods = partitions.partition_calendar(edge, "lo", "hi", "hourly", tz, "%Y%m%d %H")
        keyed = assign_partition(t.events.select("ts"), "ts", "hourly", tz, "%Y%m%d %H").groupBy("partition_key").agg(
            F.count(F.lit(1)).alias("events"))
        found.append(keyed.join(periods, "partition_key").select(
            F.lit(tz).alias("zone"), "partition_key", text_time("period_start").alias("period_start"), "events"))
    return reduce(DataFrame.unionByName, found)


# ---- freshness

# Schedules an asset has: by the types of its first and of its last event.
SCHEDULES = [("click", 60, "2024-01-30 23:30:00"), ("view", 360, "2024-01-30 18:00:00"),
             ("purchase", 1440, "2024-01-30 06:00:00")]
V_SCHEDULES = f"""v_schedules AS (
  SELECT DISTINCT 'asset_' || user_id AS asset, ord, interval_minutes, last_deadline
  FROM (
    SELECT user_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_type) = 1
         OR row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) = 1)
  JOIN (VALUES """ + ", ".join(
    f"('{kind}', {i}, {minutes}, TIMESTAMP '{deadline}')"
    for i, (kind, minutes, deadline) in enumerate(SCHEDULES)) + """)
    AS s(event_type, ord, interval_minutes, last_deadline) USING (event_type))"""
V_POLICIES = """v_policies AS (
  SELECT asset, interval_minutes, last_deadline FROM v_schedules
  QUALIFY row_number() OVER (PARTITION BY asset ORDER BY interval_minutes, ord) = 1)"""


def schedules(t):
    kind = F.col("event_type")
    pick = F.coalesce(*[
        F.when(kind == name, F.struct(
            F.lit(i).alias("ord"), F.lit(minutes).alias("interval_minutes"),
            F.lit(deadline).cast("timestamp_ntz").alias("last_deadline")))
        for i, (name, minutes, deadline) in enumerate(SCHEDULES)])
    when = F.struct("ts", "event_type")
    ends = t.events.groupBy("user_id").agg(F.min(when).alias("first"), F.max(when).alias("last"))
    return (ends.select("user_id", F.explode(F.array("first.event_type", "last.event_type")).alias("event_type"))
            .select(F.concat(F.lit("asset_"), "user_id").alias("asset"), pick.alias("s"))
            .filter("s is not null").select("asset", "s.*").distinct())


@query("fresh_policy", """
SELECT asset, interval_minutes, strftime(last_deadline, '%Y-%m-%d %H:%M:%S') AS last_deadline
FROM v_policies""", (V_SCHEDULES, V_POLICIES))
def fresh_policy(t):
    return freshness.freshness_policies(schedules(t)).withColumn(
        "last_deadline", text_time("last_deadline"))


@query("fresh_policy_explicit", """
SELECT asset, CASE WHEN k % 3 = 0 THEN 720 ELSE interval_minutes END AS interval_minutes,
       strftime(CASE WHEN k % 3 = 0 THEN TIMESTAMP '2024-01-30 12:00:00' ELSE last_deadline END, '%Y-%m-%d %H:%M:%S') AS last_deadline
FROM (SELECT DISTINCT user_id AS k, 'asset_' || user_id AS asset FROM events) LEFT JOIN v_policies USING (asset)
WHERE k % 3 = 0 OR interval_minutes IS NOT NULL""", (V_SCHEDULES, V_POLICIES))
def fresh_policy_explicit(t):
    """Every third asset has a policy of its own, whatever its schedules say."""
    own = t.events.filter("user_id % 3 = 0").select(F.concat(F.lit("asset_"), "user_id").alias("asset")).distinct().select(
        "asset", F.lit(0).alias("ord"), F.lit(720).alias("interval_minutes"),
        F.lit("2024-01-30 12:00:00").cast("timestamp_ntz").alias("last_deadline"))
    return freshness.freshness_policies(schedules(t), own).withColumn("last_deadline", text_time("last_deadline"))


@query("fresh_status", """
SELECT asset, interval_minutes, strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_ts,
       CASE WHEN last_ts >= last_deadline - to_minutes(interval_minutes) THEN 'PASS'
            ELSE 'FAIL' END AS status
FROM v_policies LEFT JOIN (SELECT asset, max(ts) AS last_ts FROM v_mat WHERE success
                           GROUP BY asset) USING (asset)""", (V_SCHEDULES, V_POLICIES, V_MAT))
def fresh_status(t):
    status = freshness.freshness(materializations(t).filter("success"),
                                 freshness.freshness_policies(schedules(t)))
    return status.select("asset", "interval_minutes", text_time("last_ts").alias("last_ts"),
                         "status")


def _next_edges(t):
    """Each asset depends on the next two."""
    users = t.events.select("user_id").distinct()
    return users.select(
        F.concat(F.lit("asset_"), "user_id").alias("consumer"),
        F.explode(F.array(F.col("user_id") + 1, F.col("user_id") + 2)).alias("n")
    ).select("consumer", F.concat(F.lit("asset_"), "n").alias("dep"))


V_STALE = """last_ts AS (SELECT asset, max(ts) AS ts FROM v_mat WHERE success GROUP BY asset),
next_edges AS (
  SELECT DISTINCT 'asset_' || user_id AS consumer, 'asset_' || (user_id + k) AS dep
  FROM events, (VALUES (1), (2)) AS v(k)),
timed AS (
  SELECT consumer, d.ts AS dep_ts, o.ts AS own_ts
  FROM next_edges LEFT JOIN last_ts d ON d.asset = dep LEFT JOIN last_ts o ON o.asset = consumer)"""


@query("stale_eager", """
SELECT consumer, count(*) AS deps,
       CASE WHEN any_value(own_ts) IS NULL THEN count(dep_ts) > 0
            ELSE coalesce(bool_or(dep_ts > own_ts), FALSE) END AS stale
FROM timed GROUP BY consumer""", (V_MAT, V_STALE))
def stale_eager(t):
    return freshness.stale(_next_edges(t), materializations(t).filter("success"), "any")


@query("stale_all_inlets", """
SELECT consumer, count(*) AS deps,
       count(dep_ts) = count(*) AND (any_value(own_ts) IS NULL OR bool_and(dep_ts > own_ts))
         AS stale
FROM timed GROUP BY consumer""", (V_MAT, V_STALE))
def stale_all_inlets(t):
    return freshness.stale(_next_edges(t), materializations(t).filter("success"), "all")


def runs(t):
    """Events as runs that last 37.5 seconds per unit of value."""
    micros = F.round(F.col("value") * 37500000.0).cast("bigint")
    start = F.unix_micros(F.col("ts").cast("timestamp"))
    return t.events.select(
        F.concat(F.lit("asset_"), "user_id").alias("asset"), "event_id",
        F.col("ts").cast("timestamp").alias("start"),
        F.timestamp_micros(start + micros).alias("end"),
        (F.col("event_type") != "error").alias("success"),
        F.repeat(F.concat("event_type", F.lit(" "), "props", F.lit(" ")), F.lit(400))
        .alias("stdout"))


@query("run_summary", """
WITH r AS (
  SELECT event_id, CAST(round(value * 37500000.0::DOUBLE) AS BIGINT) / 1000000.0::DOUBLE AS s,
         right(repeat(event_type || ' ' || props || ' ', 400), 5000) AS stdout
  FROM events)
SELECT event_id, CAST(printf('%.2f', s) AS DOUBLE) AS duration_seconds,
       CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%.1fm', s / 60)
            ELSE printf('%.1fh', s / 3600) END AS execution_time,
       md5(stdout) AS stdout_md5
FROM r""")
def run_summary(t):
    summary = freshness.run_summary(runs(t))
    return summary.select("event_id", "duration_seconds", "execution_time",
                          F.md5("stdout").alias("stdout_md5"))


@query("run_outcomes", """
SELECT 'asset_' || user_id AS asset, count(*) AS runs,
       count(*) FILTER (WHERE event_type = 'error') AS failures,
       round(avg(value) + 1e-7, 4) AS average_duration,
       arg_max(value, row(ts, event_id)) AS latest_duration
FROM events GROUP BY user_id""")
def run_outcomes(t):
    timed = t.events.select(F.concat(F.lit("asset_"), "user_id").alias("asset"), "event_id", "ts",
                            (F.col("event_type") != "error").alias("success"), "value")
    return rounded(freshness.run_outcomes(timed, duration="value"))
