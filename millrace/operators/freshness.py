"""Freshness, staleness and run reports over materialization and run logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.numbers import human_duration, printed_round
from millrace.functions.text import tail

# How much of a run's output is kept, and decimals of a duration.
OUTPUT_TAIL = 5000
DURATION_DECIMALS = 2


def last_times(events: DataFrame, asset: str = "asset", ts: str = "ts") -> DataFrame:
    """Time of the latest materialization per asset."""
    return events.groupBy(F.col(asset).alias("asset")).agg(F.max(ts).alias("last_ts"))


def freshness_policies(schedules: DataFrame, explicit: DataFrame | None = None) -> DataFrame:
    """Per asset, its own policy, else the schedule with the shortest interval; the first wins a tie.

    ``schedules(asset, ord, interval_minutes, last_deadline)``; a schedule without an interval
    sets no policy. ``explicit`` has the same columns: policies set on an asset itself, which
    no schedule replaces. Of several on one asset the first counts.
    """
    columns = ["asset", "ord", "interval_minutes", "last_deadline"]
    usable = schedules.filter(F.col("interval_minutes") > 0).select(
        *columns, F.lit(1).alias("rank"), F.col("interval_minutes").alias("place"))
    if explicit is not None:
        usable = usable.unionByName(explicit.filter(F.col("interval_minutes").isNotNull()).select(
            *columns, F.lit(0).alias("rank"), F.lit(0).alias("place")))
    return usable.groupBy("asset").agg(
        F.min_by(F.struct("interval_minutes", "last_deadline"),
                 F.struct("rank", "place", "ord")).alias("policy")
    ).select("asset", "policy.*")


def freshness(events: DataFrame, policies: DataFrame) -> DataFrame:
    """PASS when the last materialization is within the window before the last deadline.

    The window is the schedule's interval. An asset that was never materialized
    fails.
    """
    earliest = F.col("last_deadline") - F.make_dt_interval(mins=F.col("interval_minutes"))
    return policies.join(last_times(events), "asset", "left").withColumn(
        "status", F.when(F.col("last_ts") >= earliest, "PASS").otherwise("FAIL"))


def stale(edges: DataFrame, events: DataFrame, mode: str = "any") -> DataFrame:
    """Per consumer, whether its inputs call for a new run.

    ``any``: some input was materialized after the consumer, or the consumer
    never was and some input was. ``all``: every input was materialized after
    the consumer's last run. Times are reduced to one row per asset before
    they meet the edges.
    """
    if mode not in ("any", "all"):
        raise ValueError("mode is 'any' or 'all'")
    times = last_times(events)
    dep_times = times.select(F.col("asset").alias("dep"), F.col("last_ts").alias("dep_ts"))
    own_times = times.select(F.col("asset").alias("consumer"), F.col("last_ts").alias("own_ts"))
    per_consumer = edges.join(dep_times, "dep", "left").groupBy("consumer").agg(
        F.max("dep_ts").alias("newest_dep"), F.min("dep_ts").alias("oldest_dep"),
        F.count_if(F.col("dep_ts").isNull()).alias("never_built"),
        F.count(F.lit(1)).alias("deps"))
    joined = per_consumer.join(own_times, "consumer", "left")
    own = F.col("own_ts")
    if mode == "any":
        verdict = F.when(own.isNull(), F.col("newest_dep").isNotNull()).otherwise(
            F.coalesce(F.col("newest_dep") > own, F.lit(False)))
    else:
        verdict = (F.col("never_built") == 0) & (own.isNull() | (F.col("oldest_dep") > own))
    return joined.select("consumer", "deps", verdict.alias("stale"))


def run_seconds(start: Column, end: Column) -> Column:
    """Length of a run in seconds, to the microsecond."""
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def run_summary(runs: DataFrame, start: str = "start", end: str = "end",
                output: str = "stdout") -> DataFrame:
    """Duration, its readable form, and the tail of the output, per run."""
    seconds = run_seconds(F.col(start), F.col(end))
    return runs.withColumns({
        "duration_seconds": printed_round(seconds, DURATION_DECIMALS),
        "execution_time": human_duration(seconds),
        output: tail(F.col(output), OUTPUT_TAIL),
    })


def run_outcomes(runs: DataFrame, asset: str = "asset", duration: str = "duration",
                 ts: str = "ts", tie: str = "event_id", success: str = "success") -> DataFrame:
    """Runs, failures, average and latest duration per asset."""
    return runs.groupBy(asset).agg(
        F.count(F.lit(1)).alias("runs"), F.count_if(~F.col(success)).alias("failures"),
        F.avg(duration).alias("average_duration"),
        F.max_by(F.col(duration), F.struct(ts, tie)).alias("latest_duration"))
