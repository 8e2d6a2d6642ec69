"""Partition calendars, assignment, named parameter sets and backfill."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.periods import (DEFAULT_DAYS, QUARTER, floor_to, instant, key_of, local_time, minutes,
                                        partition_key, period_unit, step, utc_clock, utc_time)


def partition_calendar(bounds: DataFrame, start: str | None, end: str, cadence: str | None = "daily",
                       tz: str = "UTC", fmt: str | None = None) -> DataFrame:
    """Every period from ``start`` to the last one finished by ``end``, per row of bounds.

    Both name columns of times; without ``start`` the calendar goes back 30 days for hours
    and days, 180 for weeks and 365 for months. A period counts when it begins at or after
    ``start`` and is over at ``end``. Days and longer are laid out by the clock of the zone,
    so a day across a clock change has 23 or 25 hours. An hour begins where that clock shows
    a full hour, or jumps into another one; one that is shown twice gives two periods of
    one key. Keys are those that ``assign_partition`` gives the times inside. The result
    does not depend on the session's zone; ``period_start`` and ``period_end`` are instants.
    """
    unit, one = period_unit(cadence), step(cadence)
    until = utc_clock(F.col(end))
    since = utc_clock(F.col(start)) if start else until - F.expr(f"INTERVAL {DEFAULT_DAYS[unit]} DAYS")
    limits = bounds.select(*bounds.columns, since.alias("_since"), until.alias("_until"))
    since, until, period = F.col("_since"), F.col("_until"), F.col("_period")
    if unit == "hour" and tz != "UTC":
        rows = _hours(limits, tz)
    else:
        laid = lambda c: floor_to(local_time(c, tz), unit)
        first, last = laid(since), laid(until) - one
        first = F.when(first < local_time(since, tz), first + one).otherwise(first)
        periods = F.when(first <= last, F.sequence(first, last, one))
        rows = limits.select("*", F.explode(periods).alias("_local")).select(
            *bounds.columns, "_local", utc_time(F.col("_local"), tz).alias("_period"),
            utc_time(F.col("_local") + one, tz).alias("_after"))
    return rows.select(*bounds.columns, key_of(F.col("_local"), cadence, fmt).alias("partition_key"),
                       instant(period).alias("period_start"), instant(F.col("_after")).alias("period_end"))


def _hours(limits: DataFrame, tz: str) -> DataFrame:
    """Hours of a zone's clock, found among the quarters of an hour."""
    def begins(at: Column) -> Column:
        shown = local_time(at, tz)
        return (F.minute(shown) == 0) | (floor_to(shown, "hour") != floor_to(local_time(at - minutes(QUARTER), tz), "hour"))

    since, until, at = F.col("_since"), F.col("_until"), F.col("_period")
    quarter = floor_to(since, "hour") + minutes(QUARTER) * F.floor(F.minute(since) / QUARTER).cast("int")
    quarter = F.when(quarter < since, quarter + minutes(QUARTER)).otherwise(quarter)
    found = F.when(quarter < until, F.sequence(quarter, until, minutes(QUARTER)))
    # the longest hour, with a change of the clock in it, has two
    later = F.filter(F.transform(F.array(*[F.lit(i) for i in range(1, 9)]), lambda i: at + minutes(QUARTER) * i), begins)
    return (limits.select("*", F.explode(found).alias("_period")).filter(begins(at))
            .withColumns({"_local": floor_to(local_time(at, tz), "hour"), "_after": F.get(later, F.lit(0))})
            .filter(F.col("_after") <= until))


def assign_partition(df: DataFrame, ts: str, cadence: str | None = "daily", tz: str = "UTC",
                     fmt: str | None = None, output: str = "partition_key") -> DataFrame:
    """Add the key of the period each row falls in."""
    return df.withColumn(output, partition_key(F.col(ts), cadence, tz, fmt))


def filter_static(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Rows of a declared list of keys; the filter reaches the scan."""
    return df.filter(F.col(column).isin(*values))


def new_partitions(df: DataFrame, column: str, registry: DataFrame) -> DataFrame:
    """Keys in the data that are not registered yet."""
    return (df.select(column).filter(F.col(column).isNotNull()).distinct()
            .join(registry.select(column), column, "left_anti"))


def missing_partitions(calendar: DataFrame, existing: DataFrame, *keys: str) -> DataFrame:
    """Expected partitions without data (or without a successful run)."""
    return calendar.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def missing_ranges(calendar: DataFrame, existing: DataFrame, *keys: str, order: str = "period_start") -> DataFrame:
    """Runs of neighbouring missing periods, as a backfill asks for them.

    ``calendar`` has one row for each expected period of each asset; the last of ``keys``
    is the period's key, those before it name the asset. One row for each run: the asset, keys
    of its first and last period, and how many there are.
    """
    *asset, key = keys
    there = existing.select(*keys).distinct().withColumn("_there", F.lit(True))
    in_order = Window.partitionBy(*asset).orderBy(order, key)
    # missing periods that follow each other have as many present ones before them
    numbered = calendar.select(*keys, order).join(there, list(keys), "left").withColumn(
        "_before", F.count("_there").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    place = F.struct(order, key)
    return (numbered.filter("_there IS NULL").groupBy(*asset, "_before")
            .agg(F.min(place).alias("_first"), F.max(place).alias("_last"), F.count(F.lit(1)).alias("periods"))
            .select(*asset, F.col(f"_first.{key}").alias("first_key"), F.col(f"_last.{key}").alias("last_key"), "periods"))


def run_for_params(df: DataFrame, params: list[dict], keep, aggregates: list[Column],
                   name: str = "params") -> DataFrame:
    """One aggregate query for several named parameter sets in one scan.

    ``params`` are dicts with a ``name`` and the parameters; ``keep(p)`` is the
    row filter for the set ``p``. A row is repeated only for the sets it
    belongs to, and partial aggregation follows in the same stage.
    """
    sets = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in p.items()]) for p in params])
    matching = df.withColumn("_set", F.explode(F.filter(sets, keep)))
    return matching.groupBy(F.col("_set.name").alias(name)).agg(*aggregates)


def run_by_key(df: DataFrame, key: str, aggregates: list[Column]) -> DataFrame:
    """The same aggregate for every key as one grouped plan."""
    return df.groupBy(key).agg(*aggregates)
