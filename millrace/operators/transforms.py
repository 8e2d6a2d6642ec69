"""Projections and filters over records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.text import clean_name, is_email

# Thresholds, labels and scores of the record reports.
HIGH_VALUE = 150
LARGE_VALUE = 100
TOP_TIER = "enterprise"
TOP_SCORE, BASE_SCORE = 100, 50


def categorize(df: DataFrame, value: str = "value", threshold: float = HIGH_VALUE) -> DataFrame:
    """Add the doubled value, and ``high`` above the threshold or else ``low``."""
    v = F.col(value)
    return df.withColumns({
        "value_doubled": v * 2,
        "value_category": F.when(v > threshold, "high").when(v <= threshold, "low"),
    })


def double_values(df: DataFrame, value: str = "value", output: str = "value") -> DataFrame:
    return df.withColumn(output, F.col(value) * 2)


def double_array(df: DataFrame, numbers: str = "data", output: str = "data") -> DataFrame:
    """Every element of an array column doubled."""
    return df.withColumn(output, F.transform(numbers, lambda x: x * 2))


def increment_array(df: DataFrame, numbers: str = "data", output: str = "data") -> DataFrame:
    """Every element of an array column plus one."""
    return df.withColumn(output, F.transform(numbers, lambda x: x + 1))


def kept_counts(df: DataFrame, keep: Column, kept: str, dropped: str, total: str) -> DataFrame:
    """How many rows a predicate keeps and drops, in one pass."""
    keep = F.coalesce(keep, F.lit(False))
    return df.agg(F.count_if(keep).alias(kept), F.count_if(~keep).alias(dropped),
                  F.count(F.lit(1)).alias(total))


def clean_records(df: DataFrame, valid: str = "valid",
                  value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Valid rows with a non-negative value, and the counts."""
    keep = F.col(valid) & F.col(value).isNotNull() & (F.col(value) >= 0)
    return df.filter(keep), kept_counts(df, keep, "records_kept", "records_removed", "records")


def filter_min(df: DataFrame, text: str, minimum: int) -> tuple[DataFrame, DataFrame]:
    """Rows whose text has at least ``minimum`` characters, and the counts."""
    measured = df.withColumn("length", F.length(text).cast("bigint"))
    keep = F.col("length") >= minimum
    return measured.filter(keep), kept_counts(measured, keep, "kept", "dropped", "total")


def filter_max(df: DataFrame, amount: str, maximum: float) -> tuple[DataFrame, DataFrame]:
    """Rows whose amount is at most ``maximum``, and the counts."""
    keep = F.col(amount) <= maximum
    return df.filter(keep), kept_counts(df, keep, "kept_count", "dropped_count", "total_count")


def route_label(value: Column, threshold: float = LARGE_VALUE) -> Column:
    return F.when(value > threshold, "process_large").otherwise("process_small")


def route(df: DataFrame, value: str = "value",
          threshold: float = LARGE_VALUE) -> tuple[DataFrame, DataFrame]:
    """The large and the small branch, labelled.

    Each branch is a filter that reaches the scan. To write both in one pass
    use ``sources.writers.write_routes``.
    """
    labelled = df.withColumn("route", route_label(F.col(value), threshold))
    return (labelled.filter(F.col(value) > threshold),
            labelled.filter((F.col(value) <= threshold) | F.col(value).isNull()))


def upper_names(df: DataFrame, name: str = "name") -> DataFrame:
    return df.withColumn(name, F.upper(name))


def enrich_customers(df: DataFrame, tier: str = "tier", region: str = "region") -> DataFrame:
    """Add a score by tier and the lower-case region code."""
    score = F.when(F.col(tier) == TOP_TIER, TOP_SCORE).otherwise(BASE_SCORE)
    return df.withColumns({"score": score, "region_code": F.lower(region)})


def validate_customers(df: DataFrame, name: str = "name", email: str = "email",
                       tier: str = "tier") -> DataFrame:
    """Flag the e-mail address, tidy the name, score by tier.

    The steps are given, their rules are ours: see ``is_email`` and
    ``clean_name``.
    """
    return df.withColumns({
        "email_valid": is_email(F.col(email)),
        name: clean_name(F.col(name)),
        "score": F.when(F.col(tier) == TOP_TIER, TOP_SCORE).otherwise(BASE_SCORE),
    })


def with_spread(df: DataFrame, bid: str = "best_bid", ask: str = "best_ask") -> DataFrame:
    """Spread of a quote in percent of the bid; null for a zero bid."""
    return df.withColumn(
        "spread_pct", F.try_divide(F.col(ask) - F.col(bid), F.col(bid)) * 100)


def with_run_date(df: DataFrame, text: str = "date") -> tuple[DataFrame, DataFrame]:
    """Rows with a real ``YYYY-MM-DD`` date plus its weekday name, and the rejects.

    Month and day may have one digit, as strptime allows.
    """
    shaped = F.col(text).rlike(r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$")
    day = F.when(shaped, F.try_to_timestamp(F.col(text), F.lit("yyyy-M-d"))).cast("date")
    parsed = df.withColumn("run_date", day)
    good = parsed.filter(F.col("run_date").isNotNull()).withColumn(
        "weekday", F.date_format("run_date", "EEEE"))
    return good, parsed.filter(F.col("run_date").isNull()).drop("run_date")


def limit_ordered(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """First ``n`` rows in an order, which a distributed table needs to be told.

    Spark keeps ``n`` rows per task and merges those (top-k, no full sort). For
    an ``n`` that does not fit a task, ``spark.sql.execution.topKSortFallbackThreshold``
    makes it a distributed sort.
    """
    return df.orderBy(*order).limit(n)
