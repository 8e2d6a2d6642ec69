"""Keeps each query next to the SQL that should give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.tables import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = (),
          recursive: bool = False):
    """Register ``fn(tables)``; without SQL only its rows are looked at."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            # calendar arithmetic is done in UTC, whatever the session started with
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            start = "WITH RECURSIVE " if recursive else "WITH "
            SQL[name] = (start + ", ".join(views) + "\n" if views else "") + sql.strip()
        return fn
    return register


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded for comparison: sums differ in the last bits by order.

    An average of cents often lies exactly half way between two rounded values,
    where the last bits decide. The small addend, also in the SQL, lifts it off.
    """
    scale = float(10 ** digits)
    return df.select(*[
        (F.rint((F.col(f.name) + F.lit(1e-7)) * scale) / scale).alias(f.name) if f.dataType.simpleString() == "double"
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def text_time(c: str):
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
