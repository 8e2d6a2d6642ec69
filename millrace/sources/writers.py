"""Writing CSV, JSON, XML and partitioned Parquet."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.periods import key_bounds, last_finished_key
from millrace.session import exists, folders_of, remove, stored_partitions

# The output formats that can be asked for.
OUTPUT_FORMATS = ("json", "csv", "xml")
CSV_PREVIEW_ROWS = 5


def save_csv(df: DataFrame, path: str, order: list[Column | str] | None = None) -> tuple[int, DataFrame]:
    """Write CSV with a header; return the row count and a frame of first rows.

    The count is observed while writing, so the input is computed once. The preview reads
    the written files: their first rows in an order if one is given, else as they come.
    """
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("header", True).csv(path))
    stored = df.sparkSession.read.schema(df.schema).option("header", True).csv(path)
    return seen.get["rows"], (stored.orderBy(*order) if order else stored).limit(CSV_PREVIEW_ROWS)


def save_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_as(df: DataFrame, path: str, fmt: str) -> None:
    """Write as json, csv or xml; anything else is an error."""
    if fmt not in OUTPUT_FORMATS:
        raise ValueError(f"output format {fmt!r} is not one of {', '.join(OUTPUT_FORMATS)}")
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    elif fmt == "xml":
        writer = writer.option("rowTag", "record")
    writer.save(path)


def copy_into(spark: SparkSession, path: str, table_path: str, schema: str,
              header: bool = False) -> None:
    """Append CSV files to a Parquet table; a malformed line fails the load."""
    (spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").csv(path)
     .write.mode("append").parquet(table_path))


def write_partition(df: DataFrame, path: str, *columns: str, rebalance: bool = False) -> None:
    """Write partitioned Parquet, replacing only the partitions in ``df``.

    The overwrite mode is set on this write alone, not on the session. When rows
    of many partitions are mixed, every task would write a file in each of them:
    ``rebalance`` brings a partition's rows together first, and AQE splits a
    large partition and merges small ones into files of the advisory size.
    """
    if rebalance:
        df = df.hint("rebalance", *columns)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*columns).parquet(path))


def write_by_key(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Write a keyed result into a fixed number of folders, replaced one by one.

    One folder per key would make as many files as there are keys; a row of key
    ``k`` is found in ``bucket = pmod(xxhash64(k), buckets)``.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    write_partition(df.withColumn("bucket", bucket), path, "bucket")


def within(df: DataFrame, ts: str, start: datetime, end: datetime) -> DataFrame:
    """Rows from ``start`` up to, not including, ``end`` (UTC), as filters the scan can use."""
    kind = df.schema[ts].dataType
    return df.filter((F.col(ts) >= F.lit(start.isoformat(" ")).cast(kind))
                     & (F.col(ts) < F.lit(end.isoformat(" ")).cast(kind)))


class _NoKey:
    """Stands for the partition of rows whose key is null."""


NULL_KEY = _NoKey()


def replace_partition(rows: DataFrame, path: str, column: str, key: str | _NoKey) -> int:
    """Make ``rows`` the whole content of one partition; return how many there are.

    Folders are named by Spark. Rows replace their folder by a dynamic overwrite, which
    keeps what was there until they are written. Without rows, the folder that Spark lists
    for the key is deleted. An empty key is an error, because Spark stores it as null.
    """
    if key == "":
        raise ValueError("an empty partition key would be stored as null; name it NULL_KEY")
    spark, seen = rows.sparkSession, Observation()
    value = F.lit(None if key is NULL_KEY else key).cast("string")
    write_partition(rows.drop(column).observe(seen, F.count(F.lit(1)).alias("rows")).withColumn(column, value), path, column)
    written = seen.get["rows"]
    if not written and exists(spark, path):
        stored = stored_partitions(spark, path, f"`{column}` string")
        remove(spark, *folders_of(stored.filter(F.col(f"`{column}`").eqNullSafe(value))))
    return written


def run_partition(df: DataFrame, key_column: str, path: str, key: str | _NoKey | None = None,
                  now: datetime | None = None, cadence: str = "daily", tz: str = "UTC",
                  transform=None, ts: str | None = None, fmt: str | None = None) -> str | _NoKey:
    """Process one partition key and replace only it; return the key.

    A rerun that yields no rows leaves none, and no other partition is touched whatever
    ``transform`` returns. ``NULL_KEY`` runs the rows without a key.

    Without a key, the last period finished before ``now`` is used, written in the format
    of ``fmt`` if given. The filter reaches the scan when the source is partitioned by the
    key. When the key is computed from a time, name that column as ``ts``: its range is
    filtered too, which skips the files and row groups of other periods.
    """
    if key is None:
        if now is None:
            raise ValueError("give a key, or the time to take the last finished period of")
        key = last_finished_key(now, cadence, tz, fmt)
    if ts:
        df = within(df, ts, *key_bounds(key, cadence, tz, fmt))
    rows = df.filter(F.col(f"`{key_column}`").isNull() if key is NULL_KEY else F.col(f"`{key_column}`") == F.lit(key))
    replace_partition(transform(rows) if transform else rows, path, key_column, key)
    return key


def write_routes(df: DataFrame, path: str, label: Column, column: str = "route") -> None:
    """Write every branch of a labelled input to its own folder in one pass."""
    df.withColumn(column, label).write.mode("overwrite").partitionBy(column).parquet(path)
