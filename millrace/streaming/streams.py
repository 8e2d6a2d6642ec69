"""Order-book windows, asset triggers, event landing and alerts as streams.

Each function runs what has arrived on a stream, and stops. None has a watermark: what
comes late is added to where it belongs, and a batch that runs twice counts once.
"""

from __future__ import annotations

from concurrent.futures import Future
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.numbers import printed_round
from millrace.operators.aggregates import MIN_MARKET_VOLUME, MIN_SPREAD_PCT, rule_violations
from millrace.operators.transforms import with_spread
from millrace.session import exists, folders_of, remove, stored_partitions
from millrace.sources.writers import write_partition
from millrace.streaming.totals import WindowTotals, replace_buckets

DELAY = timedelta(minutes=10)


def read_stream(spark: SparkSession, folder: str, schema, pattern: str | None = None,
                files_per_batch: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """A zone-less time as UTC: the windows of a stream are between instants."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def _run_batches(rows: DataFrame, checkpoint_dir: str, take) -> None:
    """``take(batch, name)`` for each batch that has arrived; a batch that runs again has the same name."""
    stream: Future[str] = Future()
    query = (rows.writeStream.foreachBatch(lambda batch, n: take(batch, f"{stream.result()}-{n}"))
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    stream.set_result(str(query.id))
    query.awaitTermination()


# ---- order book

def order_book_totals(path: str, delay: timedelta = DELAY, width: timedelta = timedelta(hours=1),
                      bucket: str = "day") -> WindowTotals:
    """Snapshots, spreads and volume per market and window, below a folder."""
    spread = F.col("spread_pct")
    return WindowTotals(f"{path}/totals", {
        "snapshot_count": ("bigint", F.lit(1)), "spreads": ("bigint", spread.isNotNull().cast("bigint")),
        "spread_sum": ("double", spread), "total_market_volume": ("bigint", F.col("total_volume"))},
        {"market_id": "string"}, delay=delay, width=width, bucket=bucket)


def order_book_stream(book: DataFrame, path: str, checkpoint_dir: str, min_spread: float = MIN_SPREAD_PCT,
                      min_volume: float = MIN_MARKET_VOLUME, delay: timedelta = DELAY,
                      width: timedelta = timedelta(hours=1), bucket: str = "day") -> WindowTotals:
    """Write markets that break the rules, per closed window, to ``path/violations``.

    A late snapshot changes its window, which is then judged again: violations appear or go. Windows
    are judged once all that has arrived is added.
    """
    totals = order_book_totals(path, delay, width, bucket)

    def emit(rows: DataFrame, due: Column) -> None:
        found = rule_violations(rows.withColumn("avg_spread_pct", F.try_divide("spread_sum", "spreads")), min_spread, min_volume)
        replace_buckets(found.select("window_start", "market_id", "snapshot_count", "avg_spread_pct",
                                     "total_market_volume", "bucket"), due, f"{path}/violations", "bucket")

    totals.run(with_spread(book), checkpoint_dir, emit)
    return totals


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else spark.createDataFrame([], schema)


def violations(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, f"{path}/violations", "window_start timestamp, market_id string, snapshot_count bigint, "
                 "avg_spread_pct double, total_market_volume bigint, bucket string").drop("bucket")


# ---- triggers

_RUNS = "run_key string, job string, asset string, event_id bigint, ts timestamp, prefix int, part string"


def trigger_stream(events: DataFrame, watch: DataFrame, path: str, checkpoint_dir: str, prefixes: int = 64) -> None:
    """Append one run row per new successful materialization of a watched asset.

    ``watch(asset, job)`` says which job follows which asset. The runs are also the ledger
    of what has been started: partitioned by a prefix of the key's hash, of which a batch
    reads only those its own keys have. So an event delivered again starts no second run,
    however much later, and none is too late. Copies of an event are reduced in each task
    before they are shuffled. Streams that share a ledger must not run at the same time.
    """
    def take(batch: DataFrame, part: str) -> None:
        spark = batch.sparkSession
        runs = batch.filter("success").join(watch.select("asset", "job"), "asset").select(
            F.concat_ws(":", "job", F.col("event_id").cast("string")).alias("run_key"), "job", "asset", "event_id", "ts")
        once = runs.groupBy("run_key").agg(F.min(F.struct("ts", "job", "asset", "event_id")).alias("run")).select(
            "run_key", "run.job", "run.asset", "run.event_id", "run.ts",
            F.pmod(F.xxhash64("run_key"), F.lit(prefixes)).cast("int").alias("prefix")).persist()
        # no more of them than there are prefixes
        here = [r["prefix"] for r in once.select("prefix").distinct().collect()]
        if here:
            ledger = run_ledger(spark, path).filter(F.col("prefix").isin(here) & (F.col("part") != part))
            new = once.join(ledger.select("prefix", "run_key"), ["prefix", "run_key"], "left_anti")
            write_partition(new.withColumn("part", F.lit(part)), path, "prefix", "part", rebalance=True)
        once.unpersist()

    _run_batches(events, checkpoint_dir, take)


def run_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The runs started, with the partitions they are kept in."""
    return _read(spark, path, _RUNS)


# ---- landing

def with_hour(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.withColumns({"date": F.date_format(ts, "yyyy-MM-dd"), "hour": F.hour(ts)})


def ingest_stream(src: DataFrame, path: str, checkpoint_dir: str, ts: str = "ts") -> None:
    """Land arrived events as Parquet, one folder per date and batch; ``compact_hours`` makes the hours.

    The rows of a date are brought together first, and Spark splits a large one. A batch that
    runs again replaces its own folders.
    """
    _run_batches(with_hour(src, ts), checkpoint_dir, lambda batch, part: write_partition(
        batch.withColumn("part", F.lit(part)), f"{path}/arrived", "date", "part", rebalance=True))


def _landed(spark: SparkSession, path: str, schema) -> tuple[DataFrame, DataFrame]:
    """Arrived rows that no closed hour holds, and the newest generation of each closed hour."""
    events = spark.createDataFrame([], schema).schema.fields

    def rows(name: str, *parts: tuple[str, T.DataType]) -> DataFrame:
        fields = T.StructType([*events, *[T.StructField(c, kind) for c, kind in parts]])
        where = f"{path}/{name}"
        return spark.read.schema(fields).parquet(where) if exists(spark, where) else spark.createDataFrame([], fields)

    part, gen = ("part", T.StringType()), ("gen", T.IntegerType())
    hour = ("date", T.StringType()), ("hour", T.IntegerType())
    closed = rows("closed", part, *hour, gen)
    newest = closed.groupBy("date", "hour").agg(F.max("gen").alias("gen"))
    closed = closed.join(newest, ["date", "hour", "gen"])
    arrived = rows("arrived", *hour, part)
    return arrived.join(closed.select("date", "hour", "part").distinct(), ["date", "hour", "part"], "left_anti"), closed


def landed(spark: SparkSession, path: str, schema) -> DataFrame:
    """Each event that has landed, once; ``schema`` is that of the events."""
    arrived, closed = _landed(spark, path, schema)
    return arrived.unionByName(closed.drop("gen")).drop("part")


def compact_hours(spark: SparkSession, path: str, schema, before: datetime) -> None:
    """Bring the batches of every hour over by ``before`` (UTC) together into few files.

    A new generation of an hour is written beside the one before and keeps the name of the
    batch of each row. Readers leave out arrived rows of batches that the closed hour holds, so
    at any moment each event is seen once. Arrived folders all of whose hours are held, and
    generations before the newest, are deleted last.
    """
    arrived, closed = _landed(spark, path, schema)
    over = F.to_timestamp_ntz(F.concat_ws(" ", "date", F.lpad(F.col("hour").cast("string"), 2, "0")), F.lit("yyyy-MM-dd HH"))
    hours = arrived.select("date", "hour").distinct().filter(
        over + F.expr("INTERVAL 1 HOUR") <= F.lit(before.isoformat(" ")).cast("timestamp_ntz"))
    gens = closed.groupBy("date", "hour").agg(F.max("gen").alias("_gen"))
    rows = arrived.unionByName(closed.drop("gen")).join(hours, ["date", "hour"], "left_semi").join(gens, ["date", "hour"], "left")
    rows = rows.withColumn("gen", F.coalesce("_gen", F.lit(0)) + 1).drop("_gen")
    write_partition(rows, f"{path}/closed", "date", "hour", "gen", rebalance=True)
    if not exists(spark, f"{path}/closed"):
        return
    _, closed = _landed(spark, path, schema)
    kept = closed.select("date", "hour", "gen", "part").distinct()
    old = stored_partitions(spark, f"{path}/closed", "date string, hour int, gen int").join(
        kept.groupBy("date", "hour").agg(F.max("gen").alias("newest")), ["date", "hour"]).filter("gen < newest")
    there = stored_partitions(spark, f"{path}/arrived", "hour int, date string, part string").distinct()
    there = there.join(kept.select("date", "hour", "part", F.lit(True).alias("held")), ["date", "hour", "part"], "left")
    done = there.groupBy("_folder").agg(F.every(F.coalesce("held", F.lit(False))).alias("all")).filter("all")
    remove(spark, *folders_of(done), *folders_of(old))


# ---- alerts

def alert_totals(path: str, delay: timedelta = DELAY, width: timedelta = timedelta(days=1), bucket: str = "month") -> WindowTotals:
    """Records and sum of the values per window, below a folder."""
    value = F.col("value")
    return WindowTotals(f"{path}/totals", {"records": ("bigint", F.lit(1)), "sum": ("double", value),
                                           "values": ("bigint", value.isNotNull().cast("bigint"))},
                        delay=delay, width=width, bucket=bucket)


def alert_stream(events: DataFrame, path: str, checkpoint_dir: str, name: str, delay: timedelta = DELAY,
                 width: timedelta = timedelta(days=1), bucket: str = "month") -> WindowTotals:
    """Write an alert row for every window that closes, to ``path/alerts``.

    The totals are those of all streams that share ``path``. A late event changes its window,
    whose alert is then written again, once all that has arrived is added.
    """
    totals = alert_totals(path, delay, width, bucket)

    def emit(rows: DataFrame, due: Column) -> None:
        found = rows.withColumns({"average": printed_round(F.try_divide("sum", "values"), 2), "stream": F.lit(name)})
        replace_buckets(found.select("window_start", "records", "sum", "average", "stream", "bucket"),
                        due & (F.col("stream") == name), f"{path}/alerts", "stream", "bucket")

    totals.run(events, checkpoint_dir, emit)
    return totals


def alerts(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, f"{path}/alerts", "window_start timestamp, records bigint, sum double, average double, "
                 "stream string, bucket string").drop("bucket")
