"""Totals per window that any number of streams add to, and that no row is too late for.

A batch is summed up per window and key, and these partial sums are stored beside those of
earlier batches as a segment; nothing stored is written again for them. Windows lie in buckets of an
hour, a day, a month or a year. When a stream has MERGED segments of one level in a bucket, its next
batch there adds them up to one of the next level, so a row moves once for each level. The log row of
a batch names the segments made with it, and only those count: a batch that runs twice replaces its
own, and a driver lost while it writes leaves what was there.
"""

from __future__ import annotations

import uuid
from concurrent.futures import Future
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.periods import floor_to, utc_clock
from millrace.session import exists, folders_of, remove, stored_partitions
from millrace.sources.writers import write_partition

# Fixed value: segments of one level, of a stream and bucket, that are added up.
MERGED = 16
_SEGMENTS = "array<struct<bucket:string,first:bigint,batch:bigint,level:int>>"
_LOG = f"rows bigint, late bigint, last bigint, closed bigint, segments {_SEGMENTS}, source string, batch bigint"
_JUDGED = "upto bigint, source string"
_SEGMENT = ("bucket", "source", "first", "batch")
_MICRO = timedelta(microseconds=1)


@dataclass(frozen=True)
class WindowTotals:
    """What is summed up, and where it is kept.

    ``sums`` are types and columns of a row, whose sums over rows can be added up; a count is
    the sum of 1. ``keys`` are types of the columns that windows are told apart by further. A
    window is closed when an event ``delay`` after its end has come; what comes later
    changes it all the same. Rows without a time are in no window. ``bucket`` is what is
    stored, judged and replaced together; it should hold about as many windows as a batch has.
    """
    path: str
    sums: dict[str, tuple[str, Column]]
    keys: dict[str, str] = field(default_factory=dict)
    ts: str = "ts"
    width: timedelta = timedelta(hours=1)
    delay: timedelta = timedelta(minutes=10)
    bucket: str = "day"

    @property
    def schema(self) -> str:
        fields = {"window_start": "timestamp", "window_end": "timestamp", **self.keys,
                  **{s: kind for s, (kind, _) in self.sums.items()}, "_rows": "bigint", "_last": "bigint",
                  "bucket": "string", "source": "string", "first": "bigint", "batch": "bigint"}
        return ", ".join(f"`{name}` {kind}" for name, kind in fields.items())

    def _bucket(self, start: Column) -> Column:
        return F.regexp_replace(floor_to(utc_clock(start), self.bucket).cast("string"), "[ :]", "-")

    def _bucket_at(self, micros: int) -> str:
        at = datetime(1970, 1, 1, tzinfo=timezone.utc) + micros * _MICRO
        at = at.replace(minute=0, second=0, microsecond=0)
        at = at if self.bucket == "hour" else at.replace(hour=0)
        at = at.replace(day=1) if self.bucket in ("month", "year") else at
        return (at.replace(month=1) if self.bucket == "year" else at).strftime("%Y-%m-%d-%H-%M-%S")

    def _added(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("bucket", "window_start", "window_end", *self.keys).agg(*[F.sum(s).alias(s) for s in self.sums])

    def _stored(self, spark: SparkSession) -> DataFrame:
        where = f"{self.path}/windows"
        return spark.read.schema(self.schema).parquet(where) if exists(spark, where) else spark.createDataFrame([], self.schema)

    def _store(self, rows: DataFrame) -> None:
        write_partition(rows, f"{self.path}/windows", *_SEGMENT, rebalance=True)

    def add(self, batch: DataFrame, batch_id: int, source: str) -> Column | None:
        """Add a batch; which buckets hold windows that it touched or closed, none if it has no row with a time.

        ``source`` names the stream: one that starts anew needs a new name. The batch is
        read once; what is logged of it comes from the partial sums it left.
        """
        spark = batch.sparkSession
        closed = self.closed_until(spark, source, batch_id)
        window = F.window(self.ts, f"{self.width // _MICRO} microseconds")
        # one row for each window and key in a task, before the shuffle
        self._store(batch.filter(F.col(self.ts).isNotNull()).withColumn("_window", window).groupBy(
            F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"), *self.keys).agg(
            *[F.sum(c).cast(kind).alias(s) for s, (kind, c) in self.sums.items()],
            F.count(F.lit(1)).alias("_rows"), F.max(F.unix_micros(self.ts)).alias("_last")).withColumns({
                "bucket": self._bucket(F.col("window_start")), "source": F.lit(source),
                "first": F.lit(batch_id).cast("bigint"), "batch": F.lit(batch_id).cast("bigint")}))
        late = F.when(F.unix_micros("window_end") <= F.lit(closed), F.col("_rows"))
        # no more of them than there are buckets between the first event and the last
        touched = {r["bucket"]: r for r in self._stored(spark).filter(
            (F.col("source") == source) & (F.col("first") == batch_id) & (F.col("batch") == batch_id)).groupBy("bucket").agg(
            F.sum("_rows").alias("rows"), F.coalesce(F.sum(late), F.lit(0)).alias("late"), F.max("_last").alias("last")).collect()}
        if not touched:
            return None
        segments = [(b, batch_id, batch_id, 0) for b in touched] + self._merge(spark, batch_id, source, list(touched))
        last = max(r["last"] for r in touched.values())
        log = [(sum(r["rows"] for r in touched.values()), sum(r["late"] for r in touched.values()), last, closed,
                segments, source, batch_id)]
        write_partition(spark.createDataFrame(log, _LOG).coalesce(1), f"{self.path}/log", "source", "batch")
        return self._due(list(touched), closed, last)

    def _due(self, touched: list[str], closed: int | None, last: int) -> Column:
        """Buckets touched, and those with windows that closed since ``closed``."""
        due, now = F.col("bucket").isin(touched), last - self.delay // _MICRO
        if closed is None or now > closed:
            width = self.width // _MICRO
            just = F.col("bucket") <= self._bucket_at(now - width)
            due |= just if closed is None else just & (F.col("bucket") >= self._bucket_at(closed - width))
        return due

    def _segments(self, log: DataFrame) -> DataFrame:
        """(source, bucket, first, batch, level, live): the segments that are logged, and whether no other one holds theirs."""
        all_ = log.select("source", F.explode("segments").alias("of")).select("source", "of.*")
        over = all_.select("source", "bucket", F.col("first").alias("from"), F.col("batch").alias("to"), F.col("level").alias("above"))
        held = all_.join(over, ["source", "bucket"]).filter(
            "above > level AND from <= first AND batch <= to").select("source", "bucket", "first", "batch").distinct()
        return all_.join(held.withColumn("live", F.lit(False)), ["source", "bucket", "first", "batch"], "left").withColumn(
            "live", F.coalesce("live", F.lit(True)))

    def _merge(self, spark: SparkSession, batch_id: int, source: str, touched: list[str]) -> list[tuple[str, int, int, int]]:
        """Add up the segments of earlier batches in the buckets touched, where there are enough of a level.

        What segments merged by an earlier batch hold is deleted first: their log rows stand.
        """
        groups, gone = {}, []
        # as if this batch had not run before
        before = self.log(spark).filter((F.col("source") == source) & (F.col("batch") < batch_id))
        for r in self._segments(before).filter(F.col("bucket").isin(touched)).collect():
            if r["live"]:
                groups.setdefault((r["bucket"], r["level"]), []).append((r["first"], r["batch"]))
            else:
                gone.append(f"{r['bucket']}/{r['first']}/{r['batch']}")
        parts = [(bucket, first, batch, min(own)[0], max(own)[1], level + 1) for (bucket, level), own in groups.items()
                 if len(own) >= MERGED for first, batch in own]
        if not parts:
            return []
        name = F.concat_ws("/", "bucket", "first", "batch")
        if gone:
            there = stored_partitions(spark, f"{self.path}/windows", "bucket string, source string, first bigint, batch bigint")
            remove(spark, *folders_of(there.filter((F.col("source") == source) & name.isin(gone))))
        into = F.broadcast(spark.createDataFrame([p[:5] for p in parts], "bucket string, first bigint, batch bigint, from bigint, to bigint"))
        rows = self._stored(spark).filter((F.col("source") == source) & name.isin([f"{p[0]}/{p[1]}/{p[2]}" for p in parts]))
        kinds = {s: kind for s, (kind, _) in self.sums.items()}
        self._store(rows.join(into, ["bucket", "first", "batch"]).groupBy(
            "window_start", "window_end", *self.keys, "bucket", "source", F.col("from").alias("first"), F.col("to").alias("batch")).agg(
            *[F.sum(s).cast(kind).alias(s) for s, kind in kinds.items()], F.sum("_rows").alias("_rows"), F.max("_last").alias("_last")))
        return sorted({(bucket, first, batch, level) for bucket, _, _, first, batch, level in parts})

    def run(self, rows: DataFrame, checkpoint_dir: str, emit=None) -> None:
        """Add what has arrived on a stream and stop.

        ``emit(totals, due)`` gets the closed windows of the buckets that are due after all
        batches, with their totals over all streams, and the condition on ``bucket`` for these.
        How far a stream was judged is kept: what a lost run did not come to is due in the
        next one. The stream is named by the id in its checkpoint.
        """
        source: Future[str] = Future()

        def take(batch: DataFrame, batch_id: int) -> None:
            self.add(batch, batch_id, source.result())

        query = (rows.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint_dir)
                 .trigger(availableNow=True).start())
        source.set_result(str(query.id))
        query.awaitTermination()
        if emit:
            self._judge(rows.sparkSession, source.result(), emit)

    def _judge(self, spark: SparkSession, source: str, emit) -> None:
        where, own = f"{self.path}/judged", F.col("source") == source
        upto = spark.read.schema(_JUDGED).parquet(where).filter(own).agg(F.max("upto")).first()[0] if exists(spark, where) else None
        # a row for each batch of this run
        new = self.log(spark).filter(own & (F.col("batch") > F.lit(-1 if upto is None else upto))).select(
            "batch", "closed", "last", F.transform("segments", lambda s: F.when(s["level"] == 0, s["bucket"])).alias("buckets")).collect()
        if not new:
            return
        touched = {b for r in new for b in r["buckets"] if b is not None}
        closed = None if any(r["closed"] is None for r in new) else min(r["closed"] for r in new)
        due = self._due(sorted(touched), closed, max(r["last"] for r in new))
        emit(self.closed(spark, due), due)
        judged = spark.createDataFrame([(max(r["batch"] for r in new), source)], _JUDGED)
        write_partition(judged.coalesce(1), where, "source")

    def log(self, spark: SparkSession) -> DataFrame:
        """(rows, late, last, closed, segments, source, batch): rows of each batch, how many of them came after
        their window was closed, the last time among them and what was closed before, in microseconds, and the segments made."""
        where = f"{self.path}/log"
        return spark.read.schema(_LOG).parquet(where) if exists(spark, where) else spark.createDataFrame([], _LOG)

    def closed_until(self, spark: SparkSession, source: str | None = None, before: int | None = None) -> int | None:
        """Windows that end by then are closed, in microseconds; with ``before`` as it was when that
        batch of a stream began."""
        log = self.log(spark)
        if before is not None:
            log = log.filter((F.col("source") != source) | (F.col("batch") < before))
        last = log.agg(F.max("last")).first()[0]
        return None if last is None else last - self.delay // _MICRO

    def totals(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """(bucket, window_start, window_end, keys, sums) over all streams, of some buckets or all."""
        rows = self._stored(spark)
        if where is not None:
            rows = rows.filter(where)
        live = self._segments(self.log(spark)).filter("live").select(*_SEGMENT).distinct()
        return self._added(rows.join(F.broadcast(live), list(_SEGMENT)))

    def closed(self, spark: SparkSession, where: Column | None = None) -> DataFrame:
        """Totals of the windows that are closed by now."""
        return self.totals(spark, where).filter(F.unix_micros("window_end") <= F.lit(self.closed_until(spark)))


def replace_buckets(rows: DataFrame, due: Column, path: str, *columns: str) -> None:
    """Make ``rows`` the content of the buckets that are due; ``bucket`` is one of the partition columns.

    Rows are marked with the write they come from. What an earlier write left in a bucket that is
    due now and got no rows is deleted; only such folders come to the driver.
    """
    spark, mark = rows.sparkSession, uuid.uuid4().hex
    write_partition(rows.withColumn("written", F.lit(mark)), path, *columns, rebalance=True)
    if exists(spark, path):
        kinds = {"written": "string", **{c: rows.schema[c].dataType.simpleString() for c in columns}}
        stored = stored_partitions(spark, path, ", ".join(f"`{c}` {kind}" for c, kind in kinds.items()))
        remove(spark, *folders_of(stored.filter(due & (F.col("written") != mark))))
