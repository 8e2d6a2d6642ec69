"""Materializing a named table in versions, together with its log rows.

Every run writes a folder of its own. Then one file with all log rows of the run is
written, which is what publishes the version: readers take the newest version that has one.
So a run that ends anywhere before leaves the last version as it is.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import asset_key
from millrace.operators.quality import NOT_EVALUATED
from millrace.session import exists, folders_of, remove, stored_partitions

PREVIEW_ROWS = 10
_ENTRY = ("kind string, uri string, ord int, name string, value string, passed boolean, status string, "
          "error string, run_at timestamp, row_count bigint, seq bigint, version string")
# What a reader sees of each kind of row.
_LOGS = {
    "materializations": ["uri", "run_at", "row_count", "passed", "version", "value AS path"],
    "edges": ["uri AS consumer", "name AS dep", "ord"],
    "metadata": ["uri", "name AS key", "value", "seq"],
    "columns": ["uri", "ord", "name AS column", "value AS type"],
    "checks": ["uri", "ord", "name AS check", "passed", "status", "error"],
    "previews": ["uri", "ord", "value AS row"],
}


def _generations(spark: SparkSession, log_dir: str) -> tuple[int, list[int]]:
    """Number of the newest whole generation of compacted logs, 0 if there is none, and all numbers."""
    where = f"{log_dir}/compacted"
    if not exists(spark, where):
        return 0, []
    numbers = sorted(r["gen"] for r in stored_partitions(spark, where, "gen int").select("gen").distinct().collect())
    # the marker is what Spark writes last
    whole = [n for n in numbers if exists(spark, f"{where}/gen={n}/_SUCCESS")]
    return max(whole, default=0), numbers


def _entries(spark: SparkSession, log_dir: str) -> DataFrame:
    """All log rows: the newest whole generation, and entries that it does not hold."""
    def read(path: str) -> DataFrame:
        return spark.read.schema(_ENTRY).parquet(path) if exists(spark, path) else spark.createDataFrame([], _ENTRY)

    new, (gen, _) = read(f"{log_dir}/entries"), _generations(spark, log_dir)
    if not gen:
        return new
    old = read(f"{log_dir}/compacted/gen={gen}")
    return old.unionByName(new.join(old.select("version").distinct(), "version", "left_anti").select(*old.columns))


def read_log(spark: SparkSession, log: str, log_dir: str) -> DataFrame:
    """The rows of one kind of log, of every published version."""
    rows = _entries(spark, log_dir).filter(F.col("kind") == log).selectExpr(*_LOGS[log])
    return rows.withColumn("key", asset_key(F.col("uri"))) if log == "materializations" else rows


def read_asset(spark: SparkSession, uri: str, log_dir: str, passed_only: bool = False) -> DataFrame:
    """The newest published version of an asset, or the newest whose checks all passed."""
    runs = read_log(spark, "materializations", log_dir).filter(F.col("uri") == uri)
    newest = (runs.filter("passed") if passed_only else runs).orderBy(F.desc("run_at"), F.desc("version")).first()
    if newest is None:
        raise LookupError(f"{uri} has no published version")
    return spark.read.parquet(newest["path"])


def materialize(df: DataFrame, uri: str, path: str, log_dir: str, run_at: datetime,
                deps: list[str] | None = None,
                checks: list[tuple[str, Column, str]] | None = None,
                metadata: dict[str, str] | None = None,
                preview_order: list[Column | str] | None = None) -> bool:
    """Publish ``df`` as a new version of an asset, with profile, metadata, checks and preview.

    Row count and checks are observed on top of the plan that is written, so one job does
    everything and a retried task is not counted twice. ``checks`` are ordered ``(name,
    predicate, message)``: the first that fails is reported with its message, later ones as
    not evaluated. The version is published either way and says whether all checks passed;
    the result does too. The preview are the first rows as JSON, in an order if one is given.
    Metadata given by the caller wins over what is captured here. All log rows are one file,
    written last.
    """
    spark, checks = df.sparkSession, checks or []
    seq = int(run_at.timestamp() * 1_000_000)
    version = f"{seq:020d}-{uuid.uuid4().hex[:12]}"
    folder, seen = f"{path}/{version}", Observation()
    holds = [F.coalesce(F.every(F.coalesce(pred, F.lit(False))), F.lit(True)).alias(f"check_{i}")
             for i, (_, pred, _) in enumerate(checks)]
    df.observe(seen, F.count(F.lit(1)).alias("row_count"), *holds).write.parquet(folder)
    observed = seen.get

    def row(kind: str, ord: int | None = None, name: str | None = None, value: str | None = None, passed: bool | None = None,
            status: str | None = None, error: str | None = None, **more) -> tuple:
        return (kind, uri, ord, name, value, passed, status, error, more.get("run_at"), more.get("row_count"), more.get("seq"), version)

    rows, failed = [], False
    for i, (name, _, message) in enumerate(checks):
        if failed:
            rows.append(row("checks", i, name, passed=False, status=NOT_EVALUATED))
            continue
        failed = not observed[f"check_{i}"]
        rows.append(row("checks", i, name, passed=not failed, error=message if failed else None))
    rows += [row("columns", i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    rows += [row("edges", i, dep) for i, dep in enumerate(dict.fromkeys(deps or []))]
    rows += [row("metadata", None, k, v, seq=seq)
             for k, v in {"row_count": str(observed["row_count"]), **(metadata or {})}.items()]
    rows.append(row("materializations", None, None, folder, not failed, run_at=run_at, row_count=observed["row_count"]))
    stored = spark.read.schema(df.schema).parquet(folder)
    first = (stored.orderBy(*preview_order) if preview_order else stored).limit(PREVIEW_ROWS)
    shown = first.select(F.to_json(F.struct(*[F.col(f"`{c}`") for c in stored.columns])).alias("row")).collect()
    rows += [row("previews", i, None, r["row"]) for i, r in enumerate(shown)]
    _publish(spark, rows, f"{log_dir}/entries/version={version}")
    return not failed


def _publish(spark: SparkSession, rows: list[tuple], entry: str) -> None:
    spark.createDataFrame(rows, _ENTRY).drop("version").coalesce(1).write.parquet(entry)


def compact_logs(spark: SparkSession, log_dir: str) -> None:
    """Bring all entries together into few files of a new generation.

    Readers go on with the generation before until the new one is whole, and leave out
    entries that it holds; those, and older generations, are deleted last.
    """
    gen, numbers = _generations(spark, log_dir)
    number = max(numbers, default=0) + 1
    if not exists(spark, f"{log_dir}/entries"):
        return
    rows = _entries(spark, log_dir)
    rows.hint("rebalance").write.parquet(f"{log_dir}/compacted/gen={number}")
    held = spark.read.schema(_ENTRY).parquet(f"{log_dir}/compacted/gen={number}").select("version").distinct()
    done = stored_partitions(spark, f"{log_dir}/entries", "version string").join(held, "version", "left_semi")
    remove(spark, *folders_of(done), *[f"{log_dir}/compacted/gen={n}" for n in numbers])


def drop_versions(spark: SparkSession, uri: str, log_dir: str, keep: int = 2) -> int:
    """Delete the data of all but the newest versions of an asset; its logs stay. How many were deleted."""
    if keep < 1:
        raise ValueError("at least the newest version is kept")
    runs = read_log(spark, "materializations", log_dir).filter(F.col("uri") == uri)
    old = [r["path"] for r in runs.orderBy(F.desc("run_at"), F.desc("version")).offset(keep).select("path").collect()]
    gone = [p for p in old if exists(spark, p)]
    remove(spark, *gone)
    return len(gone)
