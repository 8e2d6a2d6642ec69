"""Session settings and the shared folder used for checkpoints and written tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR = "spark.millrace.ownSharedDir"
PARTITION_BYTES = 128 * 1024 * 1024


def build_session(app_name: str = "millrace", master: str | None = None,
                  conf: dict[str, str] | None = None,
                  largest_shuffle_bytes: int | None = None) -> SparkSession:
    """A session with the settings the operators rely on.

    The time zone is UTC so that calendar arithmetic does not depend on the
    machine. AQE merges small shuffle partitions and splits skewed ones of a
    join, but never adds any: for large data say how many bytes the largest
    shuffle moves, and it starts with that many partitions of 128 MB. Arrow
    batches are bounded in bytes because pages and documents differ in size, and
    streaming state is kept off the heap. Checkpoint files go when their frame does.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxBytesPerBatch": "64MB",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
    }
    if largest_shuffle_bytes:
        settings["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(
            max(200, -(-largest_shuffle_bytes // PARTITION_BYTES)))
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _base_dir(spark: SparkSession) -> str:
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    own = spark.conf.get(_OWN_DIR, None)
    if own:
        return own
    context = spark.sparkContext
    set_by_user = context.getCheckpointDir()
    if set_by_user:
        return set_by_user
    if not context.master.startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder every executor can reach")
    own = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set(_OWN_DIR, own)
    return own


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared folder of the cluster.

    The base is ``spark.checkpoint.dir``. Only a local session that names none
    gets a temporary folder.
    """
    return f"{_base_dir(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder, in whatever store the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove(spark: SparkSession, *paths: str) -> None:
    """Delete files or folders with all they hold; what is not there is no error."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def stored_partitions(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A row for each row of a partitioned table: its partition columns, and its folder as ``_folder``."""
    rows = spark.read.schema(schema).parquet(path)
    return rows.withColumn("_folder", F.regexp_replace("_metadata.file_path", "/[^/]*$", ""))


def folders_of(rows: DataFrame) -> list[str]:
    """The distinct folders of rows of ``stored_partitions``; only they come to the driver."""
    jvm = rows.sparkSession._jvm
    # file paths are given as URIs, with characters escaped
    return [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r["_folder"])).toString()
            for r in rows.select("_folder").distinct().collect()]


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint, which survives lost executors."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(_base_dir(spark))
    return df.checkpoint(eager=True)
