"""Words, ids and column names shared by the operators on texts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import shared_dir

# The characters between words, and the words they leave.
GAPS = " \t\n\x0b\x0c\r"
GAP_PATTERN = r"[\x20\x09-\x0D]+"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = 1000
_BATCH_SIZE = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text in order; none for a null or blank one."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAPS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, GAP_PATTERN, -1))


def free_name(taken: DataFrame | Iterable[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has that name."""
    names = {c.lower() for c in (taken.columns if isinstance(taken, DataFrame) else taken)}
    while wanted.lower() in names:
        wanted += "_"
    return wanted


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def worker_memo(key: tuple, make):
    """One object in a Python worker, kept from task to task: a vocabulary, a bounded memo.

    Workers live on from stage to stage, so the object of another key takes the place of the
    last one. A function asks for one key only.
    """
    import sys
    import types

    kept = sys.modules.setdefault("_millrace_worker_memo", types.ModuleType("_millrace_worker_memo")).__dict__
    if kept.get("key") != key:
        kept.pop("made", None)
        kept["made"], kept["key"] = make(), key
    return kept["made"]


def staged(df: DataFrame, purpose: str) -> DataFrame:
    """Written to the shared folder and read again: computed once, safe from lost executors.

    Meanwhile Python workers get batches of BATCH_ROWS rows at most: texts are long.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, purpose)
    rows = spark.conf.get(_BATCH_SIZE)
    spark.conf.set(_BATCH_SIZE, str(min(int(rows), BATCH_ROWS) if int(rows) > 0 else BATCH_ROWS))
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_BATCH_SIZE, rows)
    return spark.read.schema(df.schema).parquet(path)


def dealt(stored: DataFrame, key: str) -> DataFrame:
    """In partitions of some BATCH_ROWS rows, for a Python function whose frame is not staged.

    Spark sends 10,000 rows of a partition at once, and both sides hold them. The rows are
    counted, so the frame should be one just read.
    """
    return stored.repartition(max(1, -(-stored.count() // BATCH_ROWS)), F.col(f"`{key}`"))
