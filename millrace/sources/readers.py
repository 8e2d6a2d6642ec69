"""Reading enveloped JSON, paged results, database tables and file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The columns kept of a paged article listing. "user.username" is
# a nested field whose output column keeps the dotted name.
ARTICLE_COLUMNS = ("id", "title", "published_at", "url", "comments_count",
                   "positive_reactions_count", "tag_list", "user.username")


def read_records(spark: SparkSession, path: str, record_schema: str,
                 multi_line: bool = True) -> DataFrame:
    """One row per record of ``{extracted_at, records: [...]}`` documents.

    A pretty-printed document is read by one task, so scale comes from many
    files; pass ``multi_line=False`` for JSON lines, which can be split.
    """
    documents = (spark.read
                 .schema(f"extracted_at string, records array<struct<{record_schema}>>")
                 .option("multiLine", multi_line)
                 .json(path))
    return documents.select("extracted_at", F.inline("records"))


def read_variant_records(spark: SparkSession, path: str, records: str = "records", multi_line: bool = True) -> DataFrame:
    """(envelope, pos, record) of JSON documents whose fields are not known beforehand.

    ``envelope`` is the whole document and ``record`` one element of its array, both as
    VARIANT: records may differ in their fields, and a field that is null is told from one
    that is not there. A document that is not JSON gives a row without envelope and record,
    one without the array a row without record. A pretty-printed document is one file and is
    read by one task; pass ``multi_line=False`` for JSON lines, which can be split.
    """
    texts = spark.read.text(path, wholetext=multi_line)
    documents = texts.filter(F.trim("value") != "").select(F.try_parse_json("value").alias("envelope"))
    listed = documents.withColumn("_list", F.try_variant_get("envelope", f"$.{records}", "array<variant>"))
    return listed.select("envelope", F.posexplode_outer("_list").alias("pos", "record"))


def variant_fields(record: Column, fields: dict[str, str]) -> list[Column]:
    """Fields of a VARIANT as columns of given types; null where missing, null or of another type."""
    return [F.try_variant_get(record, f"$.{name}", kind).alias(name) for name, kind in fields.items()]


def flatten_pages(df: DataFrame, columns: tuple[str, ...] = ARTICLE_COLUMNS,
                  pages: str = "articles") -> DataFrame:
    """Pages of nested articles as one row per article with the named columns."""
    articles = df.select(F.explode(pages).alias("article"))
    return articles.select(*[F.col(f"article.{name}").alias(name) for name in columns])


def read_table(spark: SparkSession, table: str, limit: int | None = None,
               order: list[Column | str] | None = None,
               jdbc: dict[str, str] | None = None) -> DataFrame:
    """Rows of a catalog table, or of a database table when ``jdbc`` is given.

    ``jdbc`` holds the reader's options (url, driver, user, ..., and for a
    parallel read partitionColumn, lowerBound, upperBound, numPartitions).
    Filters, columns and the limit are pushed to the database.
    """
    if jdbc:
        rows = (spark.read.format("jdbc")
                .options(pushDownLimit="true", **jdbc)
                .option("dbtable", table).load())
    else:
        rows = spark.table(table)
    if order:
        rows = rows.orderBy(*order)
    return rows.limit(limit) if limit is not None else rows


def with_source_file(df: DataFrame, column: str = "source_file") -> DataFrame:
    """Add the path of the file each row was read from."""
    return df.withColumn(column, F.col("_metadata.file_path"))
