"""A corpus from raw documents: filtered, without near copies and repeats, mixed, encoded."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard_join, mixing, quality, suffix_dedup
from millrace.llm.common import dealt, staged, table
from millrace.llm.queries import bpe_digests


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a rule rejects go."""
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked at 0.8 or more, directly or through others, the smallest id stays."""
    return jaccard_join.keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Bytes within strings of 100 that start earlier go; the documents stay, n_chars as it was."""
    return suffix_dedup.with_kept_text(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target takes it, not at all in some cases."""
    return mixing.mixed(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of tokens and digests of ids and decoded text, a row for each copy in the mix.

    Ids are written between, so a task runs one Python worker: what a second one holds stays
    with the executor through later stages. They are decoded few rows at a time.
    """
    return bpe_digests(docs.select("doc_id", "text"), lambda ids: dealt(staged(ids, "pipeline-ids"), "doc_id"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("repeated_passages", repeated_passages),
    ("source_mix", source_mix),
    ("encoded", encoded),
]

# Links between documents and the token ids are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
