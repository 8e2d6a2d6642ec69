"""The queries on the test tables next to their SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import bpe
from millrace.llm.queries import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, data, name):
    con = duckdb.connect()
    for table in ("documents", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{data}/{table}.parquet')")
    want = con.execute(SQL[name])
    columns = [d[0] for d in want.description]
    got = QUERIES[name](spark, data)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_a_task_of_the_pipeline_encodes_or_decodes(spark, plan_of):
    """Each Python function of a stage has a worker of its own."""
    import corpus_pipeline

    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    encoded = corpus_pipeline.encoded(spark, docs, "")
    assert plan_of(encoded).count("MapInArrow") == 1 and encoded.count() == 2


def test_ids_are_decoded_few_rows_at_a_time(spark, monkeypatch):
    """The pipeline's result is not staged, so Spark would send 10,000 rows of a partition at once."""
    import corpus_pipeline
    from millrace.llm import common

    monkeypatch.setattr(common, "BATCH_ROWS", 20)
    docs = spark.range(400).selectExpr("id AS doc_id", "concat('some words ', id) AS text").coalesce(1)
    parts = corpus_pipeline.encoded(spark, docs, "").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 400 and max(r["count"] for r in parts) <= 50


def test_rules_of_a_file_are_held_without_its_vocabulary(monkeypatch):
    from tokenizers import Tokenizer

    sizes, parse = [], Tokenizer.from_str

    class Watched:
        from_file = None

        @staticmethod
        def from_str(text):
            sizes.append(len(text))
            return parse(text)

    monkeypatch.setattr("tokenizers.Tokenizer", Watched)
    path = "/opt/tokenizers/word_bpe_49k.json"
    own = bpe.Bpe(path)
    library = Tokenizer.from_file(path)
    for text in ("Don't stop", "Ångström's 12x!?", "a <|endoftext|> b", "été 你好"):
        assert bpe.unpack(own.text(text)).tolist() == library.encode(text, add_special_tokens=False).ids
    assert sizes and max(sizes) < 10_000
