import json
from datetime import datetime, timezone
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from millrace import checkpoint, shared_dir
from millrace.sources import assets, readers, writers


def test_envelopes(spark, tmp_path, rows):
    for i, records in enumerate([[(1, 100), (2, 200)], [], [(3, None)]]):
        (tmp_path / f"{i}.json").write_text(json.dumps(
            {"extracted_at": f"t{i}", "records": [{"id": a, "value": b} for a, b in records]}, indent=2))
    got = readers.read_records(spark, str(tmp_path), "id bigint, value bigint")
    assert rows(got, "id") == [("t0", 1, 100), ("t0", 2, 200), ("t2", 3, None)]


def test_records_of_any_shape(spark, tmp_path, rows):
    from millrace.operators.quality import required_in_variant
    (tmp_path / "a.json").write_text('{\n "at": 1,\n "records": [{"id": 1, "x": null}, {"id": "two", "y": [1]},\n 7, null]}')
    (tmp_path / "b.json").write_text("no json")
    (tmp_path / "c.json").write_text('{"at": 2}')
    (tmp_path / "d.json").write_text("")
    records = readers.read_variant_records(spark, str(tmp_path))
    got = required_in_variant(records, "record", ["id", "x"]).select(
        *readers.variant_fields(F.col("envelope"), {"at": "int"}), "pos", *readers.variant_fields(F.col("record"), {"id": "int"}), "missing", "nulls")
    none = ["id", "x"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted([
        (1, 0, 1, [], ["x"]), (1, 1, None, ["x"], []), (1, 2, None, none, []), (1, 3, None, none, []),
        (None, None, None, none, []), (2, None, None, none, [])], key=repr)
    (tmp_path / "lines").write_text('{"records": [{"id": 1}]}\n{"records": [{"id": 2}, {"id": 3}]}\n')
    lines = readers.read_variant_records(spark, str(tmp_path / "lines"), multi_line=False)
    assert rows(lines.select(*readers.variant_fields(F.col("record"), {"id": "int"})), "id") == [(1,), (2,), (3,)]


def test_pages(spark):
    article = "struct<" + ", ".join([
        "id: bigint", "title: string", "published_at: string", "url: string", "comments_count: int",
        "positive_reactions_count: int", "tag_list: array<string>",
        "user: struct<username: string, name: string>", "body: string"]) + ">"
    one = (1, "T", "d", "u", 2, 3, ["x"], ("ann", "Ann"), "long")
    pages = spark.createDataFrame([([one, one],), ([one],), ([],)], f"articles array<{article}>")
    flat = readers.flatten_pages(pages)
    assert flat.columns == list(readers.ARTICLE_COLUMNS)
    assert flat.count() == 3 and flat.first()["user.username"] == "ann"


def test_table_limit(spark, rows):
    spark.range(50).createOrReplaceTempView("fifty")
    assert rows(readers.read_table(spark, "fifty", 3, [F.col("id").desc()])) == [(49,), (48,), (47,)]
    assert readers.read_table(spark, "fifty").count() == 50


def test_csv(spark, tmp_path, rows):
    df = spark.createDataFrame([(i, f'say "{i}", twice') for i in range(8)], "id int, said string")
    count, preview = writers.save_csv(df.coalesce(1), str(tmp_path / "out"))
    assert count == 8
    assert rows(preview, "id") == [(i, f'say "{i}", twice') for i in range(5)]


def test_formats(spark, tmp_path):
    df = spark.range(3)
    with pytest.raises(ValueError):
        writers.save_as(df, str(tmp_path / "x"), "parquet")
    for fmt in ("json", "csv", "xml"):
        writers.save_as(df, str(tmp_path / fmt), fmt)
        assert list((tmp_path / fmt).glob(f"*.{fmt}"))


def test_copy_into_appends_and_rejects_bad_lines(spark, tmp_path):
    stage, table = tmp_path / "stage", str(tmp_path / "table")
    stage.mkdir()
    (stage / "a.csv").write_text("1,x\n2,y\n")
    for _ in range(2):
        writers.copy_into(spark, str(stage), table, "id int, name string")
    assert spark.read.parquet(table).count() == 4
    (stage / "b.csv").write_text("three,z\n")
    with pytest.raises(Exception):
        writers.copy_into(spark, str(stage), table, "id int, name string")
    assert spark.read.parquet(table).count() == 4


def test_one_partition_is_replaced(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")], "v int, date string")
    writers.write_partition(df, path, "date")
    key = writers.run_partition(df, "date", path, now=datetime(2024, 1, 3, 5),
                                transform=lambda d: d.withColumn("v", F.col("v") * 10))
    assert key == "2024-01-02"
    stored = spark.read.schema("v int, date string").parquet(path)
    assert rows(stored, "v") == [(1, "2024-01-01"), (20, "2024-01-02"), (30, "2024-01-02")]
    with pytest.raises(ValueError):
        writers.run_partition(df, "date", path)
    # a rerun without rows leaves none of that key, and all of the others
    writers.run_partition(df, "date", path, "2024-01-02", transform=lambda d: d.filter("false"))
    assert rows(spark.read.schema("v int, date string").parquet(path), "v") == [(1, "2024-01-01")]


KEYS = [chr(c) for c in range(32, 127)] + ["é", "日本", "a b", " a", "a+b", "a%2Bb", "a/b", "x=y", "..", "__HIVE__", "NULL", "01"]


def test_any_key_is_replaced_exactly(spark, tmp_path):
    """Two rows for each key, and for none; reruns to one row, then to none."""
    path, schema = str(tmp_path / "t"), "v int, k string"
    df = spark.createDataFrame([(i, k) for k in [*KEYS, None] for i in range(2)], schema).coalesce(1)
    writers.write_partition(df, path, "k")
    for i, key in enumerate(["a+b", "%", "é", ",", "&", "'", '"', " ", "a/b", "1", writers.NULL_KEY]):
        assert writers.run_partition(df, "k", path, key, transform=lambda d: d.filter("v = 0")) is key
        stored = spark.read.schema(schema).parquet(path)
        own = F.col("k").isNull() if key is writers.NULL_KEY else F.col("k") == key
        assert stored.filter(own).count() == 1
        writers.run_partition(df, "k", path, key, transform=lambda d: d.filter("false"))
        stored = spark.read.schema(schema).parquet(path)
        assert stored.filter(own).isEmpty()
        assert stored.count() >= 2 * (len(KEYS) - i)
    with pytest.raises(ValueError):
        writers.run_partition(df, "k", path, "")


def test_every_character_names_one_folder(spark, tmp_path):
    """A rerun of each single character, alone in its folder: first one row, then none."""
    path, schema = str(tmp_path / "t"), "v int, k string"
    for key in KEYS:
        rows = spark.range(1).select(F.lit(7).alias("v"))
        writers.replace_partition(rows, path, "k", key)
    assert {r.k for r in spark.read.schema(schema).parquet(path).collect()} == set(KEYS)
    assert spark.read.schema(schema).parquet(path).count() == len(KEYS)
    for key in KEYS[::7]:
        writers.replace_partition(spark.range(0).select(F.lit(7).alias("v")), path, "k", key)
    assert {r.k for r in spark.read.schema(schema).parquet(path).collect()} == set(KEYS) - set(KEYS[::7])


def test_routes_and_keys(spark, tmp_path):
    df = spark.range(100)
    writers.write_routes(df, str(tmp_path / "r"), F.when(F.col("id") > 60, "large").otherwise("small"))
    assert spark.read.parquet(str(tmp_path / "r" / "route=large")).count() == 39
    writers.write_by_key(df, str(tmp_path / "k"), "id", 4)
    stored = spark.read.parquet(str(tmp_path / "k"))
    assert stored.count() == 100 and stored.select("bucket").distinct().count() == 4


def test_source_file(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "p"))
    files = readers.with_source_file(spark.read.parquet(str(tmp_path / "p")))
    assert files.filter(F.col("source_file").endswith(".parquet")).count() == 2


def test_materialize(spark, tmp_path, rows):
    logs, path = str(tmp_path / "logs"), str(tmp_path / "t")
    df = spark.createDataFrame([(1, 10), (2, -1)], "id int, amount int")
    at = datetime(2024, 1, 1, tzinfo=timezone.utc)
    passed = assets.materialize(
        df, "s3://lake/orders.parquet", path, logs, at, deps=["b", "a", "b"],
        checks=[("present", F.lit(True), "empty"), ("positive", F.col("amount") > 0, "must be positive"),
                ("later", F.lit(True), "")], metadata={"row_count": "many", "by": "me"}, preview_order=["id"])
    assert passed is False and assets.read_asset(spark, "s3://lake/orders.parquet", logs).count() == 2
    assert rows(assets.read_log(spark, "materializations", logs).select("row_count", "passed", "key")) == [
        (2, False, ["s3", "lake", "orders", "parquet"])]
    assert rows(assets.read_log(spark, "checks", logs).select("check", "passed", "status", "error", "ord"), "ord") == [
        ("present", True, None, None, 0), ("positive", False, None, "must be positive", 1),
        ("later", False, "not evaluated (prior assert failed)", None, 2)]
    assert rows(assets.read_log(spark, "edges", logs).select("dep", "ord"), "ord") == [("b", 0), ("a", 1)]
    assert rows(assets.read_log(spark, "metadata", logs).select("key", "value"), "key") == [
        ("by", "me"), ("row_count", "many")]
    assert [r.row for r in assets.read_log(spark, "previews", logs).orderBy("ord").collect()] == [
        '{"id":1,"amount":10}', '{"id":2,"amount":-1}']
    assert assets.materialize(df, "u", path, logs, at) is True
    assert assets.read_log(spark, "materializations", logs).count() == 2
    with pytest.raises(LookupError):
        assets.read_asset(spark, "s3://lake/orders.parquet", logs, passed_only=True)
    with pytest.raises(LookupError):
        assets.read_asset(spark, "v", logs)


@pytest.mark.parametrize("fails_at", ["checks", "write", "publish"])
def test_a_failed_run_leaves_the_last_version(spark, tmp_path, monkeypatch, fails_at):
    logs, path, at = str(tmp_path / "logs"), str(tmp_path / "t"), datetime(2024, 1, 1, tzinfo=timezone.utc)
    assets.materialize(spark.range(3), "u", path, logs, at)
    df, checks = spark.range(9), []
    if fails_at == "write":
        df = df.select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("bigint")).alias("id"))
    elif fails_at == "checks":
        checks = [("boom", F.raise_error(F.lit("lost")).cast("boolean"), "")]
    else:
        def fail(*a):
            raise OSError("lost")
        monkeypatch.setattr(assets, "_publish", fail)
    with pytest.raises(Exception, match="lost"):
        assets.materialize(df, "u", path, logs, at.replace(day=2), checks=checks)
    monkeypatch.undo()
    for _ in range(2):
        assert assets.read_asset(spark, "u", logs).count() == 3
        assert assets.read_log(spark, "materializations", logs).count() == 1
        assert assets.read_log(spark, "columns", logs).count() == 1
        assets.compact_logs(spark, logs)
    assets.materialize(spark.range(5), "u", path, logs, at.replace(day=3))
    assert assets.read_asset(spark, "u", logs).count() == 5


def test_compacted_logs_hold_each_row_once(spark, tmp_path, monkeypatch):
    logs, path, at = str(tmp_path / "logs"), str(tmp_path / "t"), datetime(2024, 1, 1, tzinfo=timezone.utc)
    assets.compact_logs(spark, logs)
    for day in range(1, 4):
        assets.materialize(spark.range(day), "u", path, logs, at.replace(day=day))
    counts = lambda: [assets.read_log(spark, log, logs).count() for log in assets._LOGS]
    before = counts()
    # lost before anything is deleted: entries and the generation hold the same rows
    monkeypatch.setattr(assets, "remove", lambda *a: None)
    assets.compact_logs(spark, logs)
    assert counts() == before == [3, 0, 3, 3, 0, 6]
    # lost while a generation is written: it has no marker
    assets.compact_logs(spark, logs)
    (tmp_path / "logs" / "compacted" / "gen=2" / "_SUCCESS").unlink()
    assert counts() == before
    monkeypatch.undo()
    assets.compact_logs(spark, logs)
    assert counts() == before and not list((tmp_path / "logs" / "entries").rglob("*.parquet"))
    assert len(list((tmp_path / "logs" / "compacted").iterdir())) <= 1 + 1
    assert assets.drop_versions(spark, "u", logs, keep=2) == 1 and assets.drop_versions(spark, "u", logs, keep=2) == 0
    assert assets.read_asset(spark, "u", logs).count() == 3


def test_shared_folder_is_the_one_the_session_names(spark):
    own = shared_dir(spark, "x")
    assert own != shared_dir(spark, "x")
    named = SimpleNamespace(conf=SimpleNamespace(
        get=lambda key, default: {"spark.checkpoint.dir": "/mnt/shared/"}.get(key, default)))
    assert shared_dir(named, "x").startswith("/mnt/shared/x-")
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: default),
        sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None))
    with pytest.raises(RuntimeError):
        shared_dir(cluster, "x")
    assert checkpoint(spark.range(5)).count() == 5
