import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from millrace.functions import numbers, periods, text


@pytest.mark.parametrize("uri, key", [
    ("gs://harbour/2023/tides.v2.orc", ["gs", "harbour", "2023", "tides", "v2", "orc"]),
    ("mysql://tower7/ledger/q1.entries", ["mysql", "tower7", "ledger", "q1", "entries"]),
    ("duck://MILL/Grain.Weights", ["duck", "MILL", "Grain", "Weights"]),
    ("grain-weights", ["grain_weights"]),
    ("two words.csv", ["two_words_csv"]),
    ("", ["unknown_asset"]),
    (None, ["unknown_asset"]),
    ("***", ["seg"]),
    ("S3://My-Bucket.eu//a b/__x__.y?version=3#top", ["S3".lower(), "My_Bucket_eu", "a_b", "x", "y"]),
    ("file:///tmp/data..json", ["file", "tmp", "data", "json"]),
    ("mailto:someone", ["mailto", "someone"]),
    ("https://api.example.com/v2/customers;v=1", ["https", "api_example_com", "v2", "customers"]),
    ("s3://b/k;v=1", ["s3", "b", "k_v_1"]),
    ("http://h/a;b/c;d;e", ["http", "h", "a_b", "c"]),
    ("9s://x/y", ["9s_x_y"]),
    ("s3://b/é/ü", ["s3", "b", "seg", "seg"]),
])
def test_asset_key(spark, uri, key):
    df = spark.createDataFrame([(uri,)], "uri string")
    assert df.select(text.asset_key(F.col("uri"))).first()[0] == key


def test_printed_rounding_is_that_of_python(spark):
    rng = random.Random(7)
    values = [0.0, 0.05, 0.15, 0.25, 0.35, 0.45, 0.95, 0.005, 0.015, 0.025, 1.005, 2.675,
              59.95, 59.949999, 3599.95, 1e-9, 123456789.125, 0.125, 0.375, 2.5, 1e9 + 0.05]
    values += [rng.randrange(0, 10 ** 6) / 1000 for _ in range(3000)]
    values += [(2 * rng.randrange(0, 10 ** 5) + 1) / 20 for _ in range(2000)]
    values += [(2 * rng.randrange(0, 10 ** 6) + 1) / 200 for _ in range(2000)]
    values += [(2 * rng.randrange(0, 10 ** 6) + 1) / 8 for _ in range(500)]
    values += [-v for v in values[:200]]
    x = F.col("x")
    out = spark.createDataFrame([(v,) for v in values], "x double").select(
        "x", numbers.printed(x, 1), numbers.printed(x, 2), numbers.printed_round(x, 2)).collect()
    for v, one, two, rounded in out:
        assert one == f"{v:.1f}" or float(one) == 0 == float(f"{v:.1f}"), v
        assert two == f"{v:.2f}" or float(two) == 0 == float(f"{v:.2f}"), v
        assert rounded == round(v, 2), v


@pytest.mark.parametrize("seconds, shown", [
    (0.0, "0.0s"), (59.94, "59.9s"), (59.97, "60.0s"), (60.0, "1.0m"), (90.0, "1.5m"),
    (3599.0, "60.0m"), (3600.0, "1.0h"), (9000.0, "2.5h")])
def test_human_duration(spark, seconds, shown):
    df = spark.createDataFrame([(seconds,)], "s double")
    assert df.select(numbers.human_duration(F.col("s"))).first()[0] == shown


def test_guarded_ratios(spark):
    df = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (-7.0, 2.0), (5.0, -1.0)], "a double, b double")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(numbers.ratio_or_zero(a, b)).collect()] == [2.5, 0, -3.5, 0]
    assert [r[0] for r in df.select(numbers.floor_ratio_or_zero(a, b)).collect()] == [2, 0, -4, 0]


def test_tail_counts_characters(spark):
    texts = ["", "abc", "é" * 9 + "z", "xé1234", "😀abcd", "é12", "日1", "日本語" * 5, "a😀" * 8, None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (1, 3, 5, 100):
        got = [r[0] for r in df.select(text.tail(F.col("t"), n)).collect()]
        assert got == [t if t is None else t[-n:] for t in texts]


def test_json_defaults_and_missing_keys(spark):
    df = spark.createDataFrame(
        [('{"a": 1}',), ('{"b": 2}',), ("not json",), (None,), ('{"a": null}',)], "j string")
    j = F.col("j")
    got = [r[0] for r in df.select(text.json_or_default(j, "a int", "a", F.lit(-1))).collect()]
    assert got == [1, -1, -1, -1, -1]
    got = [r[0] for r in df.select(text.missing_keys(j, ["b", "a"])).collect()]
    assert got == [["b"], ["a"], ["a", "b"], ["a", "b"], ["b"]]


def test_names_and_addresses(spark):
    df = spark.createDataFrame([("  aLICE \t smith ", "alice@example.com"), ("bob", "bob@x"),
                                ("", None)], "n string, e string")
    got = [tuple(r) for r in df.select(text.clean_name(F.col("n")), text.is_email(F.col("e"))).collect()]
    assert got == [("Alice Smith", True), ("Bob", False), ("", False)]


@pytest.mark.parametrize("now, cadence, tz, key", [
    ("2024-03-01 00:30", "daily", "UTC", "2024-02-29"),
    ("2024-03-01 00:30", "daily", "America/New_York", "2024-02-28"),
    ("2024-03-01 00:30", None, "UTC", "2024-02-29"),
    ("2024-03-01 00:30", "every blue moon", "UTC", "2024-02-29"),
    ("2024-03-01 00:30", "hourly", "UTC", "2024-02-29-23:00"),
    ("2024-03-10 07:30", "hourly", "America/New_York", "2024-03-10-01:00"),
    ("2024-03-04 00:00", "weekly", "UTC", "2024-02-26"),
    ("2024-03-03 23:59", "weekly", "UTC", "2024-02-19"),
    ("2024-03-01 00:00", "monthly", "UTC", "2024-02-01"),
])
def test_last_finished_key(now, cadence, tz, key):
    assert periods.last_finished_key(datetime.fromisoformat(now), cadence, tz) == key


@pytest.mark.parametrize("key, cadence, tz, start, end", [
    ("2024-02-29", "daily", "UTC", "2024-02-29 00:00", "2024-03-01 00:00"),
    ("2024-03-10", "daily", "America/New_York", "2024-03-10 05:00", "2024-03-11 04:00"),
    ("2024-12-01", "monthly", "UTC", "2024-12-01 00:00", "2025-01-01 00:00"),
    ("2024-02-26", "weekly", "UTC", "2024-02-26 00:00", "2024-03-04 00:00"),
    ("2024-01-01-23:00", "hourly", "UTC", "2024-01-01 23:00", "2024-01-02 00:00"),
    ("2024-11-03-01:00", "hourly", "America/New_York", "2024-11-03 05:00", "2024-11-03 07:00"),
])
def test_key_bounds(key, cadence, tz, start, end):
    assert periods.key_bounds(key, cadence, tz) == (
        datetime.fromisoformat(start), datetime.fromisoformat(end))
