from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from millrace.functions.periods import instant, key_bounds, last_finished_key
from millrace.operators import freshness, partitions


def bounds(spark, lo, hi):
    return spark.createDataFrame([(lo, hi)], "lo string, hi string").select(
        F.to_timestamp("lo").alias("lo"), F.to_timestamp("hi").alias("hi"))


@pytest.mark.parametrize("cadence, tz, lo, hi, keys", [
    ("daily", "UTC", "2024-01-30", "2024-02-02 12:00", ["2024-01-30", "2024-01-31", "2024-02-01"]),
    ("daily", "UTC", "2024-01-30 01:00", "2024-02-01", ["2024-01-31"]),
    (None, "UTC", "2024-01-30", "2024-01-31", ["2024-01-30"]),
    ("fortnightly", "UTC", "2024-01-30", "2024-01-31", ["2024-01-30"]),
    ("weekly", "UTC", "2024-01-02", "2024-01-29", ["2024-01-08", "2024-01-15", "2024-01-22"]),
    ("monthly", "UTC", "2023-11-15", "2024-03-31", ["2023-12-01", "2024-01-01", "2024-02-01"]),
    ("hourly", "UTC", "2024-01-01 22:30", "2024-01-02 01:15",
     ["2024-01-01-23:00", "2024-01-02-00:00"]),
    ("daily", "UTC", "2024-01-30", "2024-01-30 23:59", []),
    ("daily", "UTC", "2024-02-30", "2024-01-30", []),
    # clocks go forward on 10 March and back on 3 November in New York
    ("hourly", "America/New_York", "2024-03-10 06:00", "2024-03-10 09:00",
     ["2024-03-10-01:00", "2024-03-10-03:00", "2024-03-10-04:00"]),
    ("hourly", "America/New_York", "2024-11-03 05:00", "2024-11-03 07:00",
     ["2024-11-03-01:00", "2024-11-03-01:00"]),
])
def test_calendar(spark, cadence, tz, lo, hi, keys):
    if lo == "2024-02-30":
        lo = "2024-03-01"
    got = partitions.partition_calendar(bounds(spark, lo, hi), "lo", "hi", cadence, tz)
    assert [r.partition_key for r in got.orderBy("period_start").collect()] == keys


def test_days_across_a_clock_change(spark):
    got = partitions.partition_calendar(bounds(spark, "2024-03-09 05:00", "2024-03-13"), "lo", "hi",
                                        "daily", "America/New_York").orderBy("partition_key")
    hours = got.select("partition_key", ((F.unix_timestamp("period_end")
                                          - F.unix_timestamp("period_start")) / 3600).alias("h"))
    assert [tuple(r) for r in hours.collect()] == [
        ("2024-03-09", 24), ("2024-03-10", 23), ("2024-03-11", 24)]


def test_assignment_agrees_with_the_calendar(spark):
    """Every time inside a period gets that period's key."""
    for cadence in ("hourly", "daily", "weekly", "monthly"):
        calendar = partitions.partition_calendar(
            bounds(spark, "2024-02-25", "2024-04-15"), "lo", "hi", cadence, "Europe/Berlin")
        inside = calendar.select("partition_key", F.explode(F.array(
            F.col("period_start"), F.col("period_end") - F.expr("INTERVAL 1 SECOND"))).alias("ts"))
        keyed = partitions.assign_partition(inside, "ts", cadence, "Europe/Berlin", output="k")
        assert keyed.count() > 0
        assert keyed.filter("k <> partition_key").count() == 0


def test_custom_key_format(spark):
    df = bounds(spark, "2024-01-05 10:00", "2024-01-05")
    assert partitions.assign_partition(df, "lo", "monthly", fmt="yyyyMM").first().partition_key == "202401"


ZONES = ["Asia/Kolkata", "Asia/Kathmandu", "Australia/Lord_Howe", "America/New_York", "UTC"]


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Kathmandu"])
def session_zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def clock(at, tz):
    return at.replace(tzinfo=timezone.utc).astimezone(ZoneInfo(tz)).replace(tzinfo=None)


@pytest.mark.parametrize("tz", ZONES)
def test_keys_of_any_zone_in_any_session(spark, session_zone, tz):
    """Around the clock changes of 2024, as instants and without a zone, next to Python's zones."""
    changes = [datetime(2024, 3, 10, 5), datetime(2024, 11, 3, 4), datetime(2024, 4, 6, 13), datetime(2024, 10, 5, 13)]
    times = [c + timedelta(minutes=m, seconds=1, microseconds=7) for c in changes for m in range(0, 300, 15)]
    df = spark.createDataFrame([(t,) for t in times], "ntz timestamp_ntz").withColumn(
        "instant", instant(F.col("ntz")))
    micros = [int(t.replace(tzinfo=timezone.utc).timestamp()) * 10**6 + 7 for t in times]
    assert [r[0] for r in df.select(F.unix_micros("instant")).collect()] == micros
    starts = {"hourly": lambda t: t.replace(minute=0, second=0, microsecond=0).strftime("%Y-%m-%d-%H:%M"),
              "daily": lambda t: t.strftime("%Y-%m-%d"), "monthly": lambda t: t.strftime("%Y-%m-01"),
              "weekly": lambda t: (t - timedelta(days=t.weekday())).strftime("%Y-%m-%d")}
    for cadence, key in starts.items():
        for column in ("ntz", "instant"):
            got = partitions.assign_partition(df, column, cadence, tz).collect()
            assert [r.partition_key for r in got] == [key(clock(t, tz)) for t in times]
    low, high = min(times), max(times)
    for cadence in starts:
        lo, hi = (low, low + timedelta(days=240)) if cadence != "hourly" else (changes[2] - timedelta(hours=3), changes[2] + timedelta(hours=9))
        edge = spark.createDataFrame([(lo, hi)], "lo timestamp_ntz, hi timestamp_ntz")
        rows = partitions.partition_calendar(edge, "lo", "hi", cadence, tz)
        inside = rows.select("partition_key", F.explode(F.array(
            "period_start", F.timestamp_micros(F.unix_micros("period_end") - 1))).alias("ts"))
        keyed = partitions.assign_partition(inside, "ts", cadence, tz, output="k")
        assert keyed.count() > 0 and keyed.filter("k <> partition_key").isEmpty()
        # periods follow each other without a gap
        spans = sorted(tuple(r) for r in rows.select(F.unix_micros("period_start"), F.unix_micros("period_end")).collect())
        assert all(a[1] == b[0] for a, b in zip(spans, spans[1:])) and all(a < b for a, b in spans)


def test_hours_off_the_full_hour(spark):
    keys = {tz: [r.partition_key[-5:] for r in partitions.partition_calendar(
        bounds(spark, "2024-01-01 00:00", "2024-01-01 03:00"), "lo", "hi", "hourly", tz).orderBy("period_start").collect()]
        for tz in ("Asia/Kolkata", "Asia/Kathmandu")}
    assert keys == {"Asia/Kolkata": ["06:00", "07:00"], "Asia/Kathmandu": ["06:00", "07:00"]}
    # half an hour is shown twice, and half an hour later in the year not at all
    for lo, lengths in (("2024-04-06 13:00", [60, 90, 60]), ("2024-10-05 14:30", [60, 30, 60])):
        hours = partitions.partition_calendar(bounds(spark, lo, "2025-01-01"), "lo", "hi", "hourly", "Australia/Lord_Howe")
        got = hours.orderBy("period_start").limit(3).select(
            (F.unix_seconds("period_end") - F.unix_seconds("period_start")) / 60).collect()
        assert [r[0] for r in got] == lengths


def test_calendars_without_a_start(spark):
    edge = bounds(spark, "2024-01-01", "2024-06-30").drop("lo")
    first = {c: partitions.partition_calendar(edge, None, "hi", c).agg(F.min("partition_key")).first()[0]
             for c in ("hourly", "daily", "weekly", "monthly")}
    assert first == {"hourly": "2024-05-31-00:00", "daily": "2024-05-31", "weekly": "2024-01-08", "monthly": "2023-07-01"}


@pytest.mark.parametrize("fmt, key", [("yyyyMMdd", "20240105"), ("%Y%m%d", "20240105"), ("%d/%m/%y", "05/01/24"),
                                      ("yyyy'y'MM", "2024y01"), ("run_%Y", "run_2024"), ("100%%", None), ("EEE", None)])
def test_key_formats(spark, fmt, key):
    df = bounds(spark, "2024-01-05 10:00", "2024-01-06 10:00")
    if key is None:
        with pytest.raises(ValueError):
            partitions.assign_partition(df, "lo", "daily", fmt=fmt)
        return
    assert partitions.assign_partition(df, "lo", "daily", fmt=fmt).first().partition_key == key
    assert partitions.partition_calendar(df, "lo", "hi", "daily", fmt=fmt).count() == 0
    assert last_finished_key(datetime(2024, 1, 6, 10), "daily", fmt=fmt) == key
    if "dd" in fmt or "%d" in fmt:
        assert key_bounds(key, "daily", fmt=fmt) == (datetime(2024, 1, 5), datetime(2024, 1, 6))


def test_missing_ranges(spark, rows):
    calendar = spark.createDataFrame([(a, i, f"k{i:02d}") for a in "xy" for i in range(10)], "asset string, period_start int, key string")
    existing = spark.createDataFrame([("x", f"k{i:02d}") for i in (0, 3, 4, 9)] * 2 + [("z", "k01")], "asset string, key string")
    got = partitions.missing_ranges(calendar, existing, "asset", "key")
    assert rows(got, "asset", "first_key") == [("x", "k01", "k02", 2), ("x", "k05", "k08", 4), ("y", "k00", "k09", 10)]
    one = partitions.missing_ranges(calendar.filter("asset = 'x'"), existing.filter("asset = 'x'"), "key")
    assert rows(one, "first_key") == [("k01", "k02", 2), ("k05", "k08", 4)]


def test_new_missing_and_static(spark, rows):
    data = spark.createDataFrame([("us",), ("uk",), ("us",), (None,), ("fr",)], "region string")
    known = spark.createDataFrame([("us",), ("uk",)], "region string")
    assert rows(partitions.new_partitions(data, "region", known)) == [("fr",)]
    assert rows(partitions.filter_static(data, "region", ["us", "de"])) == [("us",), ("us",)]
    assert rows(partitions.missing_partitions(
        spark.createDataFrame([("us",), ("jp",)], "region string"), data, "region")) == [("jp",)]


def test_params(spark, rows):
    df = spark.createDataFrame([(10 * i,) for i in range(1, 8)], "amount int")
    params = [{"name": "us", "max_price": 50}, {"name": "strict", "max_price": 30}, {"name": "none", "max_price": 1}]
    got = partitions.run_for_params(df, params, lambda p: F.col("amount") <= p["max_price"],
                                    [F.count(F.lit(1)).alias("kept"), F.sum("amount").alias("total")])
    assert rows(got, "params") == [("strict", 3, 60), ("us", 5, 150)]


# ---- freshness

def ts(text):
    return datetime.fromisoformat(text)


def test_policy_is_the_shortest_interval(spark, rows):
    day, hour = ts("2024-01-01 06:00"), ts("2024-01-01 09:00")
    df = spark.createDataFrame(
        [("a", 0, 1440, day), ("a", 1, 60, hour), ("a", 2, 60, day), ("b", 0, None, day), ("c", 0, 0, day)],
        "asset string, ord int, interval_minutes int, last_deadline timestamp")
    assert rows(freshness.freshness_policies(df)) == [("a", 60, hour)]


def test_freshness(spark, rows):
    deadline = ts("2024-01-01 09:00")
    policies = spark.createDataFrame([(a, 60, deadline) for a in ("edge", "late", "never", "new")],
                                     "asset string, interval_minutes int, last_deadline timestamp")
    events = spark.createDataFrame(
        [("edge", ts("2024-01-01 08:00")), ("late", ts("2024-01-01 07:59")), ("late", ts("2023-12-01 00:00")),
         ("new", ts("2024-01-01 12:00"))], "asset string, ts timestamp")
    got = freshness.freshness(events, policies).select("asset", "status")
    assert rows(got, "asset") == [("edge", "PASS"), ("late", "FAIL"), ("never", "FAIL"), ("new", "PASS")]


def test_stale(spark, rows):
    events = spark.createDataFrame(
        [("old", ts("2024-01-01")), ("mid", ts("2024-01-02")), ("new", ts("2024-01-03"))],
        "asset string, ts timestamp")
    edges = spark.createDataFrame(
        [("mid", "old"), ("mid", "new"), ("new", "old"), ("new", "mid"), ("old", "mid"), ("old", "new"),
         ("fresh", "old"), ("fresh", "new"), ("idle", "ghost"), ("old2", "ghost")],
        "consumer string, dep string")
    some = {r.consumer: r.stale for r in freshness.stale(edges, events, "any").collect()}
    every = {r.consumer: r.stale for r in freshness.stale(edges, events, "all").collect()}
    assert some == {"mid": True, "new": False, "old": True, "fresh": True, "idle": False, "old2": False}
    assert every == {"mid": False, "new": False, "old": True, "fresh": True, "idle": False, "old2": False}
    with pytest.raises(ValueError):
        freshness.stale(edges, events, "some")


def test_run_reports(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, ts("2024-01-01 00:00:00"), ts("2024-01-01 00:01:30.125"), True, "x" * 6000),
         ("a", 2, ts("2024-01-02 00:00:00"), ts("2024-01-02 00:00:00.005"), False, "short")],
        "asset string, event_id int, start timestamp, end timestamp, success boolean, stdout string")
    got = freshness.run_summary(df).select(
        "event_id", "duration_seconds", "execution_time", F.length("stdout"))
    # 90.125 is an exact tie and goes to the even digit; 0.005 is stored a little above
    assert rows(got, "event_id") == [(1, 90.12, "1.5m", 5000), (2, 0.01, "0.0s", 5)]
    timed = df.withColumn("duration", F.col("event_id") * 10.0).withColumn("ts", F.col("start"))
    assert rows(freshness.run_outcomes(timed)) == [("a", 2, 1, 15.0, 20.0)]
