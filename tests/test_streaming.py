"""Streams over several files in any order, with restarts and replays, next to the same query as a batch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators.aggregates import market_stats, rule_violations
from millrace.streaming import streams
from millrace.streaming import totals as totals_module

BOOK = ("market_id string, snapshot_id bigint, ts timestamp, best_bid double, best_ask double, "
        "total_volume bigint")
EVENTS = "asset string, event_id bigint, ts timestamp, success boolean, value double"
START = datetime(2024, 1, 1)


def arrive(spark, folder, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder))


def book_rows(first_hour, hours):
    return [(f"m{m}", h * 100 + m * 10 + i, START + timedelta(hours=h, minutes=10 * i), 0.5,
             0.5 + 0.01 * ((m + h) % 3), 20000 * (m + 1))
            for h in range(first_hour, first_hour + hours) for m in range(3) for i in range(4)]


COLUMNS = ["window_start", "market_id", "snapshot_count", "avg_spread_pct", "total_market_volume"]


def batch_violations(spark, everything, min_spread, min_volume):
    """Closed windows that break the rules, from all rows at once."""
    batch = spark.createDataFrame(everything, BOOK).withColumn("window_start", F.date_trunc("hour", "ts"))
    last = max(r[2] for r in everything) - timedelta(minutes=10)
    return [r for r in map(tuple, rule_violations(market_stats(batch, "window_start", "market_id"), min_spread, min_volume)
                           .select(*COLUMNS).orderBy("window_start", "market_id").collect())
            if r[0] + timedelta(hours=1) <= last]


def test_order_book_of_two_streams_in_any_order(spark, tmp_path, rows):
    """Eight files in eight batches, dealt to two checkpoints, the oldest snapshots last, with a restart."""
    everything = book_rows(0, 30)
    random.Random(1).shuffle(everything)
    everything.sort(key=lambda r: r[2] < START + timedelta(hours=2))
    files = [everything[i::8] for i in range(7)] + [everything[7::8]]
    out = str(tmp_path / "out")
    for turn in range(2):
        for name, own in (("a", files[:3]), ("b", files[3:])):
            for part in own[turn::2]:
                arrive(spark, tmp_path / name, part, BOOK)
            book = streams.read_stream(spark, str(tmp_path / name), BOOK, files_per_batch=1)
            totals = streams.order_book_stream(book, out, str(tmp_path / f"progress-{name}"), 0.5, 100000)
    got = rows(streams.violations(spark, out).select(*COLUMNS), "window_start", "market_id")
    want = batch_violations(spark, everything, 0.5, 100000)
    assert 0 < len(got) < 90 and [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])
    log = totals.log(spark).agg(F.sum("rows"), F.sum("late"), F.count("batch")).first()
    assert log[0] == len(everything) and log[1] > 0 and log[2] == 8
    assert totals.totals(spark).agg(F.sum("snapshot_count")).first()[0] == len(everything)


def test_a_violation_goes_when_late_volume_comes(spark, tmp_path):
    out, source, progress = str(tmp_path / "out"), tmp_path / "in", str(tmp_path / "progress")
    found = []
    for hour, volume in ((0, 1), (5, 1), (0, 10**6)):
        arrive(spark, source, [("m", hour, START + timedelta(hours=hour), 0.5, 0.6, volume)], BOOK)
        streams.order_book_stream(streams.read_stream(spark, str(source), BOOK), out, progress, 0.0, 1000)
        found.append(streams.violations(spark, out).count())
    assert found == [0, 1, 0]


def test_a_batch_that_runs_again_counts_once(spark, tmp_path):
    """Also if the first run was lost after it wrote, and after later batches of another stream."""
    totals = streams.alert_totals(str(tmp_path))
    day = lambda d, n: spark.createDataFrame([("a", i, START + timedelta(days=d, hours=i), True, 0.5) for i in range(n)], EVENTS)
    for source, batch, rows in (("x", 0, day(0, 3)), ("x", 1, day(0, 4)), ("x", 1, day(0, 4)), ("y", 0, day(0, 5)),
                                ("x", 1, day(0, 4)), ("x", 2, day(1, 2)), ("x", 3, day(0, 1)), ("x", 3, day(0, 1))):
        totals.add(rows, batch, source)
    got = {r.window_start: (r.records, r["sum"]) for r in totals.totals(spark).collect()}
    assert got == {START: (13, 6.5), START + timedelta(days=1): (2, 1.0)}
    assert totals.log(spark).agg(F.sum("rows"), F.sum("late")).first() == (15, 1)
    assert totals.add(day(0, 0), 4, "x") is None


def test_a_batch_stores_its_own_sums_only(spark, tmp_path):
    """What earlier batches stored is neither read into a batch nor written again, and judged once a run."""
    files = lambda: {p for p in (tmp_path / "out" / "totals" / "windows").rglob("*.parquet")}
    seen, judged = [], []
    totals = streams.order_book_totals(str(tmp_path / "out"), bucket="year")
    for batch in range(3):
        totals.add(streams.with_spread(spark.createDataFrame(book_rows(0, 4), BOOK)), batch, "x")
        seen.append(files())
    assert seen[0] and seen[0] < seen[1] < seen[2]
    assert {r.snapshot_count for r in totals.totals(spark).collect()} == {12}
    for i in range(3):
        arrive(spark, tmp_path / "in", book_rows(4 * i, 4), BOOK)
    rows = streams.with_spread(streams.read_stream(spark, str(tmp_path / "in"), BOOK, files_per_batch=1))
    totals.run(rows, str(tmp_path / "progress"), lambda found, due: judged.append(found.count()))
    assert judged == [33]


def test_segments_are_added_up_by_level(spark, tmp_path, monkeypatch):
    """Every third segment; replays of any batch, the one that merged among them, change nothing."""
    monkeypatch.setattr(totals_module, "MERGED", 3)
    totals = streams.alert_totals(str(tmp_path))
    for batch in (0, 1, 2, 3, 3, 4, 5, 6, 7, 7, 8, 9, 10, 11, 12, 13, 13):
        day = [("a", i, START + timedelta(days=batch % 2), True, 0.5) for i in range(batch + 1)]
        totals.add(spark.createDataFrame(day, EVENTS), batch, "x")
    got = {r.window_start: (r.records, r["sum"]) for r in totals.totals(spark).collect()}
    assert got == {START: (49, 24.5), START + timedelta(days=1): (56, 28.0)}
    folders = {tuple(int(part.split("=")[1]) for part in p.parts[-3:-1]) for p in (tmp_path / "totals").rglob("*.parquet") if "log" not in p.parts}
    live = {(r["first"], r["batch"]) for r in totals._segments(totals.log(spark)).filter("live").collect()}
    assert live == {(0, 8), (9, 11), (12, 12), (13, 13)} and live <= folders and (0, 0) not in folders


def test_what_a_lost_run_did_not_judge_is_due_in_the_next(spark, tmp_path):
    out, progress = str(tmp_path / "out"), str(tmp_path / "progress")
    book = lambda: streams.read_stream(spark, str(tmp_path / "in"), BOOK, files_per_batch=1)
    for hour in (0, 5):
        arrive(spark, tmp_path / "in", [("m", hour, START + timedelta(hours=hour), 0.5, 0.6, 1)], BOOK)

    def lost(found, due):
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        streams.order_book_totals(out).run(streams.with_spread(book()), progress, lost)
    assert streams.violations(spark, out).count() == 0
    streams.order_book_stream(book(), out, progress, 0.0, 1000)
    assert [r.window_start for r in streams.violations(spark, out).collect()] == [START]


def test_rows_without_a_time_are_in_no_window(spark, tmp_path):
    totals = streams.alert_totals(str(tmp_path))
    rows = spark.createDataFrame([("a", 1, None, True, 1.0), ("a", 2, START, True, None)], EVENTS)
    assert totals.add(rows, 0, "x") is not None
    assert [(r.records, r["sum"], r["values"]) for r in totals.totals(spark).collect()] == [(1, None, 0)]


def test_alerts_add_up_over_streams(spark, tmp_path, rows):
    """Two inputs of the same days, each under its own checkpoint, and a restart of each."""
    out = str(tmp_path / "out")
    for turn in range(2):
        for name, value in (("one", 0.125), ("two", 0.5)):
            arrive(spark, tmp_path / name, [("a", i, START + timedelta(days=turn, hours=i), True, value) for i in range(3)], EVENTS)
            arrive(spark, tmp_path / name, [("a", 9, START + timedelta(days=5), True, 1.0)], EVENTS)
            events = streams.read_stream(spark, str(tmp_path / name), EVENTS, files_per_batch=1)
            streams.alert_stream(events, out, str(tmp_path / f"progress-{name}"), "daily")
    got = rows(streams.alerts(spark, out).select("window_start", "records", "sum", "average", "stream"), "window_start")
    assert got == [(START, 6, 1.875, 0.31, "daily"), (START + timedelta(days=1), 6, 1.875, 0.31, "daily")]
    # nothing new arrived: nothing changes
    streams.alert_stream(streams.read_stream(spark, str(tmp_path / "one"), EVENTS), out, str(tmp_path / "progress-one"), "daily")
    assert streams.alerts(spark, out).count() == 2


def test_each_materialization_triggers_once(spark, tmp_path, rows):
    """Also a year later, in another stream, and behind events of any time."""
    out = str(tmp_path / "out")
    watch = spark.createDataFrame([("a", "job_a"), ("a", "job_b"), ("c", "job_c")], "asset string, job string")
    first = [("a", 1, START, True, 0.0), ("b", 2, START, True, 0.0), ("a", 3, START, False, 0.0),
             ("a", 1, START, True, 0.0)]
    second = [("a", 1, START, True, 0.0)] * 500 + [("c", 4, START + timedelta(days=400), True, 0.0)]
    third = [("a", 1, START + timedelta(days=401), True, 0.0), ("a", 5, START - timedelta(days=900), True, 0.0)]
    for name, files in (("x", [first, second]), ("x", [third]), ("y", [first, second, third])):
        for new in files:
            arrive(spark, tmp_path / name, new, EVENTS)
        events = streams.read_stream(spark, str(tmp_path / name), EVENTS, files_per_batch=1)
        streams.trigger_stream(events, watch, out, str(tmp_path / f"progress-{name}"), prefixes=4)
    assert rows(streams.run_ledger(spark, out).select("run_key", "asset"), "run_key") == [
        ("job_a:1", "a"), ("job_a:5", "a"), ("job_b:1", "a"), ("job_b:5", "a"), ("job_c:4", "c")]


def test_landing_is_exactly_once_in_few_files(spark, tmp_path):
    out, progress, schema = str(tmp_path / "out"), str(tmp_path / "progress"), EVENTS
    events = [("a", i, START + timedelta(minutes=7 * i), True, 1.0) for i in range(120)]
    landed = lambda: streams.landed(spark, out, schema)
    for i in range(8):
        arrive(spark, tmp_path / "in", events[i::8], EVENTS)
    for _ in range(2):
        streams.ingest_stream(streams.read_stream(spark, str(tmp_path / "in"), EVENTS, files_per_batch=1), out, progress)
    assert landed().count() == 120 and landed().select("event_id").distinct().count() == 120
    # the last hours are not over yet
    streams.compact_hours(spark, out, schema, START + timedelta(hours=12))
    files = lambda name: len(list((tmp_path / "out" / name).rglob("*.parquet")))
    assert files("closed") == 12 and landed().count() == 120
    assert landed().select("event_id").distinct().count() == 120
    # a batch that runs again, and late rows of a closed hour
    again = spark.createDataFrame(events[0::8], EVENTS)
    part = spark.read.parquet(f"{out}/closed").filter("event_id = 0").first().part
    streams.write_partition(streams.with_hour(again).withColumn("part", F.lit(part)), f"{out}/arrived", "date", "part")
    assert landed().count() == 120
    arrive(spark, tmp_path / "in", [("late", 1000, START, True, 1.0)], EVENTS)
    streams.ingest_stream(streams.read_stream(spark, str(tmp_path / "in"), EVENTS), out, progress)
    assert landed().count() == 121
    streams.compact_hours(spark, out, schema, START + timedelta(hours=24))
    assert landed().count() == 121 and landed().select("event_id").distinct().count() == 121
    assert files("closed") == 14 and files("arrived") == 0


def test_a_zone_less_time_needs_a_cast(spark, tmp_path):
    arrive(spark, tmp_path / "in", [(datetime(2024, 1, 1), 1.0)], "ts timestamp_ntz, value double")
    raw = streams.read_stream(spark, str(tmp_path / "in"), "ts timestamp_ntz, value double")
    assert streams.event_time(raw).schema["ts"].dataType.simpleString() == "timestamp"
