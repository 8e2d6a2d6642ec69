"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from millrace.functions.periods import key_bounds
from millrace.operators import aggregates as agg
from millrace.operators import joins, partitions, quality, transforms, windows
from millrace.plans import QUERIES
from millrace.plans.tables import Tables, book
from millrace.sources import writers

WRITES = {n for n in QUERIES if n.startswith(("sink_", "st_", "src_json_records", "lin_", "ml_"))} | {
    "materialize", "part_run_one", "dq_parse_check_logs"}


@pytest.fixture(scope="module")
def t(spark, data):
    return Tables(spark, data)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITES))
def test_no_products(spark, data, plan_of, name):
    plan = plan_of(QUERIES[name](spark, data))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_filters_and_columns_reach_the_scan(t, plan_of):
    plan = plan_of(transforms.filter_max(t.orders, "o_totalprice", 1000)[0].select("o_orderkey"))
    assert "LessThanOrEqual(o_totalprice,1000.0)" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    plan = plan_of(partitions.filter_static(t.events, "event_type", ["click"]).select("event_id"))
    assert "EqualTo(event_type,click)" in plan or "In(event_type" in plan


def test_time_filters_reach_the_scan(spark, data, plan_of):
    plan = plan_of(QUERIES["agg_customer_insights"](spark, data))
    assert "GreaterThan(o_orderdate,2001-02-02" in plan and "LessThanOrEqual(o_orderdate,2001-08-01" in plan


def test_policies_look_at_all_events(spark, data, plan_of):
    plan = plan_of(QUERIES["fresh_policy"](spark, data))
    assert "PushedFilters: []" in plan and "(ts#" not in plan.split("FileScan")[0].split("Filter")[-1]


def test_one_day_of_an_unpartitioned_table_is_a_range_for_the_scan(t, plan_of):
    plan = plan_of(writers.within(t.events, "ts", *key_bounds("2024-01-15", "daily")))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00" in plan and "LessThan(ts,2024-01-16T00:00" in plan


def test_market_rules_read_what_they_need_and_combine_first(t, plan_of):
    plan = plan_of(agg.rule_violations(agg.market_stats(book(t))))
    schema = plan.split("ReadSchema: struct<")[1].split(">")[0]
    assert {f.split(":")[0] for f in schema.split(",")} <= {
        "l_suppkey", "l_extendedprice", "l_discount", "l_quantity"}
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


def test_checks_share_one_scan_and_copy_no_rows(t, plan_of):
    plan = plan_of(quality.run_checks(
        t.customer, {"c_name": {"null_check": {"equals": 0}}, "c_acctbal": {"min": {"greater_than": 0}, "max": {"less_than": 9}}},
        {"row_count_check": {"greater_than": 0}}))
    assert plan.count("FileScan") == 1
    plan = plan_of(quality.run_checks(
        t.customer, {c: {"unique_check": {"equals": 1}, "null_check": {"equals": 0}} for c in ("c_name", "c_mktsegment", "c_custkey")}))
    assert "Expand" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    scans = [s.split(">")[0] for s in plan.split("ReadSchema: struct<")[1:]]
    assert len(scans) == 4 and sum("," not in s for s in scans) == 3


def test_regions_are_summed_in_hash_tables(spark, data, plan_of):
    plan = plan_of(QUERIES["join_region_default"](spark, data))
    before_list = plan.split("Union")[1].split("Scan ExistingRDD")[0]
    assert "HashAggregate" in before_list and "SortAggregate" not in before_list.split("+- Project")[0]


def test_dedupe_limits_groups_before_the_shuffle(t, plan_of):
    plan = plan_of(windows.latest(t.events.withColumnRenamed("user_id", "asset")))
    before_shuffle = plan.split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_top_rows_need_no_full_sort(t, plan_of):
    assert "TakeOrderedAndProject" in plan_of(transforms.limit_ordered(t.orders, 5, "o_orderkey"))
    assert "TakeOrderedAndProject" in plan_of(windows.preview(t.orders, ["o_orderkey"]))


def test_customer_totals_scan_once(t, plan_of):
    sales = t.orders.select(F.col("o_custkey").alias("customer_id"), F.col("o_totalprice").alias("amount"))
    plan = plan_of(agg.sales_totals(sales), run=True)
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan


def test_parameter_sets_share_one_scan_and_shuffle(t, plan_of):
    plan = plan_of(partitions.run_for_params(
        t.orders, [{"name": "a", "m": 1.0}, {"name": "b", "m": 2.0}],
        lambda p: F.col("o_totalprice") <= p["m"], [F.count(F.lit(1)).alias("n")]))
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1


def test_one_partition_is_all_that_is_read(spark, tmp_path, plan_of):
    path = str(tmp_path / "t")
    df = spark.range(20).withColumn("date", F.concat(F.lit("d"), F.col("id") % 4))
    writers.write_partition(df, path, "date")
    plan = plan_of(spark.read.parquet(path).filter("date = 'd1'"))
    assert "PartitionFilters: [isnotnull(date" in plan


def test_a_large_partition_is_split_when_writing(spark, tmp_path):
    """Two thirds of the rows are of one date: it gets several files, the others one each."""
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "40KB",
                "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        df = spark.range(0, 90000, 1, 8).select(
            "id", F.when(F.col("id") % 3 > 0, "d0").otherwise(F.concat(F.lit("d"), F.col("id") % 4)).alias("date"))
        writers.write_partition(df, str(tmp_path / "t"), "date", rebalance=True)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    files = {d: len(list((tmp_path / "t" / f"date={d}").glob("*.parquet"))) for d in ("d0", "d1", "d2", "d3")}
    assert files["d0"] > 1 and files["d1"] <= 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 90000


def test_a_hot_customer_is_split_and_nothing_is_lost(spark, plan_of):
    """One customer has most orders; AQE splits that partition of the join."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
                "spark.sql.shuffle.partitions": "20",
                "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2"}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        orders = spark.range(0, 60000, 1, 8).select(
            F.col("id").alias("o"), F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id") % 500).alias("c"))
        customers = spark.range(0, 400).select(F.col("id").alias("c"), F.concat(F.lit("n"), "id").alias("name"))
        lines = spark.range(0, 60000, 1, 8).select(F.col("id").alias("o"), (F.col("id") % 11).alias("p"))
        parts = spark.range(0, 11).select(F.col("id").alias("p"), F.col("id").alias("size"))
        got = joins.enrich_orders(orders, customers, lines, parts, "o", "c", "p")
        plan = plan_of(got, run=True)
        assert "skew=true" in plan
        totals = got.agg(F.count(F.lit(1)), F.count("name"), F.sum("size"), F.count_distinct("o")).first()
        unknown = sum(1 for i in range(0, 60000, 3) if i % 500 >= 400)
        assert tuple(totals) == (60000, 60000 - unknown, sum(i % 11 for i in range(60000)), 60000)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
