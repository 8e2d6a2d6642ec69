"""Small inputs whose results can be worked out by hand."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import aggregates as agg
from millrace.operators import joins, transforms, windows

# Small inputs whose results are known.
RAW = [(1, 100, True), (2, None, False), (3, 200, True), (4, -50, False)]
SALES = [(1, 1, 50000, "Q1"), (2, 2, 75000, "Q1"), (3, 1, 60000, "Q2"), (4, 3, 15000, "Q2")]
CUSTOMERS = [(1, "Acme Corp", "US", "enterprise"), (2, "Global Industries", "EU", "enterprise"),
             (3, "Tech Startup", "US", "standard")]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(RAW, "id bigint, value bigint, valid boolean")


@pytest.fixture(scope="module")
def sales(spark):
    return spark.createDataFrame(SALES, "id bigint, customer_id bigint, amount bigint, quarter string")


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(CUSTOMERS, "id bigint, name string, region string, tier string")


def orders(spark, rows):
    return spark.createDataFrame([(f"d-{i}", 10 * i, "US" if i % 2 else "EU") for i in rows],
                                 "order_id string, amount bigint, region string")


def test_categorize(spark, rows):
    df = spark.createDataFrame([(1, 100), (2, 200), (3, 300), (4, 150), (5, None)], "id int, value bigint")
    assert rows(transforms.categorize(df), "id") == [
        (1, 100, 200, "low"), (2, 200, 400, "high"), (3, 300, 600, "high"), (4, 150, 300, "low"),
        (5, None, None, None)]


def test_clean_and_stats(raw, rows):
    kept, counts = transforms.clean_records(raw)
    assert rows(kept, "id") == [(1, 100, True), (3, 200, True)]
    assert rows(counts) == [(2, 2, 4)]
    assert rows(agg.stats(kept)) == [(2, 300, 150.0, 100, 200)]
    assert rows(agg.stats(kept.filter("false"))) == [(0, 0, 0.0, 0, 0)]


def test_totals_of_nothing_have_no_average(raw, rows):
    assert rows(agg.totals(raw.filter("false"))) == [(None, 0, None)]


def test_arrays(spark, rows):
    df = spark.createDataFrame([("api", [1, 2, 3, 4, 5])], "source string, data array<bigint>")
    assert rows(transforms.double_array(df)) == [("api", [2, 4, 6, 8, 10])]
    assert rows(transforms.increment_array(df)) == [("api", [2, 3, 4, 5, 6])]


def test_filters(spark, rows):
    urls = spark.createDataFrame([("https://example.com",), ("https://test.com",)], "url string")
    kept, counts = transforms.filter_min(urls, "url", 17)
    assert rows(kept) == [("https://example.com", 19)]
    assert rows(counts) == [(1, 1, 2)]
    for cutoff, n, us, eu in [(100, 7, 160, 120), (50, 5, 90, 60)]:
        cheap, counts = transforms.filter_max(orders(spark, range(1, 8)), "amount", cutoff)
        assert rows(counts) == [(n, 7 - n, 7)]
        assert rows(joins.region_totals(cheap, ["US", "EU", "APAC"]), "region") == [
            ("APAC", 0), ("EU", eu), ("US", us)]


def test_route_keeps_every_row(spark, rows):
    df = spark.createDataFrame([(150,), (100,), (None,), (101,)], "value int")
    large, small = transforms.route(df)
    assert rows(large, "value") == [(101, "process_large"), (150, "process_large")]
    assert rows(small, "value") == [(None, "process_small"), (100, "process_small")]


def test_customer_scores(customers, rows):
    got = transforms.enrich_customers(customers).select("id", "score", "region_code")
    assert rows(got, "id") == [(1, 100, "us"), (2, 100, "eu"), (3, 50, "us")]
    assert rows(agg.customer_counts(customers)) == [(3, 2)]
    assert rows(transforms.upper_names(customers).select("name"), "name")[0] == ("ACME CORP",)


def test_spread_of_a_zero_bid_is_null(spark, rows):
    df = spark.createDataFrame([(0.5, 0.55), (0.0, 0.1)], "best_bid double, best_ask double")
    first, second = rows(transforms.with_spread(df).select("spread_pct"))
    assert first[0] == pytest.approx(10) and second[0] is None


def test_run_dates(spark, rows):
    texts = ["2024-01-05", "2024-1-5", "2024-02-30", "05/01/2024", "2024-01-05 ", None, "20240105"]
    df = spark.createDataFrame([(t,) for t in texts], "date string")
    good, rejects = transforms.with_run_date(df)
    assert rows(good.select("date", "weekday"), "date") == [
        ("2024-01-05", "Friday"), ("2024-1-5", "Friday")]
    assert {r[0] for r in rows(rejects)} == set(texts[2:])


def test_sales_totals(sales, rows):
    got = agg.sales_totals(sales).orderBy("is_overall", "customer_id")
    assert rows(got.select("customer_id", "total", "count", "average")) == [
        (1, 110000, 2, 55000.0), (2, 75000, 1, 75000.0), (3, 15000, 1, 15000.0),
        (None, 200000, 4, 50000.0)]
    assert rows(agg.sales_totals(sales.filter("false"))) == [(None, 0, 0, True, 0.0)]
    assert rows(agg.sales_by_quarter(sales), "customer_id", "quarter")[:2] == [
        (1, "Q1", 50000, 1), (1, "Q2", 60000, 1)]


def test_combined_report(sales, customers, rows):
    kpis = joins.merge_kpis(agg.customer_counts(customers), agg.sales_metrics(sales))
    assert rows(kpis) == [(3, 2, 200000, 4, 50000.0)]
    n, revenue, each, top, share = rows(agg.customer_metrics(kpis))[0]
    assert (n, revenue, top) == (3, 200000, 2)
    assert each == pytest.approx(200000 / 3) and share == pytest.approx(2 / 3)
    nobody = joins.merge_kpis(agg.customer_counts(customers.filter("false")),
                              agg.sales_metrics(sales.filter("false")))
    assert rows(agg.customer_metrics(nobody)) == [(0, 0, 0.0, 0, 0.0)]


def test_union_stats(spark, rows):
    a = spark.createDataFrame([(i,) for i in range(1, 6)], "value bigint")
    b = spark.createDataFrame([(10 * i,) for i in range(1, 6)], "value bigint")
    assert rows(agg.union_stats(a, b)) == [(5, 5, 10, 165, 16.5)]
    assert agg.union_inputs(a, a).count() == 10
    assert rows(agg.map_sum(a, lambda v: v * 2)) == [(30,)]


def test_regional_report(spark, rows):
    df = spark.createDataFrame(
        [("us", 15000, 2500000, "USD"), ("uk", 8000, 1800000, "GBP"), ("de", 12000, 2200000, "EUR"),
         ("loss", 2, -7, "EUR")], "region string, customers bigint, revenue bigint, currency string")
    got = joins.regional_report(df, ["us", "uk", "xx", "loss"])
    assert rows(got, "region") == [
        ("loss", 2, -7, "EUR", -4), ("uk", 8000, 1800000, "GBP", 225), ("us", 15000, 2500000, "USD", 166),
        ("xx", 0, 0, "USD", 0)]


def test_file_revenue(spark, rows):
    df = spark.createDataFrame([("f", 50000), ("f", 35000), ("f", 75000), ("f", None)],
                               "source_file string, revenue bigint")
    assert rows(agg.file_revenue(df)) == [("f", 4, 160000)]


def test_market_profile_and_rules(spark, rows):
    df = spark.createDataFrame(
        [("m1", 0.5, 100, 0.02, 30000), ("m1", 0.7, 300, 0.06, 10000), ("m2", 0.4, 50, 0.01, 90000)],
        "market_id string, price double, volume bigint, spread double, liquidity_depth bigint")
    profile = agg.market_profile(df)
    m1, m2 = rows(profile, "market_id")
    assert m1[1:5] == pytest.approx((0.6, 0.02 ** 0.5, 400, 200))
    assert m1[5:] == pytest.approx((0.04, 0.02, 0.06, 20000))
    assert m2[2] is None
    assert [r[0] for r in rows(agg.anomalies(profile))] == ["m1"]
    stats = spark.createDataFrame([("a", 1, 0.4, 60000), ("b", 1, 0.6, 60000), ("c", 1, 0.6, 10)],
                                  "market_id string, snapshot_count bigint, avg_spread_pct double, "
                                  "total_market_volume bigint")
    assert [r[0] for r in rows(agg.rule_violations(stats), "market_id")] == ["a", "c"]


def test_market_corr_is_over_common_snapshots(spark, rows):
    df = spark.createDataFrame(
        [("a", 1, 1.0), ("a", 2, 2.0), ("a", 3, 3.0), ("a", 3, 5.0), ("b", 1, 6.0), ("b", 2, 4.0),
         ("b", 3, 0.0), ("b", 9, 50.0)], "market_id string, snapshot int, price double")
    pairs = spark.createDataFrame([("a", "b"), ("a", "zz")], "market_a string, market_b string")
    (a, b, n, corr), = rows(agg.market_corr(df, pairs))
    assert (a, b, n) == ("a", "b", 3) and corr == pytest.approx(-1)


def test_dedupe_and_latest(spark, rows):
    df = spark.createDataFrame([(1, 10, 5), (1, 11, 5), (1, 9, 7), (2, 3, 1), (None, 1, 1), (None, 2, 1)],
                               "k int, id int, t int")
    got = windows.dedupe(df, ["k"], [F.col("t").desc(), F.col("id").desc()])
    assert rows(got, "k") == [(None, 2, 1), (1, 9, 7), (2, 3, 1)]


def test_merge_edges_first_position_wins(spark, rows):
    explicit = spark.createDataFrame([("c", "x", 0), ("c", "y", 1), ("c", "x", 2)],
                                     "consumer string, dep string, ord int")
    inferred = spark.createDataFrame([("c", "z", 0), ("c", "x", 1), ("d", "x", 0)],
                                     "consumer string, dep string, ord int")
    got = windows.merge_edges(explicit, inferred)
    assert rows(got, "consumer", "source", "ord") == [
        ("c", "x", 0, 0), ("c", "y", 0, 1), ("c", "z", 1, 0), ("d", "x", 1, 0)]


def test_external_assets(spark, rows):
    assets = spark.createDataFrame([("a",), ("b",), ("b",), ("unused",)], "uri string")
    edges = spark.createDataFrame([("c", "b"), ("c", "a"), ("d", "undeclared")], "consumer string, dep string")
    built = spark.createDataFrame([("a",), ("c",)], "uri string")
    assert rows(joins.external_assets(assets, edges, built)) == [("b",)]


def test_enriched_lines_keep_unknown_keys(spark):
    o = spark.createDataFrame([(1, 7), (2, 8)], "o int, c int")
    c = spark.createDataFrame([(7, "x")], "c int, name string")
    li = spark.createDataFrame([(1, 1), (1, 2), (2, 9)], "o int, p int")
    p = spark.createDataFrame([(1, "bolt")], "p int, part string")
    got = joins.enrich_orders(o, c, li, p, "o", "c", "p")
    assert {(r.o, r.p, r.name, r.part) for r in got.collect()} == {
        (1, 1, "x", "bolt"), (1, 2, "x", None), (2, 9, None, None)}
