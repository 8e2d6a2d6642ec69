import pytest
from pyspark.sql import functions as F

from millrace.operators import quality


@pytest.fixture(scope="module")
def users(spark):
    return spark.createDataFrame(
        [("a@x", 30, "2024-01-01"), ("b@x", 40, "2024-01-02"), (None, 119, "2024-01-03"), (None, 1, None)],
        "email string, age int, created_at string")


def by_name(df):
    return {r["check"]: (r["observed"], r["passed"]) for r in df.collect()}


def test_column_and_table_checks(users):
    got = by_name(quality.run_checks(users, {
        "email": {"null_check": {"equals": 0}, "unique_check": {"equals": 1}},
        "age": {"min": {"greater_than": 0}, "max": {"less_than": 119}},
        "created_at": {"max": {"less_than_or_equal": F.lit("2024-01-03")}}},
        {"row_count_check": {"greater_than": 0}, "row_count_range": {"greater_than": 3, "less_than": 4}}))
    assert got == {"email_null_check": ("2", False), "email_unique_check": ("1", True),
                   "age_min": ("1", True), "age_max": ("119", False),
                   "created_at_max": ("2024-01-03", True), "row_count_check": ("4", True),
                   "row_count_range": ("4", False)}


def test_repeated_values_are_not_unique(users):
    twice = users.union(users)
    assert by_name(quality.column_checks(twice, {"email": {"unique_check": {"equals": 1}}})) == {
        "email_unique_check": ("0", False)}


def test_checks_on_an_empty_table(users):
    got = by_name(quality.run_checks(users.filter("false"), {"age": {"min": {"greater_than": 0}}},
                                     {"row_count_check": {"greater_than": 0}}))
    assert got == {"age_min": (None, False), "row_count_check": ("0", False)}


def test_unknown_checks_are_errors(users):
    with pytest.raises(ValueError):
        quality.column_checks(users, {"age": {"median": {"equals": 1}}})
    with pytest.raises(ValueError):
        quality.column_checks(users, {"age": {"min": {"near": 1}}})
    with pytest.raises(ValueError):
        quality.run_checks(users)


def test_predicate_and_not_empty(users, rows):
    none = users.filter("false")
    assert rows(quality.predicate_check(users, "old", F.col("age") > 0)) == [("old", True)]
    assert rows(quality.predicate_check(users, "mail", F.col("email") != "")) == [("mail", False)]
    assert rows(quality.predicate_check(none, "old", F.col("age") > 0)) == [("old", True)]
    assert rows(quality.not_empty_check(users)) == [("not_empty", True)]
    assert rows(quality.not_empty_check(none)) == [("not_empty", False)]


@pytest.mark.parametrize("sql, passed", [
    ("SELECT true AS a, 1 AS b", True), ("SELECT true AS a, 0 AS b", False),
    ("SELECT true AS a UNION ALL SELECT true", False), ("SELECT true AS a WHERE false", False),
    ("SELECT cast(null AS boolean) AS a", False)])
def test_sql_check(spark, rows, sql, passed):
    assert rows(quality.sql_check(spark, "q", sql)) == [("q", passed)]


def test_required_fields(spark, rows):
    df = spark.createDataFrame([(1, "n", None), (2, "n", "EU"), (3, None, None)],
                               "id int, name string, region string")
    got = quality.required_fields(df, ["id", "name", "region"], "id")
    assert rows(got, "id") == [(1, ["region"], "record 1 missing fields: region"),
                               (3, ["name", "region"], "record 3 missing fields: name, region")]
    assert rows(quality.required_fields(df, ["id", "tier"], "id"), "id")[0][1] == ["tier"]


def test_ordered_checks(spark, rows):
    df = spark.createDataFrame([("ok", 5), ("ok", 6), ("bad", -1), ("bad", 5), ("late", 500)],
                               "asset string, amount int")
    expected = spark.createDataFrame([("ok",), ("bad",), ("late",), ("never",)], "asset string")
    got = quality.ordered_checks(
        df, [("present", F.lit(True), "empty"), ("positive", F.col("amount") > 0, "must be positive"),
             ("small", F.col("amount") < 100, "")], ["asset"], expected)
    status = {(r.asset, r.check): (r.passed, r.status, r.error) for r in got.collect()}
    skipped, after = "not evaluated (flow skipped)", "not evaluated (prior assert failed)"
    assert len(status) == 12
    assert all(status["ok", c] == (True, "passed", None) for c in ("present", "positive", "small"))
    assert status["bad", "present"] == (True, "passed", None)
    assert status["bad", "positive"] == (False, "failed", "must be positive")
    assert status["bad", "small"] == (False, after, None)
    assert status["late", "small"] == (False, "failed", "assertion failed")
    assert all(status["never", c] == (False, skipped, None) for c in ("present", "positive", "small"))


def test_check_kind_takes_the_first_part_that_fits(spark):
    kinds = ["SQL_COLUMN_CHECK", "x.sql_table_check", "sql_check", "my_python_check", "bash", None]
    df = spark.createDataFrame([(k,) for k in kinds], "t string")
    assert [r[0] for r in df.select(quality.check_kind(F.col("t"))).collect()] == [
        "sql_column", "sql_table", "sql_custom", "python", None, None]


def test_parse_check_logs(spark):
    lines = [
        ("r1", "[2024] {SQLColumnCheckOperator} INFO - Task[cols] PASSED for column: email"),
        ("r1", "[2024-01] {SQLColumnCheckOperator} WARNING - Task[cols] failed, column 'age'"),
        ("r1", "{SQLColumnCheckOperator} INFO - Task[cols] passed, column phone"),
        ("r1", "{SQLTableCheckOperator} ERROR - [tab] failed, column 'age' " + "x" * 300),
        ("r1", "{SQLTableCheckOperator} INFO - [tab] failed"),
        ("r1", "{SQLTableCheckOperator} INFO - [other] passed"),
        ("r1", "{BashOperator} INFO - Task[cols] passed, column email"),
        ("r1", "CheckOperator INFO without a task passed"),
        ("r2", "{PythonOperator} INFO - Task[cols] passed"),
        ("r3", "{PythonCheckOperator} INFO - Task[überprüfung] passed"),
    ]
    specs = [("r1", 0, "cols", "sql_column", "users", "email", "null_check"),
             ("r1", 1, "cols", "sql_column", "users", "age", "min"),
             ("r1", 2, "cols", "sql_column", "users", "age", "max"),
             ("r1", 0, "tab", "sql_table", "users", None, "row_count_check"),
             ("r2", 0, "cols", "sql_column", "users", "email", "null_check"),
             ("r2", 1, "py", "python", None, None, None),
             ("r3", 0, "überprüfung", "python", None, None, None)]
    got = quality.parse_check_logs(
        spark.createDataFrame(lines, "run string, line string"),
        spark.createDataFrame(specs, "run string, ord int, source_task string, check_type string, "
                                     "table string, column string, check_name string")).collect()
    found = sorted((r.run, r.source_task, r.check_type, r.column or "", r.check_name or "", r.passed,
                    len(r.log_line or ""), r.note is not None) for r in got)
    assert found == sorted([
        ("r1", "cols", "sql_column", "email", "null_check", True, len(lines[0][1]), False),
        ("r1", "cols", "sql_column", "age", "min", False, len(lines[1][1]), False),
        ("r1", "tab", "sql_table", "", "", False, 200, False),
        ("r2", "cols", "sql_column", "", "", True, 0, True),
        ("r2", "py", "python", "", "", True, 0, True),
        ("r3", "überprüfung", "python", "", "", True, len(lines[9][1]), False)])


@pytest.mark.parametrize("table_ord, column_ord, kind, column", [
    (0, 1, "sql_table", None), (1, 0, "sql_column", "email")])
def test_the_first_check_that_fits_a_line_takes_it(spark, rows, table_ord, column_ord, kind, column):
    lines = spark.createDataFrame(
        [("r", "{SQLCheckOperator} INFO - Task[mixed] passed, column email"),
         ("r", "{SQLCheckOperator} INFO - Task[mixed] passed, column other")], "run string, line string")
    specs = spark.createDataFrame(
        [("r", table_ord, "mixed", "sql_table", "t", None, "rows"),
         ("r", column_ord, "mixed", "sql_column", "t", "email", "null_check")],
        "run string, ord int, source_task string, check_type string, table string, column string, "
        "check_name string")
    got = quality.parse_check_logs(lines, specs).select("log_line", "check_type", "column")
    by_line = {r[0].split()[-1]: (r[1], r[2]) for r in got.collect()}
    assert by_line == {"email": (kind, column), "other": ("sql_table", None)}
