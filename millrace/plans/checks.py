"""Data-quality checks on the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.text import missing_keys
from millrace.operators import quality
from millrace.plans.registry import query
from millrace.plans.tables import EVENT_TYPES


@query("dq_column_checks", """
WITH m AS (
  SELECT count(*) FILTER (WHERE c_name IS NULL) AS nulls,
         CASE WHEN count(c_name) = count(DISTINCT c_name) THEN 1 ELSE 0 END AS names,
         CASE WHEN count(c_mktsegment) = count(DISTINCT c_mktsegment) THEN 1 ELSE 0 END AS segments,
         min(c_acctbal) AS lo, max(c_acctbal) AS hi
  FROM customer)
SELECT 'c_name_null_check' AS "check", 'c_name' AS "column", 'null_check' AS kind,
       CAST(nulls AS VARCHAR) AS observed, nulls = 0 AS passed FROM m
UNION ALL SELECT 'c_name_unique_check', 'c_name', 'unique_check', CAST(names AS VARCHAR), names = 1
FROM m
UNION ALL SELECT 'c_mktsegment_unique_check', 'c_mktsegment', 'unique_check',
       CAST(segments AS VARCHAR), segments = 1 FROM m
UNION ALL SELECT 'c_acctbal_min', 'c_acctbal', 'min', CAST(lo AS VARCHAR), lo > -1000 FROM m
UNION ALL SELECT 'c_acctbal_max', 'c_acctbal', 'max', CAST(hi AS VARCHAR),
       hi > 0 AND hi <= 9000 FROM m""")
def dq_column_checks(t):
    return quality.column_checks(t.customer, {
        "c_name": {"null_check": {"equals": 0}, "unique_check": {"equals": 1}},
        "c_mktsegment": {"unique_check": {"equals": 1}},
        "c_acctbal": {"min": {"greater_than": -1000},
                      "max": {"greater_than": 0, "less_than_or_equal": F.lit(9000)}}})


@query("dq_table_checks", """
WITH m AS (SELECT count(*) AS n FROM customer)
SELECT 'row_count_check' AS "check", CAST(NULL AS VARCHAR) AS "column",
       'row_count_check' AS kind, CAST(n AS VARCHAR) AS observed, n > 0 AS passed FROM m
UNION ALL SELECT 'row_count_range', NULL, 'row_count_range', CAST(n AS VARCHAR),
       n > 100 AND n < 10000000 FROM m""")
def dq_table_checks(t):
    return quality.table_checks(t.customer, {
        "row_count_check": {"greater_than": 0},
        "row_count_range": {"greater_than": 100, "less_than": 10000000}})


@query("dq_sql_check", """
SELECT 'orders_sane' AS "check", min(o_totalprice) > 0 AND count(*) > 0 AS passed FROM orders
UNION ALL SELECT 'orders_small', max(o_totalprice) < 1000 FROM orders""")
def dq_sql_check(t):
    t.orders.createOrReplaceTempView("millrace_orders")
    sane = quality.sql_check(t.spark, "orders_sane", """
        SELECT min(o_totalprice) > 0 AS positive, count(*) > 0 AS filled FROM millrace_orders""")
    small = quality.sql_check(t.spark, "orders_small", """
        SELECT max(o_totalprice) < 1000 AS small FROM millrace_orders""")
    return sane.unionByName(small)


@query("dq_predicate_check", """
SELECT 'all_positive' AS "check", bool_and(o_totalprice > 0) AS passed FROM orders
UNION ALL SELECT 'all_large', bool_and(o_totalprice > 50000) FROM orders""")
def dq_predicate_check(t):
    positive = quality.predicate_check(t.orders, "all_positive", F.col("o_totalprice") > 0)
    return positive.unionByName(
        quality.predicate_check(t.orders, "all_large", F.col("o_totalprice") > 50000))


@query("dq_not_empty", """
SELECT 'orders' AS "check", count(*) > 0 AS passed FROM orders
UNION ALL SELECT 'free_orders', count(*) > 0 FROM orders WHERE o_totalprice = 0""")
def dq_not_empty(t):
    return quality.not_empty_check(t.orders, "orders").unionByName(
        quality.not_empty_check(t.orders.filter("o_totalprice = 0"), "free_orders"))


@query("dq_required_fields", """
SELECT doc_id, 'quality, toxic' AS missing,
       'record ' || doc_id || ' missing fields: quality, toxic' AS error
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)""")
def dq_required_fields(t):
    """Documents as JSON objects; one without labels has no such keys."""
    fields = ["doc_id", "lang", "source", "quality", "toxic"]
    labelled = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    as_json = labelled.select("doc_id", F.to_json(F.struct(*fields)).alias("record"))
    missing = as_json.select("doc_id", missing_keys(F.col("record"), fields).alias("missing"))
    return quality.with_missing_message(missing, "doc_id").withColumn(
        "missing", F.array_join("missing", ", "))


@query("dq_required_fields_columns", """
SELECT doc_id, concat_ws(', ', 'owner', CASE WHEN quality IS NULL THEN 'quality' END) AS missing
FROM documents LEFT JOIN labels USING (doc_id)""")
def dq_required_fields_columns(t):
    labelled = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    found = quality.required_fields(labelled, ["doc_id", "lang", "quality", "owner"], "doc_id")
    return found.select("doc_id", F.array_join("missing", ", ").alias("missing"))


@query("dq_ordered_checks", """
WITH statuses(o_orderstatus) AS (VALUES ('F'), ('O'), ('P'), ('X')),
m AS (
  SELECT o_orderstatus, bool_and(o_totalprice > 0) AS c1,
         bool_and(o_orderpriority <> '5-LOW' OR o_orderstatus <> 'O') AS c2,
         bool_and(o_totalprice < 100000) AS c3, TRUE AS ran
  FROM orders GROUP BY o_orderstatus),
j AS (SELECT * FROM statuses LEFT JOIN m USING (o_orderstatus)),
r AS (
  SELECT o_orderstatus, 1 AS ord, 'positive' AS "check",
         CASE WHEN ran IS NULL THEN 'not evaluated (flow skipped)'
              WHEN c1 THEN 'passed' ELSE 'failed' END AS status,
         CASE WHEN NOT c1 THEN 'all amounts must be positive' END AS error FROM j
  UNION ALL
  SELECT o_orderstatus, 2, 'open_urgent',
         CASE WHEN ran IS NULL THEN 'not evaluated (flow skipped)'
              WHEN NOT c1 THEN 'not evaluated (prior assert failed)'
              WHEN c2 THEN 'passed' ELSE 'failed' END,
         CASE WHEN c1 AND NOT c2 THEN 'open orders must not be low priority' END FROM j
  UNION ALL
  SELECT o_orderstatus, 3, 'small',
         CASE WHEN ran IS NULL THEN 'not evaluated (flow skipped)'
              WHEN NOT (c1 AND c2) THEN 'not evaluated (prior assert failed)'
              WHEN c3 THEN 'passed' ELSE 'failed' END,
         CASE WHEN c1 AND c2 AND NOT c3 THEN 'assertion failed' END FROM j)
SELECT o_orderstatus, ord, "check", status = 'passed' AS passed, status, error FROM r""")
def dq_ordered_checks(t):
    expected = t.spark.createDataFrame([("F",), ("O",), ("P",), ("X",)], "o_orderstatus string")
    return quality.ordered_checks(t.orders, [
        ("positive", F.col("o_totalprice") > 0, "all amounts must be positive"),
        ("open_urgent", (F.col("o_orderpriority") != "5-LOW") | (F.col("o_orderstatus") != "O"),
         "open orders must not be low priority"),
        ("small", F.col("o_totalprice") < 100000, ""),
    ], by=["o_orderstatus"], expected=expected)


CHECK_SPECS = [
    (0, "validate_columns", "sql_column", "users", "email", "null_check"),
    (1, "validate_columns", "sql_column", "users", "age", "min"),
    (2, "validate_columns", "sql_column", "users", "age", "max"),
    (3, "validate_table", "sql_table", "users", None, "row_count_check"),
]
RUN_SPECS_SQL = ",\n".join(
    f"({o}, '{task}', '{kind}', '{table}', {repr(column) if column else 'NULL'}, '{name}')"
    for o, task, kind, table, column, name in CHECK_SPECS)


def check_logs(t):
    """A log line per event: what it says depends on the event, a run is an event type."""
    kind = F.col("event_type")
    stamp = F.concat(F.lit("["), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("] "))
    text = (F.when(kind == "view", "{SQLColumnCheckOperator} INFO - Task[validate_columns] "
                                   "check passed, column 'email' value ")
            .when(kind == "purchase", "{SQLColumnCheckOperator} ERROR - Task[validate_columns] "
                                      "check FAILED, Column: age value ")
            .when(kind == "click", "{SQLTableCheckOperator} WARNING - [validate_table] "
                                   "rows failed with ")
            .when(kind == "signup", "{PythonOperator} INFO - Task[validate_columns] passed ")
            .otherwise("{SQLColumnCheckOperator} INFO - Task[validate_columns] passed, "
                       "column 'phone' "))
    return t.events.select(
        F.concat(F.lit("run_"), kind).alias("run"),
        F.concat(stamp, text, F.col("event_id").cast("string"), F.repeat(F.lit(" ."), F.lit(100)))
        .alias("line"))


@query("dq_parse_check_logs", r"""
WITH lines AS (
  SELECT 'run_' || event_type AS run, '[' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '] ' ||
    CASE event_type
      WHEN 'view' THEN '{SQLColumnCheckOperator} INFO - Task[validate_columns] check passed, column ''email'' value '
      WHEN 'purchase' THEN '{SQLColumnCheckOperator} ERROR - Task[validate_columns] check FAILED, Column: age value '
      WHEN 'click' THEN '{SQLTableCheckOperator} WARNING - [validate_table] rows failed with '
      WHEN 'signup' THEN '{PythonOperator} INFO - Task[validate_columns] passed '
      ELSE '{SQLColumnCheckOperator} INFO - Task[validate_columns] passed, column ''phone'' '
    END || event_id || repeat(' .', 100) AS line
  FROM events),
specs(ord, source_task, check_type, tbl, col, check_name) AS (VALUES """ + RUN_SPECS_SQL + r"""),
parsed AS (
  SELECT row_number() OVER () AS line_id, run, line,
         CASE WHEN regexp_matches(line, 'Task\[(\w+)\]') THEN regexp_extract(line, 'Task\[(\w+)\]', 1)
              ELSE regexp_extract(line, '\[(\w+)\]', 1) END AS source_task,
         CASE WHEN contains(line, ' INFO ') AND contains(lower(line), 'passed') THEN TRUE
              WHEN (contains(line, ' ERROR ') OR contains(line, ' WARNING '))
                   AND contains(lower(line), 'failed') THEN FALSE END AS passed,
         regexp_extract(line, '(?i)column[:\s]+[''"]*(\w+)[''"]*', 1) AS named
  FROM lines WHERE contains(line, 'CheckOperator')),
results AS (
  SELECT run, source_task, check_type, CASE WHEN col = named THEN tbl END AS "table",
         CASE WHEN col = named THEN col END AS "column",
         CASE WHEN col = named THEN check_name END AS check_name, passed,
         substr(line, 1, 200) AS log_line, CAST(NULL AS VARCHAR) AS note
  FROM parsed JOIN specs USING (source_task)
  WHERE passed IS NOT NULL
    AND (coalesce(col = named, FALSE) OR check_type IN ('sql_table', 'sql_custom', 'python'))
  QUALIFY row_number() OVER (PARTITION BY line_id ORDER BY ord) = 1)
SELECT * FROM results
UNION ALL
SELECT run, source_task, check_type, NULL, NULL, NULL, TRUE, NULL,
       'Default result - could not parse from logs'
FROM (SELECT DISTINCT run FROM lines) r, specs
WHERE run NOT IN (SELECT run FROM results)""")
def dq_parse_check_logs(t):
    specs = t.spark.createDataFrame(
        [(f"run_{kind}", *spec) for kind in EVENT_TYPES for spec in CHECK_SPECS],
        "run string, ord int, source_task string, check_type string, table string, "
        "column string, check_name string")
    return quality.parse_check_logs(check_logs(t), specs)
