"""Data-quality checks. Those on a table share one scan and one aggregate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import checkpoint

# How a check that never ran is reported.
NOT_EVALUATED = "not evaluated (prior assert failed)"
SKIPPED = "not evaluated (flow skipped)"
DEFAULT_MESSAGE = "assertion failed"
DEFAULT_NOTE = "Default result - could not parse from logs"

# Comparator names of check bounds.
_COMPARE = {
    "equals": lambda x, bound: x == bound,
    "greater_than": lambda x, bound: x > bound,
    "greater_than_or_equal": lambda x, bound: x >= bound,
    "less_than": lambda x, bound: x < bound,
    "less_than_or_equal": lambda x, bound: x <= bound,
}

# Kinds of check, matched in this order inside an operator type.
CHECK_KINDS = {
    "sql_column_check": "sql_column",
    "sql_table_check": "sql_table",
    "sql_check": "sql_custom",
    "python_check": "python",
}
# Kinds whose results name no column.
TASK_KINDS = ("sql_table", "sql_custom", "python")

# Formats of check results in a run log.
CHECK_LINE = "CheckOperator"
TASK_IN_LINE = r"(?U)Task\[(\w+)\]"
BRACKET_IN_LINE = r"(?U)\[(\w+)\]"
COLUMN_IN_LINE = r"""(?iU)column[:\s]+['"]*(\w+)['"]*"""
LINE_LENGTH = 200


def check_kind(operator_type: Column) -> Column:
    """Kind of a check operator type, null when it is not a check."""
    lowered = F.lower(operator_type)
    return F.coalesce(*[F.when(lowered.contains(part), F.lit(kind))
                        for part, kind in CHECK_KINDS.items()])


def _measure(kind: str, column: str) -> Column:
    c = F.col(column)
    if kind == "null_check":
        return F.count_if(c.isNull())
    if kind == "min":
        return F.min(c)
    if kind == "max":
        return F.max(c)
    raise ValueError(f"unknown column check {kind!r}")


def _all_differ(df: DataFrame, column: str) -> DataFrame:
    """One row: 1 if no value stands in two rows, else 0."""
    counts = df.select(F.col(column).alias("value")).filter("value IS NOT NULL").groupBy("value").agg(
        F.count(F.lit(1)).alias("n"))
    return counts.agg((F.coalesce(F.max("n"), F.lit(1)) == 1).cast("int").alias("differ"))


def _holds(observed: Column, bounds: dict) -> Column:
    tests = []
    for name, bound in bounds.items():
        if name not in _COMPARE:
            raise ValueError(f"unknown comparator {name!r}")
        bound = bound if isinstance(bound, Column) else F.lit(bound)
        tests.append(_COMPARE[name](observed, bound))
    return F.coalesce(reduce(lambda a, b: a & b, tests), F.lit(False))


def run_checks(df: DataFrame, columns: dict[str, dict[str, dict]] | None = None,
               table: dict[str, dict] | None = None) -> DataFrame:
    """Column and table checks of one table as one row per check.

    ``columns`` maps a column to its checks (``null_check``, ``unique_check``,
    ``min``, ``max``), ``table`` maps a check to bounds on the row count. Bounds
    on one check must all hold; a bound is a value or a Column. ``unique_check``
    is 1 when all non-null values differ, else 0. A check on an empty column
    has nothing to observe and fails.

    All checks but ``unique_check`` share one scan and one aggregate. Each ``unique_check``
    reads its column alone: rows are counted per value, in each task first, and the largest
    count decides. So no row is copied for each column, and a frequent value is one row a task.
    """
    specs = [(f"{column}_{kind}", column, kind, None if kind == "unique_check" else _measure(kind, column), bounds)
             for column, checks in (columns or {}).items() for kind, bounds in checks.items()]
    specs += [(name, None, name, F.count(F.lit(1)), bounds)
              for name, bounds in (table or {}).items()]
    if not specs:
        raise ValueError("no checks given")
    shared = [m.alias(f"m{i}") for i, (_, _, _, m, _) in enumerate(specs) if m is not None]
    parts = [df.agg(*shared)] if shared else []
    parts += [_all_differ(df, column).withColumnRenamed("differ", f"m{i}")
              for i, (_, column, _, m, _) in enumerate(specs) if m is None]
    # one row each, put side by side
    measured = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    if len(parts) > 1:
        measured = measured.agg(*[F.first(c, ignorenulls=True).alias(c) for c in measured.columns])
    rows = [F.struct(F.lit(name).alias("check"), F.lit(column).cast("string").alias("column"),
                     F.lit(kind).alias("kind"), F.col(f"m{i}").cast("string").alias("observed"),
                     _holds(F.col(f"m{i}"), bounds).alias("passed"))
            for i, (name, column, kind, _, bounds) in enumerate(specs)]
    return measured.select(F.inline(F.array(*rows)))


def column_checks(df: DataFrame, mapping: dict[str, dict[str, dict]]) -> DataFrame:
    return run_checks(df, columns=mapping)


def table_checks(df: DataFrame, checks: dict[str, dict]) -> DataFrame:
    return run_checks(df, table=checks)


def sql_check(spark: SparkSession, name: str, sql: str) -> DataFrame:
    """Passes when the query gives exactly one row and all its values are true."""
    result = spark.sql(sql)
    all_true = reduce(lambda a, b: a & b,
                      [F.coalesce(F.col(f"`{c}`").cast("boolean"), F.lit(False))
                       for c in result.columns])
    return result.agg(((F.count(F.lit(1)) == 1) & F.coalesce(F.every(all_true), F.lit(False)))
                      .alias("passed")).select(F.lit(name).alias("check"), "passed")


def predicate_check(df: DataFrame, name: str, predicate: Column) -> DataFrame:
    """Passes when the predicate holds for every row, also on empty input."""
    holds = F.every(F.coalesce(predicate, F.lit(False)))
    return df.agg(F.coalesce(holds, F.lit(True)).alias("passed")).select(
        F.lit(name).alias("check"), "passed")


def not_empty_check(df: DataFrame, name: str = "not_empty") -> DataFrame:
    """Passes when there is a row; reads no more than it needs to find one."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("passed")).select(
        F.lit(name).alias("check"), "passed")


def required_fields(df: DataFrame, fields: list[str], key: str) -> DataFrame:
    """Records that lack a required field (no such column, or null), with a message."""
    lacks = [F.when(F.col(f).isNull() if f in df.columns else F.lit(True), F.lit(f))
             for f in sorted(fields)]
    missing = F.array_compact(F.array(*lacks))
    return with_missing_message(df.select(key, missing.alias("missing")), key)


def with_missing_message(df: DataFrame, key: str, missing: str = "missing") -> DataFrame:
    """Keep rows with missing fields and say which."""
    return df.filter(F.size(missing) > 0).withColumn(
        "error", F.concat(F.lit("record "), F.col(key).cast("string"),
                          F.lit(" missing fields: "), F.array_join(missing, ", ")))


def required_in_variant(df: DataFrame, record: str, fields: list[str]) -> DataFrame:
    """Adds ``missing`` and ``nulls``: required fields that a VARIANT record does not have, or has as null.

    A null record has none of them.
    """
    value = lambda f: F.try_variant_get(F.col(record), f"$.{f}", "variant")
    named = lambda test: F.array_compact(F.array(*[F.when(test(value(f)), F.lit(f)) for f in fields]))
    return df.withColumns({"missing": named(lambda v: v.isNull()), "nulls": named(lambda v: F.is_variant_null(v))})


def ordered_checks(df: DataFrame, checks: list[tuple[str, Column, str]], by: list[str],
                   expected: DataFrame | None = None) -> DataFrame:
    """Ordered assertions per group, reported as if they stopped at the first failure.

    Checks before the failing one passed, the failing one carries its message,
    later ones are not evaluated. Groups of ``expected`` without any row did
    not run at all. Every predicate is in fact evaluated, in one aggregate, so
    predicates must not raise (use ``try_`` functions).
    """
    holds = [F.every(F.coalesce(pred, F.lit(False))).alias(f"_c{i}")
             for i, (_, pred, _) in enumerate(checks)]
    ran = df.groupBy(*by).agg(*holds).withColumn("_ran", F.lit(True))
    if expected is not None:
        ran = expected.select(*by).distinct().join(ran, by, "left")
    outcomes = F.array(*[F.col(f"_c{i}") for i in range(len(checks))])
    with_first = ran.withColumn("_first", F.array_position(outcomes, F.lit(False)))
    rows = []
    for i, (name, _, message) in enumerate(checks, start=1):
        reached = (F.col("_first") == 0) | (F.col("_first") >= i)
        fails = F.col("_first") == i
        status = (F.when(F.col("_ran").isNull(), F.lit(SKIPPED))
                  .when(fails, F.lit("failed")).when(reached, F.lit("passed"))
                  .otherwise(F.lit(NOT_EVALUATED)))
        rows.append(F.struct(
            F.lit(i).alias("ord"), F.lit(name).alias("check"),
            (status == "passed").alias("passed"), status.alias("status"),
            F.when(fails, F.lit(message or DEFAULT_MESSAGE)).alias("error")))
    return with_first.select(*by, F.inline(F.array(*rows)))


def parse_check_logs(lines: DataFrame, specs: DataFrame, line: str = "line",
                     run: str = "run") -> DataFrame:
    """Check results found in run logs, one row per result.

    ``lines(run, line)`` are log lines; ``specs(run, ord, source_task,
    check_type, table, column, check_name)`` are the checks each run should
    report. A result goes to the first check of its task, in order, whose column
    the line names or which has no column. A run without any result gives one
    default row per check, passed, with a note.

    The checks are first reduced to the first one per task and column and the
    first one per task without a column; a line joins both and takes the earlier.
    Log lines are filtered and parsed where they are read and never grouped.
    This runs when called, not lazily.
    """
    text = F.col(line)
    task = F.regexp_extract(text, TASK_IN_LINE, 1)
    lowered = F.lower(text)
    passed = (text.contains(" INFO ") & lowered.contains("passed"))
    failed = ((text.contains(" ERROR ") | text.contains(" WARNING ")) & lowered.contains("failed"))
    # a generator evaluates the expressions once, where a projection would be merged
    # into every filter and join that uses its columns
    parsed = F.array(F.struct(
        F.coalesce(F.nullif(task, F.lit("")),
                   F.regexp_extract(text, BRACKET_IN_LINE, 1)).alias("source_task"),
        passed.alias("passed"),
        F.regexp_extract(text, COLUMN_IN_LINE, 1).alias("_column")))
    found = (lines.filter(text.contains(CHECK_LINE) & (passed | failed))
             .select(run, line, F.inline(parsed)).filter(F.col("source_task") != ""))
    spec = F.struct("ord", "check_type", "table", "column", "check_name")
    task_key = [run, "source_task"]
    by_column = (specs.filter(F.col("column").isNotNull())
                 .groupBy(*task_key, F.col("column").alias("_column"))
                 .agg(F.min_by(spec, "ord").alias("_named")))
    by_task = (specs.filter(F.col("check_type").isin(*TASK_KINDS)).groupBy(*task_key)
               .agg(F.min_by(spec, "ord").alias("_general")))
    named = F.col("_named.ord").isNotNull() & (
        F.col("_general.ord").isNull() | (F.col("_named.ord") <= F.col("_general.ord")))
    results = (found.join(by_column, [*task_key, "_column"], "left")
               .join(by_task, task_key, "left")
               .filter(F.col("_named.ord").isNotNull() | F.col("_general.ord").isNotNull())
               .select(*task_key,
                       F.when(named, F.col("_named.check_type"))
                       .otherwise(F.col("_general.check_type")).alias("check_type"),
                       *[F.when(named, F.col(f"_named.{c}")).alias(c)
                         for c in ("table", "column", "check_name")],
                       "passed", F.substring(text, 1, LINE_LENGTH).alias("log_line"),
                       F.lit(None).cast("string").alias("note")))
    # results are few next to the lines; writing them once saves a second pass over all logs
    results = checkpoint(results)
    silent = specs.join(results.select(run).distinct(), run, "left_anti")
    nothing = F.lit(None).cast("string")
    defaults = silent.select(
        run, "source_task", "check_type", nothing.alias("table"), nothing.alias("column"),
        nothing.alias("check_name"), F.lit(True).alias("passed"),
        nothing.alias("log_line"), F.lit(DEFAULT_NOTE).alias("note"))
    return results.unionByName(defaults)
