"""Runs queries next to their SQL in DuckDB and compares whole results."""

from __future__ import annotations

import math
import sys
import time

import duckdb

from millrace.plans import QUERIES, SQL
from millrace.plans.tables import TABLES


def connect(folder: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    return value


def _sorted(rows):
    return sorted((tuple(_plain(v) for v in row) for row in rows),
                  key=lambda row: [(v is None, str(type(v)), v if v is not None else 0)
                                   for v in row])


TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "boolean": "BOOLEAN"}


def compare(spark, con, name: str, folder: str) -> list[str]:
    """What differs between the query and its SQL; nothing when they agree."""
    got = QUERIES[name](spark, folder)
    columns = sorted(got.columns)
    expected = con.execute(SQL[name])
    described = [(d[0], str(d[1])) for d in expected.description]
    rows = expected.fetchall()
    names = [d[0] for d in described]
    if sorted(names) != columns:
        return [f"columns {columns} and {sorted(names)}"]
    problems = []
    types = {f.name: f.dataType.simpleString() for f in got.schema.fields}
    for column, kind in described:
        if TYPES.get(types[column]) != kind:
            problems.append(f"type of {column}: {types[column]} and {kind}")
    picked = [names.index(c) for c in columns]
    theirs = _sorted([tuple(r[i] for i in picked) for r in rows])
    ours = _sorted([tuple(r) for r in got.select(*[f"`{c}`" for c in columns]).collect()])
    if len(ours) != len(theirs):
        problems.append(f"{len(ours)} rows and {len(theirs)}")
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        problems.append(f"{len(different)} rows differ, first {columns} {different[0]}")
    if not ours:
        problems.append("no rows")
    return problems


if __name__ == "__main__":
    from millrace.session import build_session

    data = sys.argv[1]
    chosen = sys.argv[2:] or list(QUERIES)
    session = build_session("oracle", "local[8]", {"spark.sql.shuffle.partitions": "8",
                                                   "spark.ui.enabled": "false",
                                                   "spark.driver.memory": "8g"})
    session.sparkContext.setLogLevel("ERROR")
    duck = connect(data)
    bad = 0
    for key in chosen:
        began = time.time()
        try:
            if key in SQL:
                found = compare(session, duck, key, data)
            else:
                found = [] if QUERIES[key](session, data).count() else ["no rows"]
        except Exception as error:  # noqa: BLE001
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        bad += bool(found)
        print("BAD" if found else "ok ", key, f"{time.time() - began:.1f}s", *found, flush=True)
    print(f"{len(chosen)} queries, {bad} bad")
