"""Every registered query next to its SQL, on whole tables."""

import json
import os
import subprocess
import sys

import pytest

from millrace.plans import QUERIES, SQL
from tests.oracle import compare, connect


@pytest.fixture(scope="module")
def duck(data):
    return connect(data)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, data, name):
    problems = [p for p in compare(spark, duck, name, data) if p != "no rows"]
    assert problems == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_rows_only(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_entry(spark):
    import __spark_entry__ as contract
    assert contract.entry(spark).count() > 0
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_bench_runs_from_another_folder(data, tmp_path):
    """Nothing on the Python path: user functions must reach the workers by themselves."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    env.update(BENCH_SF_DIR=data, BENCH_CPUS="2")
    bench = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "bench.py")
    names = ["agg_totals", "udf_extract_article", "udf_score_batches"]
    done = subprocess.run([sys.executable, bench, *names], cwd=tmp_path, env=env, check=True,
                          capture_output=True, text=True, timeout=300)
    line, = done.stdout.strip().splitlines()
    result = json.loads(line)
    assert list(result["queries"]) == names and result["unit"] == "sec"
    assert result["value"] == pytest.approx(sum(result["queries"].values()))
