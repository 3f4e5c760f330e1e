"""Every registered query against its SQL on the smallest tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402
from check_queries import differences  # noqa: E402

from reedbed.plans import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for file in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(file)[:-8]} AS SELECT * FROM '{file}'")
    return con


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    assert set(QUERIES) == set(ORACLES) and len(QUERIES) == 142
    assert contract.entry(spark).columns == ["species", "count", "percentage"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, sf_dir, db, name):
    df = contract.queries()[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    # No pair of rows is made without a key, and no row goes to Python one by one.
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython"):
        assert step not in plan
    assert differences(df, [tuple(r) for r in df.collect()], db, ORACLES[name]) == []
