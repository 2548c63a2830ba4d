"""Every registered plan against its own DuckDB SQL over the smallest benchmark tables."""

import decimal
import os

import duckdb
import numpy as np
import pytest

from docflow.plans.registry import ORACLES, QUERIES

DATA = os.environ.get("DOCFLOW_TESTDATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no benchmark tables")


def plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, list | tuple | np.ndarray):
        return tuple(plain(x) for x in v)
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_plan_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    found = duck.execute(ORACLES[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(plain(row[names.index(c)]) for c in columns) for row in found.fetchall()), key=repr)
    assert got == want


def test_entry_point(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert len(e.entry(spark).columns) == 41


def test_equal_stages_run_once(spark):
    """The stack summary asks for completed stacks and labels in several places; equal exchanges are shared."""
    df = QUERIES["stack_agg"](spark, DATA)
    df.collect()
    assert "ReusedExchange" in df._jdf.queryExecution().executedPlan().toString()
