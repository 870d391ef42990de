"""Every registered query against its SQL, and the shape of its plan."""

import pytest

import __spark_entry__ as entry_points
from compare import connect, differences
from forgemart.checks import CASES

QUERIES = {name: query for name, query in entry_points.queries().items() if name in CASES}
ORACLES = {name: text for name, text in entry_points.oracle_sql().items() if name in CASES}
NEVER_PLANNED = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas")


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in NEVER_PLANNED if node in plan]
    assert differences(df, duck, ORACLES[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() == 25
