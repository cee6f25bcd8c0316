"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_twin():
    """But for training-data queries, which have tests of their own where SQL falls short."""
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry.queries()) - set(entry.LLM_QUERIES) <= set(entry.oracle_sql())


USES_PYTHON = {"synth_posts"}


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "InPandas"):
        assert node not in plan
    assert ("EvalPython" in plan) == (name in USES_PYTHON)
    assert difference(con, df, entry.oracle_sql()[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
