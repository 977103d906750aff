"""Every registered query against its SQL, and the entry point."""

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from tripspot.plans.reports import formatted_plan
from tripspot.registry import QUERIES as TRIPS

# The corpus queries have tests of their own.
QUERIES, ORACLES = TRIPS, entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, con, name):
    result = QUERIES[name](spark, sf)
    plan = formatted_plan(result)
    assert not [node for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython") if node in plan]
    assert compare(result, con, ORACLES[name]) == ""


def test_every_query_has_sql():
    assert set(QUERIES) <= set(ORACLES) and set(QUERIES) <= set(entry.queries())


def test_entry(spark, sf):
    result = entry.entry(spark)
    assert result.count() > 0 and "hotspot_score" in result.columns
