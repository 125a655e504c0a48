"""Every query of the suite against DuckDB's answer on the same tables.

The queries of the training-data part, some of which SQL cannot express, have their own tests.
"""

import os

import pytest

import __spark_entry__ as entry_points
from suite.registry import CHECKS, QUERIES
from tests.compare import connect, differences

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_check(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    assert differences(result, con, CHECKS[name]) == ""


def test_every_query_has_a_check():
    assert QUERIES.keys() == CHECKS.keys()
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert CHECKS.keys() <= entry_points.oracle_sql().keys()


def test_entry_returns_ranked_states(spark):
    found = entry_points.entry(spark)
    assert found.columns == ["i94addr", "sum_count"]
    totals = [r.sum_count for r in found.collect()]
    assert len(totals) == 10 and totals == sorted(totals, reverse=True)
