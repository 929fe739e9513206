"""Every query with an oracle gives exactly the oracle's rows."""

from __future__ import annotations

import pytest

from queries import all_oracles, all_queries
from tests.oracle import compare, connect

QUERIES, ORACLES = all_queries(), all_oracles()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_oracle(name, spark, sf, con):
    assert compare(QUERIES[name](spark, sf), con, ORACLES[name]) == []


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(name, spark, sf):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["snapshot_date", "population", "leavers", "churn_rate"]
