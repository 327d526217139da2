"""Every registered query against DuckDB on the same tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from faremill.registry import registered
from tests import oracle

ORACLE_DIR = os.environ.get("TEST_ORACLE_DIR", "/root/testdata/sf0.01")
QUERIES = registered()


@pytest.fixture(scope="module")
def duck():
    con = oracle.connect(ORACLE_DIR)
    yield con
    con.close()


@pytest.mark.parametrize("name", QUERIES)
def test_same_answer(spark, duck, name):
    q = QUERIES[name]
    assert q.sql is not None, "every query has a statement"
    assert oracle.difference(q.run(spark, ORACLE_DIR), duck, q.sql) is None


def test_contract(spark):
    assert set(contract.oracle_sql()) <= set(contract.queries())
    result = contract.entry(spark)
    assert result.columns[:3] == ["pickup_zone", "revenue_month", "service_type"]
    assert result.count() > 0


def test_small_scale(spark, sf_dir):
    """The smallest tables give the same agreement, e.g. where a month has no rows."""
    con = oracle.connect(sf_dir)
    for name in ("monthly_zone_revenue", "ingest_months", "interval_refresh", "stream_tumbling"):
        q = QUERIES[name]
        assert oracle.difference(q.run(spark, sf_dir), con, q.sql) is None, name
