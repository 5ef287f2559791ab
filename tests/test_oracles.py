"""Every registered query against its SQL in DuckDB."""

import pytest
from conftest import SF

import __spark_entry__ as registered
from compare import compare, connect
from ledgerline.plans.registry import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


def test_all_sql_is_of_a_query():
    assert ORACLES.keys() == QUERIES.keys()
    assert registered.oracle_sql().keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, name, QUERIES[name], ORACLES[name], SF) is None


def test_entry(spark):
    bars = registered.entry(spark)
    assert {"symbol_id", "bar_hour", "open", "close"} <= set(bars.columns)
    assert not bars.isEmpty()
