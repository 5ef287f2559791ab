"""Plan shapes that must hold whatever the size of the tables."""

import re

import pytest
from conftest import SF

from ledgerline.plans import queries_book, queries_dims, queries_log, queries_market, queries_streams  # noqa: F401
from ledgerline.plans.registry import QUERIES
from ledgerline.sources.tables import table

# These run streams or write tables while being called; their parts are checked through the others.
EAGER = {
    "bronze_append",
    "bronze_fanout_counts",
    "silver_rebuild_from_bronze",
    "cdc_stream_ingest",
    "book_current_state_stream",
    "book_state_store_stream",
    "book_partitioned_stream",
    "symbols_current",
    "exchanges_current",
    "trades_current_stream",
    "cdc_stream_outcomes",
    "bronze_tables",
    "dedup_trades_stream",
    "ohlcv_1m_stream",
    "book_version_guard",
    "scd2_snapshot_incremental",
    "gold_build_rowcounts",
    "dq_gold_suite",
    # Sweeps versions in Python; its pieces are tested by themselves.
    "book_top_n_diff",
}
LAZY = sorted(set(QUERIES) - EAGER)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_pairing_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan


@pytest.mark.parametrize("name", LAZY)
def test_only_aggregates_meet_in_one_task(spark, name):
    """A single-partition exchange may carry partial aggregates, never rows."""
    lines = plan_of(QUERIES[name](spark, SF)).splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate" in lines[i + 1]


@pytest.mark.parametrize("name", ["book_top_n", "latest_per_key_versioned", "latest_per_key_offset"])
def test_ranked_groups_are_cut_before_the_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert re.search(r"WindowGroupLimit.*Partial", plan)


@pytest.mark.parametrize("name", ["ohlcv_1m", "book_best_quote", "dq_unique", "dq_unique_trade", "dim_date"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    assert "partial_" in plan_of(QUERIES[name](spark, SF))


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["dq_unique"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int>" in plan


def test_symbol_filter_reaches_the_scan(spark):
    """The filter on the bars' symbol is applied below the aggregate, to the trades themselves."""
    from ledgerline.plans import marts
    from pyspark.sql import functions as F

    trades = table(spark, SF, "lineitem").select(
        F.col("l_orderkey").alias("trade_id"),
        F.col("l_suppkey").alias("symbol_id"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_tax").alias("quote_qty"),
        F.col("l_shipdate").alias("trade_time"),
    )
    plan = plan_of(marts.latest_bars(marts.ohlcv(trades), "bar_minute", 3))
    assert "EqualTo(l_suppkey,3)" in plan and "TakeOrderedAndProject" in plan
