"""Builds that are published whole, and many checks in one pass."""

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from ledgerline.operators import quality as q
from ledgerline.operators.scd import history_from_log
from ledgerline.plans import gold, inputs

LEVELS = "symbol_id bigint, side string, price_level decimal(38,18), quantity decimal(38,18), last_update_id bigint, updated_at timestamp"


@pytest.fixture(scope="module")
def sources(spark):
    history = history_from_log(inputs.status_log(spark, SF), "symbol_id", ["status"], "ts", "event_id")
    trades = inputs.trades(spark, SF).where("trade_id < 200").persist()
    return trades, spark.createDataFrame([], LEVELS), inputs.exchanges(spark, SF), history


def test_readers_see_whole_builds_only(spark, run_dir, sources):
    trades, *others = sources
    first = gold.build_gold(spark, trades, *others, run_dir, 0)
    n = first["fct_trades"].count()
    assert set(first) == set(gold.MARTS) and n == trades.count()
    # A build that died on its way: its trades are there, but it was never published.
    trades.limit(5).write.parquet(f"{run_dir}/run=1/dead/fct_trades")
    assert gold.published_gold(spark, run_dir)["fct_trades"].count() == n
    few = trades.where("trade_id < 50")
    second = gold.build_gold(spark, few, *others, run_dir, 1)
    assert second["fct_trades"].count() == few.count()
    # Who has begun to read the first one can finish.
    assert first["fct_trades"].count() == n
    again = gold.build_gold(spark, few, *others, run_dir, 1)
    assert rows(again["fct_ohlcv_1m"]) == rows(second["fct_ohlcv_1m"])
    gold.build_gold(spark, few, *others, run_dir, 2)
    gold.drop_old_builds(spark, run_dir, keep=2)
    assert gold.finished_versions(spark, run_dir + "/published", "run") == [1, 2]


def test_the_suite_equals_the_single_checks(spark, run_dir, sources):
    marts = gold.build_gold(spark, *sources, run_dir)
    marts["fct_trades"] = marts["fct_trades"].unionByName(marts["fct_trades"].limit(3))
    marts["fct_ohlcv_1m"] = marts["fct_ohlcv_1m"].withColumn("open", F.when(F.minute("bar_minute") % 2 == 0, F.col("high") + 1).otherwise(F.col("open")))
    marts["dim_symbol"] = marts["dim_symbol"].withColumn("is_current", F.col("is_current") & (F.col("symbol_id") % 3 != 0))
    single = q.summarise(gold.gold_checks(marts))
    assert rows(gold.gold_violations(marts), "check_name", "violations") == rows(single, "check_name", "violations")
    assert single.where("violations > 0").count() >= 3


def test_profile(spark):
    data = [(1, "a", 5), (1, "a", None), (2, None, 7), (2, None, 7), (None, "b", 1), (3, "c", 9)]
    df = spark.createDataFrame(data, "k int, s string, v int")
    found = q.profile(
        df,
        {"unique k": ["k"], "unique both": ["k", "s"]},
        {"null v": q.any_null(["v"]), "large": F.col("v") > 6},
        {"one large": (["k"], F.col("v") > 6)},
    )
    want = {"unique k": 2, "unique both": 1, "null v": 1, "large": 3, "one large": 3}
    assert {r.check_name: r.violations for r in found.collect()} == want
    assert {r.violations for r in q.profile(df.limit(0), {"unique k": ["k"]}, {"null v": q.any_null(["v"])}).collect()} == {0}


def test_one_scan_per_mart(spark):
    df = spark.read.parquet(f"{SF}/lineitem.parquet")
    found = q.profile(df, {"a": ["l_orderkey"], "b": ["l_orderkey", "l_linenumber"]}, {"c": q.any_null(["l_tax"])}, {"d": (["l_partkey"], F.col("l_tax") > 0)})
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Python" not in plan
