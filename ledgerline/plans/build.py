"""One run of the star-schema build over the current-state tables: snapshot, marts, checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.scd import SnapshotHistory
from ledgerline.plans.gold import build_gold, gold_violations
from ledgerline.streaming.current import CurrentState


def run_build(
    spark: SparkSession, state: CurrentState, path: str, run: int, run_time: Column | None = None
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Take snapshot number ``run`` of the symbols, rebuild every mart and check them.

    Returns the marts and the violations per check. Readers go on seeing the build before until this one is
    whole. Repeating a run replaces its results.
    """
    symbols = state.read(spark, "symbols").drop("created_at", "updated_at")
    history = SnapshotHistory(spark, f"{path}/symbol_history", "symbol_id", ["status"])
    history.run(run, symbols, F.current_timestamp() if run_time is None else run_time)
    built = build_gold(
        spark,
        state.read(spark, "trades"),
        state.read(spark, "orderbook_levels"),
        state.read(spark, "exchanges"),
        history.history(),
        f"{path}/marts",
        run,
    )
    return built, gold_violations(built)
