"""Both streams of the pipeline in one session."""

from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import build_session
from ledgerline.sources.log import TOPIC_PREFIX, kafka_log
from ledgerline.streaming.current import CurrentState, start_current
from ledgerline.streaming.landing import start_landing


def run_forever(spark: SparkSession, log: DataFrame, root: str, topic_prefix: str = TOPIC_PREFIX) -> None:
    """Land and fold the log until either query dies; stop the other one and surface the error.

    The two read the log independently and keep separate checkpoints, so each resumes where it
    stopped.
    """
    spark.streams.resetTerminated()
    state = CurrentState(f"{root}/current")
    queries = [
        start_landing(log, f"{root}/landing", f"{root}/checkpoints/landing", None, topic_prefix),
        start_current(log, state, f"{root}/checkpoints/current", None, topic_prefix),
    ]
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for q in queries:
            q.stop()


def run_available(log: DataFrame, root: str, state: CurrentState, name: str = "available") -> None:
    """Work off what has arrived since the last run, in micro-batches, and stop.

    Active queries of a session need different names, hence ``name`` as their prefix.
    """
    once = {"availableNow": True}
    queries = [
        start_landing(
            log, f"{root}/landing", f"{root}/checkpoints/landing", once, name=f"{name} landing"
        ),
        start_current(log, state, f"{root}/checkpoints/current", once, name=f"{name} current"),
    ]
    for q in queries:
        q.awaitTermination()


def main() -> None:
    """``spark-submit -m ledgerline.streaming.run --bootstrap-servers ... --root ...``"""
    args = argparse.ArgumentParser(description="Land and fold a change log until stopped.")
    args.add_argument("--bootstrap-servers", required=True)
    args.add_argument("--root", required=True, help="folder for tables and checkpoints, reachable by all executors")
    args.add_argument("--topic-prefix", default=TOPIC_PREFIX)
    args.add_argument("--starting-offsets", default=os.getenv("STARTING_OFFSETS", "earliest"))
    args.add_argument("--max-per-trigger", type=int, default=None)
    a = args.parse_args()
    spark = build_session("ledgerline-streams")
    log = kafka_log(spark, a.bootstrap_servers, a.topic_prefix, a.starting_offsets, a.max_per_trigger)
    run_forever(spark, log, a.root, a.topic_prefix)


if __name__ == "__main__":
    main()
