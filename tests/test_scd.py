import datetime as dt
import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators.scd import SnapshotHistory, history_from_log, snapshot_step, symbol_dimension

SRC = "symbol_id bigint, status string, tick int"


def day(n):
    return F.lit(dt.datetime(2024, 1, n)).cast("timestamp_ntz")


def source(spark, *data):
    return spark.createDataFrame(list(data), SRC)


def history_of(spark, path, *runs):
    h = SnapshotHistory(spark, path, "symbol_id", ["status"])
    for n, data in enumerate(runs):
        h.run(n, source(spark, *data), day(n + 1))
    return h


def shape(df):
    d = lambda c: F.dayofmonth(c).alias(c)
    return rows(df, "symbol_id", "status", "tick", d("valid_from"), d("valid_to"))


def test_snapshot_runs(spark, run_dir):
    """New, changed, unchanged with another attribute changed, vanished, and changed from NULL."""
    h = history_of(
        spark,
        run_dir,
        [(1, "A", 1), (2, "A", 1), (3, "A", 1), (4, None, 1)],
        [(1, "B", 2), (2, "A", 9), (4, "A", 1), (5, "A", 1)],
        [(1, "A", 3), (2, "A", 9), (4, "A", 1), (5, "A", 1)],
    )
    assert set(shape(h.history())) == {
        (1, "A", 1, 1, 2),
        (1, "B", 2, 2, 3),
        (1, "A", 3, 3, None),
        (2, "A", 1, 1, None),
        (3, "A", 1, 1, None),
        (4, None, 1, 1, 2),
        (4, "A", 1, 2, None),
        (5, "A", 1, 2, None),
    }


def test_repeating_a_run_changes_nothing(spark, run_dir):
    h = history_of(spark, run_dir, [(1, "A", 1)], [(1, "B", 1), (2, "A", 1)])
    before = shape(h.history())
    h.run(1, source(spark, (1, "B", 1), (2, "A", 1)), day(2))
    assert shape(h.history()) == before


def test_snapshot_step_on_real_timestamps(spark):
    current = spark.createDataFrame([(1, "A", 1, dt.datetime(2024, 1, 1))], SRC + ", valid_from timestamp")
    step = snapshot_step(current, source(spark, (1, "B", 1)), "symbol_id", ["status"], F.lit(dt.datetime(2024, 1, 2)))
    assert rows(step, "status", "state") == [("A", "closed"), ("B", "open")]


@pytest.mark.parametrize("width", [1, 4, 1_000_000])
def test_history_from_log_equals_plain_windows(spark, width):
    rng = random.Random(3)
    log = spark.createDataFrame(
        [(rng.choice([1, 1, 1, 2]), rng.choice(["A", "B", None]), i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=i)) for i in range(80)],
        "symbol_id bigint, status string, event_id bigint, ts timestamp_ntz",
    )
    w = Window.partitionBy("symbol_id").orderBy("event_id")
    opened = (
        log.withColumn("p", F.lag("status").over(w))
        .withColumn("rn", F.row_number().over(w))
        .where((F.col("rn") == 1) | ~F.col("status").eqNullSafe(F.col("p")))
    )
    want = opened.select("symbol_id", "status", "ts", F.lead("ts").over(w))
    got = history_from_log(log, "symbol_id", ["status"], "ts", "event_id", width)
    assert rows(got, "symbol_id", "status", "valid_from", "valid_to") == rows(want)


def test_dimension_surface(spark):
    data = [(1, "A", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)), (1, "B", dt.datetime(2024, 1, 2), None)]
    dim = symbol_dimension(spark.createDataFrame(data, "symbol_id bigint, status string, valid_from timestamp_ntz, valid_to timestamp_ntz"))
    got = dim.orderBy("valid_from").collect()
    assert [r.is_current for r in got] == [False, True]
    assert len({r.symbol_version_key for r in got}) == 2 and len(got[0].symbol_version_key) == 32
