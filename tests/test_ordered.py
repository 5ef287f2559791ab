"""Chunked ordered operators give what a plain window per key gives, for any chunk width."""

import random

import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerline.operators import ordered

WIDTHS = [1, 3, 10, 1_000_000]


@pytest.fixture(scope="module")
def data(spark):
    """One key holds most rows, the others are sparse; ids have gaps and go below zero."""
    rng = random.Random(7)
    picked = rng.sample(range(-40, 400), 150)
    return spark.createDataFrame(
        [(rng.choice("aaaaabc"), i, rng.choice([None, rng.randrange(5)])) for i in picked],
        "k string, id bigint, v int",
    )


@pytest.mark.parametrize("width", WIDTHS)
def test_previous_and_next(data, width):
    w = Window.partitionBy("k").orderBy("id")
    want = data.select("k", "id", F.lag("v").over(w), F.lag("id").over(w), F.lead("v").over(w), F.lead("id").over(w))
    got = ordered.with_previous(data, ["k"], "id", {"v": "pv", "id": "pid"}, width)
    got = ordered.with_next(got, ["k"], "id", {"v": "nv", "id": "nid"}, width)
    assert rows(got, "k", "id", "pv", "pid", "nv", "nid") == rows(want)


@pytest.mark.parametrize("width", WIDTHS)
def test_running_sum_and_row_number(data, width):
    w = Window.partitionBy("k").orderBy("id")
    filled = data.fillna(0)
    want = filled.select(
        "k", "id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.row_number().over(w)
    )
    got = ordered.with_running_sum(filled, ["k"], "id", F.col("v").cast("bigint"), "s", width)
    got = ordered.with_row_number(got, ["k"], "id", "n", width)
    assert rows(got, "k", "id", "s", "n") == rows(want)


def test_large_ids_stay_exact(spark):
    """Ids beyond 2^53 differ by one and must not share a chunk by rounding."""
    base = 2**60
    df = spark.createDataFrame([("a", base + i) for i in range(6)], "k string, id bigint")
    got = ordered.with_previous(df, ["k"], "id", {"id": "p"}, width=2)
    assert rows(got, "id", "p") == [(base, None)] + [(base + i, base + i - 1) for i in range(1, 6)]


def test_rows_without_key_are_left_out(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), ("a", None)], "k string, id bigint")
    assert rows(ordered.with_row_number(df, ["k"], "id", "n"), "k", "id", "n") == [("a", 2, 1)]


def test_windows_never_group_by_the_key_alone(spark, data):
    """The rows of a hot key are spread: only the edge summary is windowed per key."""
    df = ordered.with_previous(data, ["k"], "id", {"v": "p"}, width=10)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    row_windows = [line for line in plan.splitlines() if "Window [lag(_w0" in line]
    assert row_windows and all("__chunk" in line.split("specifiedwindowframe")[1] for line in row_windows)
    assert "ReusedExchange" in plan
