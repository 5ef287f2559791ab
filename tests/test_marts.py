import datetime as dt
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from ledgerline.operators import quality as q
from ledgerline.plans import marts

TRADES = (
    "trade_id bigint, symbol_id bigint, price decimal(18,8), quantity decimal(18,8), "
    "quote_qty decimal(38,16), is_buyer_maker boolean, trade_time timestamp_ntz"
)


def trades(spark, *data):
    """(id, symbol, price, quantity, second of the day)"""
    start = dt.datetime(2024, 1, 5)
    full = [
        (i, s, Decimal(p), Decimal(n), Decimal(p) * Decimal(n), None, start + dt.timedelta(seconds=sec))
        for i, s, p, n, sec in data
    ]
    return spark.createDataFrame(full, TRADES)


def test_bar_ties_follow_the_trade_id(spark):
    df = trades(spark, (3, 1, 30, 1, 10), (1, 1, 10, 1, 10), (2, 1, 20, 1, 10), (9, 1, 5, 2, 70))
    for _ in range(2):
        r = marts.ohlcv(df.repartition(3)).orderBy("bar_minute").first()
        assert (r.open, r.close, r.high, r.low, r.volume, r.trade_count) == (10, 30, 30, 10, 3, 3)
    assert (r.date_key, r.time_key) == (20240105, 0)


def test_bar_keeps_the_time_type(spark):
    df = trades(spark, (1, 1, 1, 1, 0))
    assert dict(marts.ohlcv(df, "hour").dtypes)["bar_hour"] == "timestamp_ntz"
    instants = df.withColumn("trade_time", F.col("trade_time").cast("timestamp"))
    assert dict(marts.ohlcv(instants, "hour").dtypes)["bar_hour"] == "timestamp"


def test_bar_without_tie_break_hashes(spark):
    plan = marts.ohlcv(trades(spark), tie_break=None)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_vwap_of_zero_volume_is_null(spark):
    df = trades(spark, (1, 1, 10, 0, 0), (2, 1, 10, 1, 70), (3, 1, 20, 3, 75))
    assert rows(marts.vwap(marts.ohlcv(df)), "vwap") == [(None,), (17.5,)]


def test_rolling_volume(spark):
    df = trades(spark, *[(i, 1, 1, i, 60 * i) for i in range(1, 6)])
    out = marts.rolling_volume(marts.ohlcv(df), "bar_minute", 2).orderBy("bar_minute")
    assert [int(r.rolling_volume) for r in out.collect()] == [1, 3, 5, 7, 9]


def test_calendar(spark):
    df = trades(spark, (1, 1, 1, 1, 0), (2, 1, 1, 1, 86400 * 3))
    out = marts.dim_date(df).orderBy("date_key").collect()
    assert [(r.date_key, r.day_of_week, r.day_name, r.week_of_year) for r in out] == [
        (20240105, 5, "Friday", 1),
        (20240106, 6, "Saturday", 1),
        (20240107, 7, "Sunday", 1),
        (20240108, 1, "Monday", 2),
    ]


def test_minutes(spark):
    out = {r.time_key: r for r in marts.dim_time(spark).collect()}
    assert len(out) == 1440
    assert (out[0].hh_mm, out[0].am_pm) == ("00:00", "AM")
    assert (out[719].hh_mm, out[720].am_pm, out[1439].hh_mm) == ("11:59", "PM", "23:59")


def test_latest_bars(spark):
    df = trades(spark, *[(i, i % 2, 1, 1, 60 * i) for i in range(1, 9)])
    got = [r.time_key for r in marts.latest_bars(marts.ohlcv(df), "bar_minute", 1, 2).collect()]
    assert got == [7, 5]


def test_duplicates_ignore_null_keys(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (None, 1), (None, 1), (2, 1)], "a int, b int")
    assert rows(q.duplicates(df, ["a", "b"])) == [(1, 1, 2)]


def test_nulls_and_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None), (2, 3)], "a int, b int")
    assert q.nulls(df, ["a", "b"]).count() == 2
    assert rows(q.null_counts(df, ["a", "b"])) == [("a", 1), ("b", 2)]


def test_accepted_values_pass_null(spark):
    df = spark.createDataFrame([("buy",), ("hold",), (None,)], "s string")
    assert rows(q.outside_values(df, "s", ["buy", "sell"])) == [("hold",)]


def test_orphans_pass_null(spark):
    facts = spark.createDataFrame([(1,), (9,), (None,)], "f int")
    assert rows(q.orphans(facts, spark.createDataFrame([(1,)], "d int"), "f", "d")) == [(9,)]


DIM = "symbol_id bigint, valid_from timestamp_ntz, valid_to timestamp_ntz, is_current boolean"


def versions(spark, *data):
    at = lambda h: None if h is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)
    return spark.createDataFrame([(s, at(a), at(b), c) for s, a, b, c in data], DIM)


def test_overlap(spark):
    clean = versions(spark, (1, 0, 5, False), (1, 5, None, True), (2, 0, None, True))
    assert q.overlapping_versions(clean).isEmpty()
    bad = versions(spark, (1, 0, 6, False), (1, 5, None, True))
    assert rows(q.overlapping_versions(bad), "symbol_id") == [(1,)]


def test_one_current(spark):
    df = versions(spark, (1, 0, None, True), (2, 0, 1, False), (3, 0, None, True), (3, 1, None, True))
    assert rows(q.not_one_current(df)) == [(2, 0), (3, 2)]


def test_broken_bars(spark):
    df = spark.createDataFrame([(1, 5, 6, 4, 5), (2, 7, 6, 4, 5), (3, 5, 6, 4, 3)], "id int, open int, high int, low int, close int")
    assert rows(q.broken_bars(df), "id") == [(2,), (3,)]


def test_summary(spark):
    df = spark.createDataFrame([(1,), (1,), (2,)], "a int")
    checks = {"dup": q.duplicates(df, ["a"]), "null": q.nulls(df, ["a"])}
    assert rows(q.summarise(checks)) == [("dup", 1), ("null", 0)]
