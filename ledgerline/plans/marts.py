"""The star schema as lazy DataFrame functions over the current-state tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.exprs import date_key, taker_side, time_key, truncate_like


def staged_trades(trades: DataFrame) -> DataFrame:
    return trades.select(
        "trade_id",
        "symbol_id",
        "price",
        "quantity",
        "quote_qty",
        "is_buyer_maker",
        taker_side("is_buyer_maker").alias("taker_side"),
        "trade_time",
    )


def staged_levels(levels: DataFrame) -> DataFrame:
    return levels.select(
        "symbol_id",
        F.lower("side").alias("side"),
        "price_level",
        "quantity",
        "last_update_id",
        "updated_at",
    )


def fct_trades(trades: DataFrame) -> DataFrame:
    """One row per trade; the day and minute keys are computed, so no join is needed."""
    return staged_trades(trades).select(
        "trade_id",
        "symbol_id",
        date_key("trade_time").alias("date_key"),
        time_key("trade_time").alias("time_key"),
        "price",
        "quantity",
        "quote_qty",
        "taker_side",
        "is_buyer_maker",
        "trade_time",
    )


def ohlcv(trades: DataFrame, unit: str = "minute", tie_break: str | None = "trade_id") -> DataFrame:
    """Bars per symbol and time unit.

    Trades of one symbol can share a timestamp, so ``tie_break`` settles which of them opens and
    closes a bar. Without it any of the tied prices may be taken; the aggregate then runs by
    hashing instead of sorting. Either way each task sends one row per bar into the shuffle.
    """
    when = F.struct("trade_time", tie_break) if tie_break else F.col("trade_time")
    bar = truncate_like(unit, "trade_time", trades.schema).alias("bar")
    bars = trades.groupBy("symbol_id", bar).agg(
        F.min_by("price", when).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", when).alias("close"),
        F.sum("quantity").alias("volume"),
        F.sum("quote_qty").alias("quote_volume"),
        F.count("*").alias("trade_count"),
    )
    return bars.select(
        "symbol_id",
        F.col("bar").alias(f"bar_{unit}"),
        date_key("bar").alias("date_key"),
        time_key("bar").alias("time_key"),
        "open",
        "high",
        "low",
        "close",
        "volume",
        "quote_volume",
        "trade_count",
    )


def vwap(bars: DataFrame) -> DataFrame:
    """Volume-weighted price per bar; NULL for a bar without volume."""
    price = F.col("quote_volume").cast("double") / F.col("volume").cast("double")
    return bars.withColumn("vwap", F.when(F.col("volume") != 0, price))


def rolling_volume(bars: DataFrame, bar: str, span: int) -> DataFrame:
    """Volume over the last ``span`` bars of a symbol.

    Bars are already one per symbol and time unit: a window group grows with the calendar
    (half a million rows per symbol and year at one minute), not with the trades.
    """
    w = Window.partitionBy("symbol_id").orderBy(bar).rowsBetween(-(span - 1), 0)
    return bars.select("symbol_id", bar, "volume", F.sum("volume").over(w).alias("rolling_volume"))


def latest_bars(bars: DataFrame, bar: str, symbol_id: int, n: int = 5) -> DataFrame:
    """The newest ``n`` bars of one symbol."""
    return bars.where(F.col("symbol_id") == symbol_id).orderBy(F.col(bar).desc()).limit(n)


def dim_exchange(exchanges: DataFrame) -> DataFrame:
    return exchanges.select(
        F.col("exchange_id").alias("exchange_key"),
        "exchange_id",
        F.col("name").alias("exchange_name"),
        "region",
    )


def dim_date(trades: DataFrame) -> DataFrame:
    """Every day from the first to the last trade."""
    ends = trades.agg(
        F.min("trade_time").cast("date").alias("first"), F.max("trade_time").cast("date").alias("last")
    )
    d = F.col("date_day")
    return ends.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("date_day")).select(
        date_key(d).alias("date_key"),
        "date_day",
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"),
        (F.weekday(d) + 1).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).alias("week_of_year"),
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """The minutes of a day."""
    m = F.col("id").cast("int")
    hour, minute = (m / 60).cast("int"), m % 60
    return spark.range(24 * 60).select(
        m.alias("time_key"),
        hour.alias("hour"),
        minute.alias("minute"),
        F.format_string("%02d:%02d", hour, minute).alias("hh_mm"),
        F.when(m < 12 * 60, "AM").otherwise("PM").alias("am_pm"),
    )
