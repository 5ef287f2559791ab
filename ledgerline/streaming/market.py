"""Event-time streams over typed trades: redelivered ones dropped, bars given out once they are closed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

DELAY = "10 minutes"


def distinct_trades(trades: DataFrame, delay: str = DELAY) -> DataFrame:
    """Each trade once, however often it is delivered within ``delay`` of event time.

    A key leaves the state when the watermark has passed it by ``delay``, so the state is bounded by
    the trades of that time. Copies that come later than that are late and dropped as such.
    """
    return trades.withWatermark("trade_time", delay).dropDuplicatesWithinWatermark(["symbol_id", "trade_id"])


def closed_bars(trades: DataFrame, delay: str = DELAY, unit: str = "1 minute") -> DataFrame:
    """Bars per symbol and ``unit``, each given out once, when the watermark has passed its end.

    Trades of a bar that was given out are late: they change nothing and are counted by ``late_rows``.
    Ties in time are settled by the trade id.
    """
    when = F.struct("trade_time", "trade_id")
    bars = (
        trades.withWatermark("trade_time", delay)
        .groupBy("symbol_id", F.window("trade_time", unit).alias("bar"))
        .agg(
            F.min_by("price", when).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", when).alias("close"),
            F.sum("quantity").alias("volume"),
            F.sum("quote_qty").alias("quote_volume"),
            F.count("*").alias("trade_count"),
        )
    )
    return bars.select("symbol_id", F.col("bar.start").alias("bar_start"), *[c for c in bars.columns if c not in ("symbol_id", "bar")])


def start_append(
    rows: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, name: str = "append"
) -> StreamingQuery:
    """Append a stream to Parquet files; the sink's own log makes every row appear exactly once."""
    return (
        rows.writeStream.queryName(name)
        .format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**(trigger or {"processingTime": "15 seconds"}))
        .start()
    )


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their watermark, in the batches the query still reports.

    An aggregate counts them after its partial sums: rows of one bar and batch are one.
    """
    progress = query.recentProgress
    return sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"])
