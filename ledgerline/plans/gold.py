"""Build the star schema as tables, and the checks that guard it."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import quality as q
from ledgerline.operators.book import top_of_book
from ledgerline.operators.latest import latest_per_key
from ledgerline.operators.scd import symbol_dimension
from ledgerline.operators.cdc import trade_rows
from ledgerline.plans import marts
from ledgerline.sources.tables import finished_versions, remove_versions, write_clustered
from ledgerline.streaming.landing import read_landing

# The table names of the star schema.
MARTS = [
    "dim_symbol",
    "dim_exchange",
    "dim_date",
    "dim_time",
    "fct_trades",
    "fct_ohlcv_1m",
    "fct_book_snapshot",
]


_PLACES = "mart string, place string"


def gold_frames(
    spark: SparkSession, facts: DataFrame, levels: DataFrame, exchanges: DataFrame, history: DataFrame
) -> dict[str, DataFrame]:
    """Every mart but the trades themselves, as a lazy frame over these, the other current-state tables
    and the symbol history."""
    return {
        "dim_symbol": symbol_dimension(history),
        "dim_exchange": marts.dim_exchange(exchanges),
        "dim_date": marts.dim_date(facts),
        "dim_time": marts.dim_time(spark),
        "fct_ohlcv_1m": marts.ohlcv(facts, "minute"),
        "fct_book_snapshot": top_of_book(marts.staged_levels(levels)),
    }


def build_gold(
    spark: SparkSession,
    trades: DataFrame,
    levels: DataFrame,
    exchanges: DataFrame,
    history: DataFrame,
    path: str,
    run: int = 0,
) -> dict[str, DataFrame]:
    """Write every mart of build number ``run`` and publish them in one step; returns them as read back.

    The trades are derived once and the marts about them read the result. Nothing that readers see
    changes until the last mart is written; every attempt at a run has a folder of its own.
    """
    folder = f"{path}/run={run}/{uuid.uuid4().hex}"
    marts.fct_trades(trades).write.mode("overwrite").parquet(f"{folder}/fct_trades")
    facts = spark.read.parquet(f"{folder}/fct_trades")
    for name, frame in gold_frames(spark, facts, levels, exchanges, history).items():
        frame.write.mode("overwrite").parquet(f"{folder}/{name}")
    # The marker of this write is what publishes the build.
    places = [(m, f"{folder}/{m}") for m in MARTS]
    spark.createDataFrame(places, _PLACES).coalesce(1).write.mode("overwrite").parquet(f"{path}/published/run={run}")
    return published_gold(spark, path)


def published_gold(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The marts of the newest published build, all of the same one."""
    run = finished_versions(spark, f"{path}/published", "run")[-1]
    places = spark.read.schema(_PLACES).parquet(f"{path}/published/run={run}").collect()
    return {r["mart"]: spark.read.parquet(r["place"]) for r in places}


def drop_old_builds(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Delete all but the last builds; readers of an older one must be done."""
    old = finished_versions(spark, f"{path}/published", "run")[: -max(keep, 1)]
    remove_versions(spark, f"{path}/published", "run", old)
    remove_versions(spark, path, "run", old)


def gold_checks(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Name -> violating rows, for every guarantee the star schema gives."""
    symbol, bars, book = gold["dim_symbol"], gold["fct_ohlcv_1m"], gold["fct_book_snapshot"]
    keys = {
        "dim_symbol": "symbol_version_key",
        "dim_exchange": "exchange_key",
        "dim_date": "date_key",
        "dim_time": "time_key",
        "fct_book_snapshot": "symbol_id",
    }
    required = {
        "dim_symbol": ["symbol_version_key", "symbol_id"],
        "dim_exchange": ["exchange_key"],
        "dim_date": ["date_key"],
        "dim_time": ["time_key"],
        "fct_trades": ["trade_id", "symbol_id"],
        "fct_ohlcv_1m": ["symbol_id", "bar_minute"],
        "fct_book_snapshot": ["symbol_id", "spread"],
    }
    checks = {f"unique {t}.{k}": q.duplicates(gold[t], [k]) for t, k in keys.items()}
    checks |= {f"not null {t}": q.nulls(gold[t], cols) for t, cols in required.items()}
    return checks | {
        "accepted fct_trades.taker_side": q.outside_values(
            gold["fct_trades"], "taker_side", ["buy", "sell"]
        ),
        "spread not negative": q.negative_spreads(book),
        "no overlapping versions": q.overlapping_versions(symbol),
        "one current version": q.not_one_current(symbol),
        "unique bar": q.duplicates(bars, ["symbol_id", "bar_minute"]),
        "unique trade": q.duplicates(gold["fct_trades"], ["symbol_id", "trade_id"]),
        "bar within range": q.broken_bars(bars),
    }


def gold_violations(gold: dict[str, DataFrame]) -> DataFrame:
    """(check_name, violations) of the same guarantees, every mart profiled in one pass.

    Only the overlap of versions needs their order and so a second look at the symbols.
    """
    outside = [~F.col(c).between(F.col("low"), F.col("high")) for c in ("open", "close")]
    profiles = {
        "dim_symbol": (
            {"unique dim_symbol.symbol_version_key": ["symbol_version_key"]},
            {"not null dim_symbol": q.any_null(["symbol_version_key", "symbol_id"])},
            {"one current version": (["symbol_id"], F.col("is_current"))},
        ),
        "dim_exchange": ({"unique dim_exchange.exchange_key": ["exchange_key"]}, {"not null dim_exchange": q.any_null(["exchange_key"])}, {}),
        "dim_date": ({"unique dim_date.date_key": ["date_key"]}, {"not null dim_date": q.any_null(["date_key"])}, {}),
        "dim_time": ({"unique dim_time.time_key": ["time_key"]}, {"not null dim_time": q.any_null(["time_key"])}, {}),
        "fct_trades": (
            {"unique trade": ["symbol_id", "trade_id"]},
            {
                "not null fct_trades": q.any_null(["trade_id", "symbol_id"]),
                "accepted fct_trades.taker_side": ~F.col("taker_side").isin("buy", "sell"),
            },
            {},
        ),
        "fct_ohlcv_1m": (
            {"unique bar": ["symbol_id", "bar_minute"]},
            {"not null fct_ohlcv_1m": q.any_null(["symbol_id", "bar_minute"]), "bar within range": outside[0] | outside[1]},
            {},
        ),
        "fct_book_snapshot": (
            {"unique fct_book_snapshot.symbol_id": ["symbol_id"]},
            {"not null fct_book_snapshot": q.any_null(["symbol_id", "spread"]), "spread not negative": F.col("spread") < 0},
            {},
        ),
    }
    parts = [q.profile(gold[mart], *checks) for mart, checks in profiles.items()]
    parts.append(q.summarise({"no overlapping versions": q.overlapping_versions(gold["dim_symbol"])}))
    return reduce(DataFrame.unionByName, parts)


def rebuild_trades(spark: SparkSession, landing: str, out: str) -> None:
    """Recreate the trades table from the landed log, deduplicated and in few large files.

    The log may hold a trade more than once; the copy with the highest offset wins.
    """
    rows = trade_rows(read_landing(spark, landing, "trades"))
    unique = latest_per_key(rows, ["symbol_id", "trade_id"], ["kafka_offset"]).drop("kafka_offset")
    dated = unique.withColumn("trade_date", unique.trade_time.cast("date"))
    write_clustered(dated, out, ["trade_date", "symbol_id"])
