"""Registered queries over the change log: decoding, landing, typed rows, streams."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.schemas import LOG, PAYLOADS
from ledgerline.operators import cdc
from ledgerline.operators.latest import first_ranked
from ledgerline.plans import inputs
from ledgerline.plans import sql as s
from ledgerline.plans.gold import rebuild_trades
from ledgerline.plans.registry import query
from ledgerline.session import new_run_dir, settings
from ledgerline.sources.log import file_log, from_offset
from ledgerline.streaming.current import CurrentState
from ledgerline.streaming.landing import read_landing, write_landing
from ledgerline.streaming.run import run_available

SLICES = 5
_LAST_DAY = 31
_RECORD = ["topic", "partition", "offset", "value"]


def _slice():
    """Number 0..4 of the part of the month a record falls into."""
    return F.floor((F.dayofmonth("ts") - 1) * SLICES / _LAST_DAY)


def staged(log: DataFrame, path: str) -> DataFrame:
    """A log and its ``slice`` on files with a partition per slice, computed once.

    A cache would keep what a task made of its split as one block, many times the size of the split. A
    column ``slice`` says which one a record comes in; without it the day of the month does.
    """
    spark = log.sparkSession
    rows = log if "slice" in log.columns else log.withColumn("slice", _slice())
    rows = rows.where(F.col("slice").between(0, SLICES - 1)).select(*_RECORD, "slice")
    # A task keeps a file open per slice and so need not sort its records.
    with settings(spark, {"spark.sql.maxConcurrentOutputFileWriters": str(SLICES)}):
        rows.write.partitionBy("slice").parquet(path)
    return spark.read.schema(f"{LOG}, slice int").parquet(path)


def ship(log: DataFrame, path: str):
    """Append a log to a folder slice by slice, yielding after each one; its slices lie staged beside it."""
    rows = staged(log, f"{path}_staged")
    for n in range(SLICES):
        rows.where(F.col("slice") == n).select(*_RECORD).write.mode("append").parquet(path)
        yield n


def _landed(spark, path: str) -> DataFrame:
    parts = [
        read_landing(spark, path, t).select(F.lit(t).alias("src_table"), "*") for t in PAYLOADS
    ]
    return reduce(DataFrame.unionByName, parts)


@query(
    "cdc_decode",
    f"""
with {s.ENVELOPES}
select src_table, kafka_offset, coalesce(op, '?') as op, coalesce(ts_ms, -1) as ts_ms,
       coalesce(source_lsn, -1) as source_lsn, coalesce(symbol_id, -1) as symbol_id,
       coalesce(has_after, false) as has_after, coalesce(has_before, false) as has_before
from envelopes""",
)
def cdc_decode(spark, sf_dir):
    rows = cdc.decode(inputs.whole_log(spark, sf_dir))
    return rows.select(
        "src_table",
        "kafka_offset",
        F.coalesce("op", F.lit("?")).alias("op"),
        *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("ts_ms", "source_lsn", "symbol_id")],
        F.col("after").isNotNull().alias("has_after"),
        F.col("before").isNotNull().alias("has_before"),
    )


@query(
    "cdc_decode_rejects",
    f"""
with {s.TRADE_LOG}
select src_table, 'no operation' as reason, kafka_offset, 'garbage' as value from trade_log where k = 0""",
)
def cdc_decode_rejects(spark, sf_dir):
    rows = cdc.decode(inputs.whole_log(spark, sf_dir))
    return reduce(DataFrame.unionByName, [cdc.rejects(rows, t) for t in PAYLOADS])


@query(
    "cdc_replay_from_offset",
    f"""
with {s.BOOK_LOG}
select kafka_offset, op, symbol_id from book_log where ts >= timestamp '{inputs.CUT}'""",
)
def cdc_replay_from_offset(spark, sf_dir):
    """Everything after the last offset that was committed before the cut."""
    log = inputs.book_log(spark, sf_dir)
    events = inputs.book_events(spark, sf_dir).where(F.col("ts") < inputs.at(inputs.CUT))
    committed = events.agg(F.max(F.col("event_id") * 2 + 1)).scalar()
    return cdc.decode(from_offset(log, committed)).select("kafka_offset", "op", "symbol_id")


@query(
    "bronze_append",
    f"""
with {s.ENVELOPES}
select src_table, kafka_offset, coalesce(op, '?') as op, coalesce(symbol_id, -1) as symbol_id,
       coalesce(source_lsn, -1) as source_lsn,
       coalesce({s.text_date("make_timestamp(ts_ms * 1000)")}, 'none') as ingest_date
from envelopes""",
)
def bronze_append(spark, sf_dir):
    path = new_run_dir(spark, "landing")
    write_landing(cdc.decode(inputs.whole_log(spark, sf_dir)), path, batch_id=0)
    return _landed(spark, path).select(
        "src_table",
        "kafka_offset",
        F.coalesce("op", F.lit("?")).alias("op"),
        *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("symbol_id", "source_lsn")],
        F.coalesce(F.col("ingest_date").cast("string"), F.lit("none")).alias("ingest_date"),
    )


@query(
    "bronze_fanout_counts",
    f"""
with {s.ENVELOPES}
select src_table, coalesce({s.text_date("make_timestamp(ts_ms * 1000)")}, 'none') as ingest_date,
       count(*) as n
from envelopes group by all""",
)
def bronze_fanout_counts(spark, sf_dir):
    path = new_run_dir(spark, "landing")
    write_landing(cdc.decode(inputs.whole_log(spark, sf_dir)), path, batch_id=0)
    day = F.coalesce(F.col("ingest_date").cast("string"), F.lit("none")).alias("ingest_date")
    return _landed(spark, path).groupBy("src_table", day).agg(F.count("*").alias("n"))


_TYPED_TRADES = f"""
with {s.TRADES}
select trade_id, symbol_id, {s.num("price")} as price, {s.num("quantity")} as quantity,
       {s.num("quote_qty")} as quote_qty, is_buyer_maker, trade_time
from trades where event_type <> 'error' and quantity <> 0"""

_TRADE_COLUMNS = [
    "trade_id",
    "symbol_id",
    "price",
    "quantity",
    "quote_qty",
    "is_buyer_maker",
    "trade_time",
]


@query("silver_trades_typed", _TYPED_TRADES)
def silver_trades_typed(spark, sf_dir):
    return cdc.trade_rows(cdc.decode(inputs.trade_log(spark, sf_dir))).select(*_TRADE_COLUMNS)


@query("silver_rebuild_from_bronze", _TYPED_TRADES)
def silver_rebuild_from_bronze(spark, sf_dir):
    """The log is landed twice, as after a retry, and must still give every trade once."""
    landing, out = new_run_dir(spark, "landing"), new_run_dir(spark, "trades")
    decoded = cdc.decode(inputs.trade_log(spark, sf_dir))
    write_landing(decoded, landing, batch_id=0)
    write_landing(decoded, landing, batch_id=1)
    rebuild_trades(spark, landing, out)
    return spark.read.parquet(out).select(
        "trade_id", F.col("symbol_id").cast("bigint").alias("symbol_id"), *_TRADE_COLUMNS[2:]
    )


@query(
    "latest_per_key_versioned",
    f"""
with {s.BOOK_LOG}
select symbol_id, side, cast(price_level as double) as price_level,
       case when op = 'd' then coalesce(prev_id, event_id) else event_id end as last_update_id,
       kafka_offset, op = 'd' or quantity = 0 as deleted
from book_log
qualify row_number() over (partition by symbol_id, side, price_level order by event_id desc) = 1""",
)
def latest_per_key_versioned(spark, sf_dir):
    changes = cdc.book_changes(cdc.decode(inputs.book_log(spark, sf_dir)))
    newest_first = [F.col("last_update_id").desc_nulls_last(), F.col("kafka_offset").desc()]
    last = first_ranked(changes, ["symbol_id", "side", "price_level"], newest_first)
    return last.select("symbol_id", "side", "price_level", "last_update_id", "kafka_offset", "deleted")


@query(
    "cdc_stream_ingest",
    f"""
with {s.ENVELOPES}, {s.LIVE_ONLY}
select 'landing' as tier, src_table, coalesce(op, '?') as op, count(*) as n from envelopes group by all
union all
select 'current', 'orderbook_levels', '-', count(*) from live
union all
select 'current', 'trades', '-', count(*) from trade_log where op in ('c', 'r')
union all
select 'current', 'symbols', '-', count(*)
from (select arg_max(op, kafka_offset) as last_op from symbol_log group by symbol_id) where last_op <> 'd'
union all
select 'current', 'exchanges', '-', count(*) from exchange_log""",
)
def cdc_stream_ingest(spark, sf_dir):
    """Both streams, restarted from their checkpoints for every slice; rows per tier and table."""
    root = new_run_dir(spark, "stream")
    state = CurrentState(f"{root}/current")
    for _ in ship(inputs.whole_log(spark, sf_dir), f"{root}/log"):
        run_available(file_log(spark, f"{root}/log"), root, state, name=root)
    landed = _landed(spark, f"{root}/landing").groupBy(
        F.lit("landing").alias("tier"), "src_table", F.coalesce("op", F.lit("?")).alias("op")
    )
    parts = [landed.agg(F.count("*").alias("n"))]
    for t in PAYLOADS:
        counted = state.read(spark, t).agg(F.count("*").alias("n"))
        parts.append(counted.select(F.lit("current").alias("tier"), F.lit(t).alias("src_table"), F.lit("-").alias("op"), "n"))
    return reduce(DataFrame.unionByName, parts)
