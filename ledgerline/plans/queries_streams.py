"""Registered queries over streams into catalog tables and over event time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.schemas import PAYLOADS
from ledgerline.operators import cdc
from ledgerline.plans import inputs
from ledgerline.plans import sql as s
from ledgerline.plans.queries_log import ship
from ledgerline.plans.registry import query
from ledgerline.session import new_run_dir
from ledgerline.sources.log import TOPIC_PREFIX, committed_positions, file_log, from_positions
from ledgerline.streaming.lake import Lake, start_lake, start_landing_tables
from ledgerline.streaming.market import closed_bars, distinct_trades, start_append

ONCE = {"availableNow": True}


def _lake(spark, root: str) -> Lake:
    """A lake of its own for every run; the folder's last name is unique."""
    lake = Lake("lake_" + root.rsplit("-", 1)[-1], buckets=4)
    lake.create(spark, f"{root}/tables")
    return lake


def _folded(spark, log: DataFrame) -> Lake:
    """A lake that has worked the log off, restarted for every slice."""
    root = new_run_dir(spark, "lake")
    lake = _lake(spark, root)
    for _ in ship(log, f"{root}/log"):
        start_lake(file_log(spark, f"{root}/log"), lake, f"{root}/checkpoint", ONCE, name=root).awaitTermination()
    return lake


@query(
    "symbols_current",
    f"""
with last as (
  select * from events
  qualify row_number() over (partition by user_id order by epoch_us(ts) // 1000 desc, event_id desc) = 1)
select user_id as symbol_id, 'SYM' || user_id as symbol, 'BASE' as base_asset, 'QUOTE' as quote_asset,
       case event_type when 'error' then 'HALT' when 'signup' then 'BREAK' else 'TRADING' end as status,
       {s.num("cast(value as decimal(12,2))")} as tick_size, {s.num(s.K.format(t="decimal(18,8)"))} as step_size,
       ts as created_at, ts as updated_at
from last where event_type <> 'purchase'""",
)
def symbols_current(spark, sf_dir):
    """The symbol dimension as its stream leaves it, all columns."""
    return _folded(spark, inputs.symbol_log(spark, sf_dir)).read(spark, "symbols")


@query(
    "exchanges_current",
    f"with {s.EXCHANGES} select *, timestamp '2024-01-01' as updated_at from exchanges",
)
def exchanges_current(spark, sf_dir):
    return _folded(spark, inputs.exchange_log(spark, sf_dir)).read(spark, "exchanges")


@query(
    "trades_current_stream",
    f"""
with {s.TRADES}
select trade_id, symbol_id, {s.num("price")} as price, {s.num("quantity")} as quantity, {s.num("quote_qty")} as quote_qty,
       is_buyer_maker, trade_time, trade_time as ingested_at
from trades where event_type <> 'error' and quantity <> 0""",
)
def trades_current_stream(spark, sf_dir):
    return _folded(spark, inputs.trade_log(spark, sf_dir)).read(spark, "trades")


@query(
    "book_partitioned_stream",
    f"""
with {s.LIVE}
select {s.LEVEL_NUMBERS}, last_update_id, updated_at from live where symbol_id = 2 and side = 'bid'""",
)
def book_partitioned_stream(spark, sf_dir):
    """One side of one symbol's book; the filter prunes the table's folders."""
    levels = _folded(spark, inputs.book_log(spark, sf_dir)).read(spark, "orderbook_levels")
    return levels.where((F.col("symbol_id") == 2) & (F.col("side") == "bid"))


@query(
    "cdc_stream_outcomes",
    f"""
with {s.ENVELOPES}
select src_table,
       case when src_table <> 'trades' or op in ('c', 'r') then 'kept' when op = 'u' then 'ignored' else 'no operation' end as outcome,
       count(*) as n, cast(count(*) filter (op is null) as bigint) as n_rejected
from envelopes group by all""",
)
def cdc_stream_outcomes(spark, sf_dir):
    """What became of every record, and how many lie among the rejects: both stored with their batch."""
    lake = _folded(spark, inputs.whole_log(spark, sf_dir))
    bad = lake.rejected(spark).groupBy("src_table", F.col("reason").alias("outcome")).agg(F.count("*").alias("n_rejected"))
    return lake.outcomes(spark).join(bad, ["src_table", "outcome"], "left").fillna(0, ["n_rejected"])


@query(
    "bronze_tables",
    f"""
with {s.ENVELOPES}
select src_table, kafka_offset, coalesce(op, '?') as op, coalesce(ts_ms, -1) as ts_ms, coalesce(symbol_id, -1) as symbol_id,
       coalesce({s.text_date("make_timestamp(ts_ms * 1000)")}, 'none') as ingest_date,
       coalesce(has_after, false) as has_after, coalesce(has_before, false) as has_before
from envelopes""",
)
def bronze_tables(spark, sf_dir):
    """The whole log, a stream per source table, restarted for every slice."""
    root = new_run_dir(spark, "landing")
    lake = _lake(spark, root)
    for _ in ship(inputs.whole_log(spark, sf_dir), f"{root}/log"):

        def own(table):
            return file_log(spark, f"{root}/log").where(F.col("topic") == TOPIC_PREFIX + table)

        for q in start_landing_tables(own, lake, f"{root}/checkpoints", ONCE, name=root):
            q.awaitTermination()
    parts = [lake.landed(spark, t).select(F.lit(t).alias("src_table"), "*") for t in PAYLOADS]
    return reduce(DataFrame.unionByName, parts).select(
        "src_table",
        "kafka_offset",
        F.coalesce("op", F.lit("?")).alias("op"),
        *[F.coalesce(c, F.lit(-1)).alias(c) for c in ("ts_ms", "symbol_id")],
        F.coalesce(F.col("ingest_date").cast("string"), F.lit("none")).alias("ingest_date"),
        F.col("after").isNotNull().alias("has_after"),
        F.col("before").isNotNull().alias("has_before"),
    )


@query(
    "cdc_replay_positions",
    f"""
with {s.ENVELOPES},
times as (
  select 'orderbook_levels' as src_table, event_id * 2 as kafka_offset, ts from events
  union all select 'trades', event_id, ts from events
  union all select 'symbols', event_id, ts from events
  union all select 'exchanges', s_suppkey, timestamp '2024-01-01' from supplier)
select src_table, kafka_offset, cast(kafka_offset % 3 as integer) as kafka_partition, coalesce(op, '?') as op
from envelopes join times using (src_table, kafka_offset)
where ts >= timestamp '{inputs.CUT}' - to_days(cast(kafka_offset % 3 as integer) * 3) or src_table = 'symbols'""",
)
def cdc_replay_positions(spark, sf_dir):
    """Several topics with three partitions each, left at unequal positions; one topic has none."""
    log = inputs.whole_log(spark, sf_dir).withColumn("partition", (F.col("offset") % 3).cast("int"))
    cut = inputs.at(inputs.CUT) - F.make_dt_interval(F.col("partition") * 3)
    done = committed_positions(log, F.col("ts") < cut).where(F.col("topic") != f"{TOPIC_PREFIX}symbols")
    rows = cdc.decode(from_positions(log, done))
    return rows.select("src_table", "kafka_offset", "kafka_partition", F.coalesce("op", F.lit("?")).alias("op"))


def _trades_of(spark, path: str) -> DataFrame:
    return cdc.trade_rows(cdc.decode(file_log(spark, path))).drop("kafka_offset")


_SLICE = "floor((dayofmonth(ts) - 1) * 5 / 31)"


@query(
    "dedup_trades_stream",
    f"""
with {s.TRADES}
select trade_id, symbol_id, {s.num("price")} as price, {s.num("quantity")} as quantity, trade_time
from trades where event_type <> 'error' and quantity <> 0""",
)
def dedup_trades_stream(spark, sf_dir):
    """Every third trade comes a second time, with the next slice and after a restart."""
    root = new_run_dir(spark, "dedup")
    log = inputs.trade_log(spark, sf_dir).withColumn("slice", F.expr(_SLICE))
    again = log.where(F.col("offset") % 3 == 0).withColumn("slice", F.least(F.col("slice") + 1, F.lit(4)))
    for _ in ship(log.unionByName(again), f"{root}/log"):
        unique = distinct_trades(_trades_of(spark, f"{root}/log"), "15 days")
        start_append(unique, f"{root}/out", f"{root}/checkpoint", ONCE, root).awaitTermination()
    return spark.read.parquet(f"{root}/out").select("trade_id", "symbol_id", "price", "quantity", "trade_time")


@query(
    "ohlcv_1m_stream",
    f"""
with {s.TRADES},
kept as (
  select *, date_trunc('minute', trade_time) as bar from trades
  where event_type <> 'error' and quantity <> 0 and not (trade_id % 50 = 0 and {_SLICE.replace("ts", "trade_time")} = 0))
select symbol_id, bar as bar_start, {s.num("arg_min(price, (trade_time, trade_id))")} as open, {s.num("max(price)")} as high,
       {s.num("min(price)")} as low, {s.num("arg_max(price, (trade_time, trade_id))")} as close,
       {s.num("sum(quantity)")} as volume, {s.num("sum(quote_qty)")} as quote_volume, count(*) as trade_count
from kept group by symbol_id, bar
having bar + interval 1 minute <= (select max(trade_time) from kept) - interval 10 minutes""",
)
def ohlcv_1m_stream(spark, sf_dir):
    """Closed bars; some trades of the first slice come with the last one, too late for theirs."""
    root = new_run_dir(spark, "bars")
    early = F.expr(_SLICE)
    log = inputs.trade_log(spark, sf_dir).withColumn("slice", F.when((early == 0) & (F.col("offset") % 50 == 0), 4).otherwise(early))
    for _ in ship(log, f"{root}/log"):
        bars = closed_bars(_trades_of(spark, f"{root}/log"))
        start_append(bars, f"{root}/out", f"{root}/checkpoint", ONCE, root).awaitTermination()
    return spark.read.schema(bars.schema).parquet(f"{root}/out")
