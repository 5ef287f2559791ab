"""Registered queries over dimensions: merges, history, the star schema and its checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators import cdc
from ledgerline.operators import quality as q
from ledgerline.operators.book import live_levels
from ledgerline.operators.latest import first_ranked, latest_per_key
from ledgerline.operators.merge import keyed_merge, upsert_if_changed
from ledgerline.operators.scd import SnapshotHistory, history_from_log, symbol_dimension
from ledgerline.plans import gold, inputs, marts
from ledgerline.plans import sql as s
from ledgerline.plans.registry import query
from ledgerline.session import new_run_dir
from ledgerline.sources.tables import table

_SUPPLIER = "s_suppkey, s_name, s_nationkey, s_acctbal"


@query(
    "dim_upsert_current",
    f"""
with {s.DIM_SOURCE}
select {_SUPPLIER} from supplier where s_suppkey not in (select s_suppkey from src)
union all
select {_SUPPLIER} from src where not deleted""",
)
def dim_upsert_current(spark, sf_dir):
    target = inputs.dimension_target(spark, sf_dir)
    return keyed_merge(target, inputs.dimension_source(spark, sf_dir), ["s_suppkey"])


@query(
    "dim_upsert_changed_only",
    f"""
with {s.DIM_SOURCE}
select t.s_suppkey, if(s.s_acctbal is distinct from t.s_acctbal and s.s_suppkey is not null, s.s_name, t.s_name)
         as s_name, t.s_nationkey, coalesce(s.s_acctbal, t.s_acctbal) as s_acctbal
from supplier t left join src s using (s_suppkey)
union all
select {_SUPPLIER} from src where s_suppkey not in (select s_suppkey from supplier)""",
)
def dim_upsert_changed_only(spark, sf_dir):
    """Only a changed balance updates a stored row; a changed name alone does not."""
    target = inputs.dimension_target(spark, sf_dir)
    source = inputs.dimension_source(spark, sf_dir)
    return upsert_if_changed(target, source, ["s_suppkey"], ["s_acctbal"])


@query(
    "latest_per_key_offset",
    """
select l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice from lineitem
qualify row_number() over (
  partition by l_orderkey, l_linenumber
  order by l_shipdate desc, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""",
)
def latest_per_key_offset(spark, sf_dir):
    cols = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    keys = ["l_orderkey", "l_linenumber"]
    order = [F.col("l_shipdate").desc(), *[F.col(c).asc() for c in cols[1:]]]
    return first_ranked(table(spark, sf_dir, "lineitem").select(*keys, *cols), keys, order)


_DIM_SYMBOL = f"""
with {s.VERSIONS}
select md5(symbol_id || '~' || strftime(valid_from, '%Y-%m-%d %H:%M:%S.%f')) as symbol_version_key,
       symbol_id, status, {s.num("tick_size")} as tick_size, valid_from, valid_to,
       valid_to is null as is_current
from versions"""


def _dim_symbol(spark, sf_dir):
    log = inputs.status_log(spark, sf_dir)
    return symbol_dimension(history_from_log(log, "symbol_id", ["status"], "ts", "event_id"))


@query("dim_symbol_scd2", _DIM_SYMBOL)
def dim_symbol_scd2(spark, sf_dir):
    return _dim_symbol(spark, sf_dir)


# The days of the first snapshot runs; the last one is the day after the last event.
_RUNS = ["2024-01-08", "2024-01-15", "2024-01-22"]


@query(
    "scd2_snapshot_incremental",
    f"""
with {s.STATUS},
runs as (
  select cast(t as timestamp) as t from (values {", ".join(f"('{d}')" for d in _RUNS)}) as r(t)
  union all select date_trunc('day', max(ts)) + interval 1 day from history),
state as (
  select t, symbol_id, arg_max(status, ts) as status, arg_max(tick_size, ts) as tick_size
  from history join runs on ts < t group by t, symbol_id),
opened as (
  select symbol_id, status, tick_size, t as valid_from from state
  qualify lag(status) over (partition by symbol_id order by t) is distinct from status)
select symbol_id, status, {s.num("tick_size")} as tick_size, valid_from,
       lead(valid_from) over (partition by symbol_id order by valid_from) as valid_to
from opened""",
)
def scd2_snapshot_incremental(spark, sf_dir):
    history = SnapshotHistory(spark, new_run_dir(spark, "history"), "symbol_id", ["status"])
    last = inputs.status_log(spark, sf_dir).agg(F.date_add(F.to_date(F.max("ts")), 1).cast("string")).first()[0]
    for number, day in enumerate([*_RUNS, last]):
        seen = inputs.status_log(spark, sf_dir).where(F.col("ts") < inputs.at(day))
        latest = latest_per_key(seen, ["symbol_id"], ["event_id"])
        history.run(number, latest.drop("ts", "event_id"), inputs.at(day))
    return history.history()


def _built(spark, sf_dir):
    levels = live_levels(cdc.book_changes(cdc.decode(inputs.book_log(spark, sf_dir))))
    log = inputs.status_log(spark, sf_dir)
    history = history_from_log(log, "symbol_id", ["status"], "ts", "event_id")
    trades, exchanges = inputs.trades(spark, sf_dir), inputs.exchanges(spark, sf_dir)
    return gold.build_gold(spark, trades, levels, exchanges, history, new_run_dir(spark, "gold"))


@query(
    "gold_build_rowcounts",
    f"""
with {s.LIVE}, {s.VERSIONS}
select 'dim_symbol' as table_name, count(*) as n from versions
union all select 'dim_exchange', count(*) from supplier
union all select 'dim_date', date_diff('day', min(ts), max(ts)) + 1 from events
union all select 'dim_time', 1440
union all select 'fct_trades', count(*) from events
union all select 'fct_ohlcv_1m', count(distinct (user_id % 3, date_trunc('minute', ts))) from events
union all select 'fct_book_snapshot', count(distinct symbol_id) from live""",
)
def gold_build_rowcounts(spark, sf_dir):
    counts = [
        frame.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, frame in _built(spark, sf_dir).items()
    ]
    return reduce(DataFrame.unionByName, counts)


@query(
    "dq_gold_suite",
    f"""
with {s.TRADES}, {s.LIVE}, {s.VERSIONS}, {s.bars("minute")},
quotes as (
  select symbol_id, arg_max(price_level, last_update_id) filter (side = 'bid') as bid,
         arg_max(price_level, last_update_id) filter (side = 'ask') as ask from live group by symbol_id),
days as (select unnest(generate_series(min(ts)::date, max(ts)::date, interval 1 day)) as d from events),
minutes as (select unnest(range(1440)) as m),
next_versions as (select *, lead(valid_from) over (partition by symbol_id order by valid_from) as following from versions),
repeated as (
  select 'unique dim_symbol.symbol_version_key' as check_name, n from (select count(*) as n from versions group by symbol_id, valid_from)
  union all select 'unique dim_exchange.exchange_key', n from (select count(*) as n from supplier group by s_suppkey)
  union all select 'unique dim_date.date_key', n from (select count(*) as n from days group by d)
  union all select 'unique dim_time.time_key', n from (select count(*) as n from minutes group by m)
  union all select 'unique fct_book_snapshot.symbol_id', n from (select count(*) as n from quotes group by symbol_id)
  union all select 'unique trade', n from (select count(*) as n from trades group by symbol_id, trade_id)
  union all select 'unique bar', n from (select count(*) as n from bars group by symbol_id, bar))
select check_name, count(*) filter (n > 1) as violations from repeated group by check_name
union all select 'not null dim_symbol', count(*) from versions where symbol_id is null or valid_from is null
union all select 'not null dim_exchange', count(*) from supplier where s_suppkey is null
union all select 'not null dim_date', count(*) from days where d is null
union all select 'not null dim_time', count(*) from minutes where m is null
union all select 'not null fct_trades', count(*) from trades where trade_id is null or symbol_id is null
union all select 'not null fct_ohlcv_1m', count(*) from bars where symbol_id is null or bar is null
union all select 'not null fct_book_snapshot', count(*) from quotes where bid is null or ask is null
union all select 'accepted fct_trades.taker_side', count(*) from trades
  where case when is_buyer_maker then 'sell' else 'buy' end not in ('buy', 'sell')
union all select 'spread not negative', count(*) from quotes where ask < bid
union all select 'bar within range', count(*) from bars where not (open between low and high and close between low and high)
union all select 'no overlapping versions', count(*) from next_versions where valid_to > following
union all select 'one current version', count(*)
  from (select symbol_id from versions group by symbol_id having count(*) filter (valid_to is null) <> 1)""",
)
def dq_gold_suite(spark, sf_dir):
    return gold.gold_violations(_built(spark, sf_dir))


@query(
    "dq_no_overlap",
    f"""
with {s.VERSIONS}, late as (
  select symbol_id, valid_from, if(status = 'HALT', valid_to + interval 1 day, valid_to) as valid_to,
         lead(valid_from) over (partition by symbol_id order by valid_from) as next_valid_from from versions)
select * from late where valid_to > next_valid_from""",
)
def dq_no_overlap(spark, sf_dir):
    """Halts are made to end a day late, so each but the last of a symbol overlaps."""
    late = F.when(F.col("status") == "HALT", F.col("valid_to") + F.expr("interval 1 day"))
    dim = _dim_symbol(spark, sf_dir).withColumn("valid_to", F.coalesce(late, "valid_to"))
    return q.overlapping_versions(dim)


@query(
    "dq_one_current",
    f"""
with {s.VERSIONS}
select symbol_id, count(*) filter (valid_to is null and status <> 'BREAK' or tick_size > 200) as n_current
from versions group by symbol_id having n_current <> 1""",
)
def dq_one_current(spark, sf_dir):
    """Expensive versions are marked current too, and breaks never: both kinds of failure."""
    marked = (F.col("is_current") & (F.col("status") != "BREAK")) | (F.col("tick_size") > 200)
    return q.not_one_current(_dim_symbol(spark, sf_dir).withColumn("is_current", marked))


@query(
    "dq_unique",
    "select l_orderkey, l_linenumber, count(*) as n from lineitem group by all having n > 1",
)
def dq_unique(spark, sf_dir):
    return q.duplicates(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "dq_unique_trade",
    """
select user_id % 3 + 1 as symbol_id, event_id as trade_id, cast(2 as bigint) as n
from events where event_type = 'purchase'""",
)
def dq_unique_trade(spark, sf_dir):
    return q.duplicates(inputs.redelivered_trades(spark, sf_dir), ["symbol_id", "trade_id"])


@query(
    "dq_unique_bar",
    """
select symbol_id, date_trunc('hour', m) as bar_minute, count(*) as n
from (select distinct user_id % 3 + 1 as symbol_id, date_trunc('minute', ts) as m from events)
group by all having n > 1""",
)
def dq_unique_bar(spark, sf_dir):
    """Minute bars stamped with their hour collide whenever an hour has several."""
    bars = marts.ohlcv(inputs.trades(spark, sf_dir), "minute")
    hour = F.date_trunc("hour", "bar_minute").cast("timestamp_ntz")
    return q.duplicates(bars.withColumn("bar_minute", hour), ["symbol_id", "bar_minute"])


@query(
    "dq_not_null",
    """
select 'event_type' as column_name, count(*) as n from events where event_type = 'error'
union all select 'k', count(*) from events where props = '{"k": 0}'
union all select 'event_id', 0 union all select 'ts', count(*) from events where ts is null""",
)
def dq_not_null(spark, sf_dir):
    """Errors lose their type and zeros their quantity; ids and times stay whole."""
    k = F.col("k").cast("bigint")
    rows = inputs.events(spark, sf_dir).select(
        "event_id",
        "ts",
        F.nullif("event_type", F.lit("error")).alias("event_type"),
        F.nullif(k, F.lit(0)).alias("k"),
    )
    return q.null_counts(rows, ["event_id", "ts", "event_type", "k"])


@query(
    "dq_accepted_values",
    """
select event_id, event_type from events where event_type in ('error', 'signup')""",
)
def dq_accepted_values(spark, sf_dir):
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return q.outside_values(rows, "event_type", ["view", "click", "purchase"])


@query(
    "dq_relationships",
    "select event_id, user_id from events where user_id not in (select s_suppkey from supplier)",
)
def dq_relationships(spark, sf_dir):
    """Events whose user is no known symbol."""
    facts = table(spark, sf_dir, "events").select("event_id", "user_id")
    return q.orphans(facts, table(spark, sf_dir, "supplier"), "user_id", "s_suppkey")


@query(
    "dq_ohlc_sanity",
    f"""
with {s.TRADES}, {s.bars("minute")}
select symbol_id, bar as bar_minute, {s.num("open")} as open, {s.num("close")} as close
from bars where trade_count > 1 and high <> low""",
)
def dq_ohlc_sanity(spark, sf_dir):
    """High and low are swapped, which breaks every bar whose price moved."""
    bars = marts.ohlcv(inputs.trades(spark, sf_dir), "minute")
    swapped = bars.withColumns({"high": F.col("low"), "low": F.col("high")})
    return q.broken_bars(swapped).select("symbol_id", "bar_minute", "open", "close")
