"""Registered queries over trades: facts, bars, calendars, feed messages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import feed
from ledgerline.operators.merge import new_rows
from ledgerline.plans import inputs, marts
from ledgerline.plans import sql as s
from ledgerline.plans.registry import query

_BAR_NUMBERS = ", ".join(
    f"{s.num(c)} as {c}" for c in ("open", "high", "low", "close", "volume", "quote_volume")
)


def _bars_sql(unit: str) -> str:
    return f"""
with {s.TRADES}, {s.bars(unit)}
select symbol_id, bar as bar_{unit}, cast(strftime(bar, '%Y%m%d') as integer) as date_key,
       cast(hour(bar) * 60 + minute(bar) as integer) as time_key, {_BAR_NUMBERS}, trade_count
from bars"""


@query("ohlcv_1m", _bars_sql("minute"))
def ohlcv_1m(spark, sf_dir):
    return marts.ohlcv(inputs.trades(spark, sf_dir), "minute")


@query("ohlcv_1h", _bars_sql("hour"))
def ohlcv_1h(spark, sf_dir):
    return marts.ohlcv(inputs.trades(spark, sf_dir), "hour")


@query(
    "ohlcv_vwap",
    f"""
with {s.TRADES}
select symbol_id, date_trunc('hour', trade_time) as bar_hour,
       case when sum(quantity) <> 0
            then round(cast(sum(quote_qty) as double) / cast(sum(quantity) as double), 6) end as vwap
from trades group by all""",
)
def ohlcv_vwap(spark, sf_dir):
    bars = marts.vwap(marts.ohlcv(inputs.trades(spark, sf_dir), "hour"))
    return bars.select("symbol_id", "bar_hour", F.round("vwap", 6).alias("vwap"))


@query(
    "rolling_volume",
    f"""
with {s.TRADES}, per_bar as (
  select symbol_id, date_trunc('hour', trade_time) as bar_hour, sum(quantity) as volume
  from trades group by all)
select symbol_id, bar_hour, {s.num("volume")} as volume,
       {s.num("sum(volume) over (partition by symbol_id order by bar_hour rows 4 preceding)")}
         as rolling_volume
from per_bar""",
)
def rolling_volume(spark, sf_dir):
    bars = marts.ohlcv(inputs.trades(spark, sf_dir), "hour")
    return marts.rolling_volume(bars, "bar_hour", span=5)


@query(
    "latest_bars",
    _bars_sql("minute") + " where symbol_id = 1 order by bar desc limit 5",
)
def latest_bars(spark, sf_dir):
    bars = marts.ohlcv(inputs.trades(spark, sf_dir), "minute")
    return marts.latest_bars(bars, "bar_minute", symbol_id=1, n=5)


@query(
    "fct_trades",
    f"""
with {s.TRADES}
select trade_id, symbol_id, cast(strftime(trade_time, '%Y%m%d') as integer) as date_key,
       cast(date_diff('minute', date_trunc('day', trade_time), trade_time) as integer) as time_key,
       {s.num("price")} as price, {s.num("quantity")} as quantity, {s.num("quote_qty")} as quote_qty,
       if(is_buyer_maker, 'sell', 'buy') as taker_side, is_buyer_maker, trade_time
from trades""",
)
def fct_trades(spark, sf_dir):
    return marts.fct_trades(inputs.trades(spark, sf_dir))


@query(
    "trades_notional",
    f"""
with {s.TRADES}
select trade_id, {s.num("quote_qty")} as quote_qty,
       date_trunc('millisecond', trade_time) as trade_time
from trades""",
)
def trades_notional(spark, sf_dir):
    parsed = feed.parse_trades(inputs.feed_messages(spark, sf_dir))
    return parsed.select("trade_id", "quote_qty", "trade_time")


@query(
    "trades_symbol_lookup",
    f"""
select event_id as trade_id, s_suppkey as symbol_id, round(value, 6) as price,
       {s.K.format(t="double")} as quantity,
       event_type in ('view', 'click') as is_buyer_maker
from events join supplier on s_name = printf('Supplier#%09d', user_id)""",
)
def trades_symbol_lookup(spark, sf_dir):
    parsed = feed.parse_trades(inputs.feed_messages(spark, sf_dir))
    known = feed.resolve_symbols(parsed, inputs.symbols(spark, sf_dir))
    return known.select("trade_id", "symbol_id", "price", "quantity", "is_buyer_maker")


@query(
    "exchange_info_flatten",
    f"""
select 'P' || p_partkey as symbol, p_brand as base_asset, p_type as quote_asset, 'TRADING' as status,
       case when p_size >= 10 then {s.num("cast(p_retailprice as decimal(12,2))")} end as tick_size,
       case when p_size <= 40 then cast(p_size as double) end as step_size
from part""",
)
def exchange_info_flatten(spark, sf_dir):
    return feed.flatten_symbol_info(inputs.exchange_info_messages(spark, sf_dir))


_TRADE_ROWS = f"""
with {s.TRADES}
select trade_id, symbol_id, {s.num("price")} as price, {s.num("quantity")} as quantity, trade_time
from trades"""


@query("dedup_trades", _TRADE_ROWS)
def dedup_trades(spark, sf_dir):
    rows = inputs.redelivered_trades(spark, sf_dir)
    unique = rows.dropDuplicates(["symbol_id", "trade_id"])
    return unique.select("trade_id", "symbol_id", "price", "quantity", "trade_time")


@query("trades_insert_only_merge", _TRADE_ROWS)
def trades_insert_only_merge(spark, sf_dir):
    """The first half of the month is stored; then everything is delivered, purchases twice."""
    stored = inputs.trades(spark, sf_dir).where(F.col("trade_time") < inputs.at(inputs.CUT))
    batch = inputs.redelivered_trades(spark, sf_dir).dropDuplicates(["symbol_id", "trade_id"])
    fresh = new_rows(stored, batch, ["symbol_id", "trade_id"])
    cols = ["trade_id", "symbol_id", "price", "quantity", "trade_time"]
    return stored.select(*cols).unionByName(fresh.select(*cols))


@query(
    "dim_date",
    """
select cast(strftime(d, '%Y%m%d') as integer) as date_key, cast(cast(d as date) as varchar) as date_day,
       cast(year(d) as integer) as year, cast(month(d) as integer) as month,
       cast(day(d) as integer) as day_of_month, cast(isodow(d) as integer) as day_of_week,
       strftime(d, '%A') as day_name, cast(week(d) as integer) as week_of_year
from (select unnest(generate_series(min(ts)::date, max(ts)::date, interval 1 day)) as d from events)""",
)
def dim_date(spark, sf_dir):
    return marts.dim_date(inputs.trades(spark, sf_dir))


@query(
    "dim_time",
    """
with m as (select unnest(range(1440)) as k),
     n as (select hour(ts) * 60 + minute(ts) as k, count(*) as trade_count from events group by 1)
select cast(k as integer) as time_key, cast(k // 60 as integer) as hour, cast(k % 60 as integer) as minute,
       printf('%02d:%02d', k // 60, k % 60) as hh_mm, if(k < 720, 'AM', 'PM') as am_pm,
       coalesce(trade_count, 0) as trade_count
from m left join n using (k)""",
)
def dim_time(spark, sf_dir):
    """The minutes of a day, with the number of trades that fall into each."""
    facts = marts.fct_trades(inputs.trades(spark, sf_dir))
    counts = facts.groupBy("time_key").agg(F.count("*").alias("trade_count"))
    joined = marts.dim_time(spark).join(counts, "time_key", "left")
    return joined.withColumn("trade_count", F.coalesce("trade_count", F.lit(0)))


@query(
    "dim_exchange",
    f"with {s.EXCHANGES} select exchange_id as exchange_key, exchange_id, name as exchange_name, region "
    "from exchanges",
)
def dim_exchange(spark, sf_dir):
    return marts.dim_exchange(inputs.exchanges(spark, sf_dir))
