"""SQL fragments of the checks. They start from plain columns, never from the JSON log."""

K = "cast(regexp_extract(props, '([0-9]+)', 1) as {t})"


def num(x: str) -> str:
    return f"round(cast({x} as double), 6)"


def text_date(x: str) -> str:
    return f"cast(cast({x} as date) as varchar)"


TRADES = f"""
trades as (
  select event_id as trade_id, user_id % 3 + 1 as symbol_id,
         cast(value as decimal(18,8)) as price, {K.format(t="decimal(18,8)")} as quantity,
         cast(cast(value as decimal(12,2)) * {K.format(t="decimal(12,2)")} as decimal(38,16)) as quote_qty,
         event_type in ('view', 'click') as is_buyer_maker, ts as trade_time, event_type
  from events)"""


def bars(unit: str) -> str:
    return f"""
bars as (
  select symbol_id, date_trunc('{unit}', trade_time) as bar,
         arg_min(price, trade_time) as open, max(price) as high, min(price) as low,
         arg_max(price, trade_time) as close, sum(quantity) as volume, sum(quote_qty) as quote_volume,
         count(*) as trade_count
  from trades group by all)"""


BOOK = f"""
book as (
  select event_id, ts, event_type, user_id % 3 + 1 as symbol_id,
         case when user_id % 2 = 0 then 'bid' else 'ask' end as side,
         cast(floor(value) as bigint) as price_level, {K.format(t="bigint")} as quantity
  from events)"""

LIVE_ONLY = """
live as (
  select symbol_id, side, price_level, quantity, event_id as last_update_id, ts as updated_at
  from book
  qualify row_number() over (partition by symbol_id, side, price_level order by event_id desc) = 1
      and event_type <> 'error' and quantity <> 0)"""

LIVE = f"{BOOK}, {LIVE_ONLY}"

STATUS = """
history as (
  select user_id as symbol_id,
         case event_type when 'error' then 'HALT' when 'signup' then 'BREAK' else 'TRADING' end as status,
         cast(value as decimal(12,2)) as tick_size, ts
  from events)"""

VERSIONS = (
    STATUS
    + """,
opened as (
  select symbol_id, status, tick_size, ts as valid_from from history
  qualify lag(status) over (partition by symbol_id order by ts) is distinct from status),
versions as (
  select *, lead(valid_from) over (partition by symbol_id order by valid_from) as valid_to from opened)"""
)

# The change log of the book, seen from its columns.
BOOK_LOG = (
    BOOK
    + """,
book_log as (
  select 'orderbook_levels' as src_table, event_id * 2 as kafka_offset,
         case when event_type = 'error' then 'd'
              when lag(event_id) over w is null then 'c' else 'u' end as op,
         epoch_us(ts) // 1000 as ts_ms, event_id as source_lsn, symbol_id, ts,
         lag(event_id) over w as prev_id, *exclude (symbol_id, ts)
  from book window w as (partition by symbol_id, side, price_level order by event_id))"""
)

TRADE_LOG = f"""
trade_log as (
  select 'trades' as src_table, event_id as kafka_offset, {K.format(t="bigint")} as k,
         case when k = 0 then null when event_type = 'error' then 'u'
              when event_type = 'signup' then 'r' else 'c' end as op,
         case when k <> 0 then epoch_us(ts) // 1000 end as ts_ms,
         case when k <> 0 then event_id end as source_lsn,
         case when k <> 0 then user_id % 3 + 1 end as symbol_id, ts, event_type
  from events)"""

SYMBOL_LOG = """
symbol_log as (
  select 'symbols' as src_table, event_id as kafka_offset,
         case when event_type = 'purchase' then 'd' else 'u' end as op,
         epoch_us(ts) // 1000 as ts_ms, event_id as source_lsn, user_id as symbol_id, ts
  from events)"""

EXCHANGE_LOG = """
exchange_log as (
  select 'exchanges' as src_table, s_suppkey as kafka_offset, 'r' as op,
         1704067200000 as ts_ms, s_suppkey as source_lsn, cast(null as bigint) as symbol_id
  from supplier)"""

ENVELOPES = f"{BOOK_LOG}, {TRADE_LOG}, {SYMBOL_LOG}, {EXCHANGE_LOG}" + """,
envelopes as (
  select src_table, kafka_offset, op, ts_ms, source_lsn, symbol_id,
         op <> 'd' as has_after, op <> 'c' as has_before from book_log
  union all
  select src_table, kafka_offset, op, ts_ms, source_lsn, symbol_id, op is not null, false from trade_log
  union all
  select src_table, kafka_offset, op, ts_ms, source_lsn, symbol_id, op <> 'd', op = 'd' from symbol_log
  union all
  select src_table, kafka_offset, op, ts_ms, source_lsn, symbol_id, true, false from exchange_log)"""

EXCHANGES = """
exchanges as (
  select s_suppkey as exchange_id, s_name as name, r_name as region
  from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""

DIM_SOURCE = """
src as (
  select s_suppkey + shift * 100000000 as s_suppkey,
         case when s_nationkey >= 20 then upper(s_name) else s_name end as s_name, s_nationkey,
         case when s_nationkey < 10 then s_acctbal + 1 else s_acctbal end as s_acctbal,
         s_nationkey = 15 as deleted
  from supplier join (values (0), (1)) as d(shift) on shift = 0 or s_nationkey between 10 and 14
  where s_acctbal >= 0)"""

LEVEL_NUMBERS = "symbol_id, side, " + num("price_level") + " as price_level, " + num("quantity") + " as quantity"
