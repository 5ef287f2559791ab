"""Registered queries over the order book."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions.schemas import CURRENT, KEYS
from ledgerline.operators import book, cdc, depth
from ledgerline.operators import quality as q
from ledgerline.plans import inputs, marts
from ledgerline.plans import sql as s
from ledgerline.plans.queries_log import SLICES, ship, staged
from ledgerline.plans.registry import query
from ledgerline.session import new_run_dir
from ledgerline.sources.log import file_log
from ledgerline.streaming.current import VERSION, CurrentState, start_current
from ledgerline.streaming.keyed import KeyedOutput, start_keyed
from ledgerline.streaming.tables import MergedTable

_STATE = f"""
with {s.LIVE}
select {s.LEVEL_NUMBERS}, last_update_id, updated_at from live"""


def _changes(log):
    return cdc.book_changes(cdc.decode(log))


def _live(spark, sf_dir):
    return book.live_levels(_changes(inputs.book_log(spark, sf_dir)))


def _diffs(spark, sf_dir):
    """Depth diffs straight from the feed; a quantity of zero removes the level."""
    return inputs.book_events(spark, sf_dir).select(
        *book.LEVEL,
        F.when(F.col("event_type") == "error", 0).otherwise(F.col("quantity")).alias("quantity"),
        F.col("event_id").alias("last_update_id"),
        "ts",
    )


def _at_cut(spark, sf_dir):
    diffs = _diffs(spark, sf_dir)
    version = diffs.where(F.col("ts") < inputs.at(inputs.CUT)).agg(F.max("last_update_id")).scalar()
    return book.book_at_version(diffs.drop("ts"), version)


def _at_end(spark, sf_dir):
    diffs = _diffs(spark, sf_dir).drop("ts")
    return book.book_at_version(diffs, diffs.agg(F.max("last_update_id")).scalar())


@query("book_current_state", _STATE)
def book_current_state(spark, sf_dir):
    """The first half of the log builds the stored book, the second half is merged into it."""
    log = inputs.book_log(spark, sf_dir)
    early = F.col("ts") < inputs.at(inputs.CUT)
    stored = book.live_levels(_changes(log.where(early)))
    return book.merge_levels(stored, _changes(log.where(~early)))


@query("book_current_state_stream", _STATE)
def book_current_state_stream(spark, sf_dir):
    root = new_run_dir(spark, "stream")
    state = CurrentState(f"{root}/current", compact_every=2)
    for _ in ship(inputs.book_log(spark, sf_dir), f"{root}/log"):
        stream = file_log(spark, f"{root}/log")
        once = {"availableNow": True}
        start_current(stream, state, f"{root}/checkpoint", once, name=root).awaitTermination()
    return state.read(spark, "orderbook_levels")


@query("book_state_store_stream", _STATE)
def book_state_store_stream(spark, sf_dir):
    """The same state kept by Spark's state store, through a restart for every slice."""
    root = new_run_dir(spark, "keyed")
    output = KeyedOutput(f"{root}/out", KEYS["orderbook_levels"], CURRENT["orderbook_levels"])
    for n in ship(inputs.book_log(spark, sf_dir), f"{root}/log"):
        changes = cdc.book_changes(cdc.decode(file_log(spark, f"{root}/log")))
        start_keyed(changes, output, VERSION, f"{root}/checkpoint", {"availableNow": True}, root).awaitTermination()
        if n == 2:
            output.compact(spark, upto=1)
            output.remove_below(spark, 1)
    return output.current(spark)


@query("book_version_guard", _STATE)
def book_version_guard(spark, sf_dir):
    """The slices of the log arrive in reverse; the guard still leaves the newest versions."""
    table = MergedTable(
        new_run_dir(spark, "book"),
        KEYS["orderbook_levels"],
        CURRENT["orderbook_levels"],
        guard=VERSION,
    )
    log = staged(inputs.book_log(spark, sf_dir), new_run_dir(spark, "log"))
    for batch_id, n in enumerate(reversed(range(SLICES))):
        table.apply(_changes(log.where(F.col("slice") == n)), batch_id, VERSION)
        if batch_id == 2:
            table.compact(spark, batch_id)
    return table.current(spark)


@query(
    "stg_orderbook",
    f"""
with {s.LIVE}
select symbol_id, lower(upper(side)) as side, {s.num("price_level")} as price_level,
       {s.num("quantity")} as quantity, last_update_id, updated_at from live""",
)
def stg_orderbook(spark, sf_dir):
    """Sides as some feeds write them, in capitals."""
    return marts.staged_levels(_live(spark, sf_dir).withColumn("side", F.upper("side")))


_CUT_BOOK = f"""
{s.BOOK},
cut as (
  select symbol_id, side, price_level, quantity from book where ts < timestamp '{inputs.CUT}'
  qualify row_number() over (partition by symbol_id, side, price_level order by event_id desc) = 1
      and event_type <> 'error' and quantity <> 0)"""


@query(
    "book_as_of_version",
    f"with {_CUT_BOOK} select symbol_id, side, price_level, quantity from cut",
)
def book_as_of_version(spark, sf_dir):
    return _at_cut(spark, sf_dir).drop("last_update_id")


@query(
    "book_state_diff",
    f"""
with {_CUT_BOOK}, {s.LIVE_ONLY},
kept as (select *, 1 as late from live), was as (select *, 1 as early from cut)
select symbol_id, side, price_level,
       case when early is null then 'c' when late is null then 'd' else 'u' end as op,
       coalesce(kept.quantity, -1) as quantity
from was full outer join kept using (symbol_id, side, price_level)
where early is null or late is null or was.quantity <> kept.quantity""",
)
def book_state_diff(spark, sf_dir):
    diff = book.level_changes(_at_cut(spark, sf_dir), _at_end(spark, sf_dir))
    return diff.withColumn("quantity", F.coalesce("quantity", F.lit(-1)))


@query(
    "book_state_diff_apply",
    f"with {s.LIVE} select symbol_id, side, price_level, quantity from live",
)
def book_state_diff_apply(spark, sf_dir):
    """Diff and apply: the earlier book plus the difference is the later book."""
    stored = _at_cut(spark, sf_dir)
    return book.apply_level_changes(stored, book.level_changes(stored, _at_end(spark, sf_dir)))


@query(
    "depth_snapshot_levels",
    f"""
with {s.BOOK}, last as (
  select symbol_id, side, price_level, arg_max(quantity, event_id) as quantity, max(event_id) as last_id
  from book group by all),
pages as (select *, max(last_id) over (partition by symbol_id, price_level // 100) as page_id from last)
select symbol_id, side, {s.num("price_level")} as price_level, {s.num("quantity")} as quantity,
       page_id as last_update_id
from pages where quantity > 0""",
)
def depth_snapshot_levels(spark, sf_dir):
    return book.snapshot_levels(inputs.snapshot_messages(spark, sf_dir))


@query(
    "book_top_n",
    f"""
with {s.LIVE}
select {s.LEVEL_NUMBERS} from live
qualify row_number() over (partition by symbol_id, side
                           order by if(side = 'bid', -price_level, price_level)) <= 20""",
)
def book_top_n(spark, sf_dir):
    return book.top_levels(_live(spark, sf_dir), 20).select(*book.LEVEL, "quantity")


@query(
    "book_depth_imbalance",
    f"""
with {s.LIVE}, top as (
  select * from live
  qualify row_number() over (partition by symbol_id, side
                             order by if(side = 'bid', -price_level, price_level)) <= 20),
sums as (
  select symbol_id, cast(sum(if(side = 'bid', quantity, 0)) as double) as bid_quantity,
         cast(sum(if(side = 'ask', quantity, 0)) as double) as ask_quantity
  from top group by symbol_id)
select *, round((bid_quantity - ask_quantity) / (bid_quantity + ask_quantity), 6) as imbalance from sums""",
)
def book_depth_imbalance(spark, sf_dir):
    out = book.depth_imbalance(_live(spark, sf_dir), 20)
    return out.withColumn("imbalance", F.round("imbalance", 6))


_TOP = f"""
{s.LIVE},
quotes as (
  select symbol_id, max(last_update_id) as book_version,
         cast(arg_max(price_level, last_update_id) filter (side = 'bid') as double) as best_bid,
         cast(arg_max(price_level, last_update_id) filter (side = 'ask') as double) as best_ask,
         count(*) filter (side = 'bid') as bid_levels, count(*) filter (side = 'ask') as ask_levels
  from live group by symbol_id)"""


@query(
    "fct_book_snapshot",
    f"""
with {_TOP}
select symbol_id, book_version, best_bid, best_ask, best_ask - best_bid as spread,
       case when best_bid > 0 then round((best_ask - best_bid) / best_bid * 100, 6) end as spread_pct,
       bid_levels, ask_levels
from quotes""",
)
def fct_book_snapshot(spark, sf_dir):
    out = book.top_of_book(marts.staged_levels(_live(spark, sf_dir)))
    return out.withColumn("spread_pct", F.round("spread_pct", 6))


@query(
    "book_best_quote",
    f"""
with {s.LIVE}
select symbol_id, cast(max(price_level) filter (side = 'bid') as double) as best_bid,
       cast(min(price_level) filter (side = 'ask') as double) as best_ask,
       coalesce(best_ask < best_bid, false) as is_crossed
from live group by symbol_id""",
)
def book_best_quote(spark, sf_dir):
    quotes = book.best_quote(_live(spark, sf_dir))
    return quotes.withColumn("is_crossed", F.coalesce("is_crossed", F.lit(False)))


@query(
    "dq_spread",
    f"""
with {_TOP}
select symbol_id, best_bid, best_ask, best_ask - best_bid as spread from quotes where best_ask < best_bid""",
)
def dq_spread(spark, sf_dir):
    return q.negative_spreads(book.top_of_book(_live(spark, sf_dir)))


@query(
    "depth_gap_detect",
    """
with numbered as (
  select user_id % 3 + 1 as symbol_id, event_type,
         3 * row_number() over (partition by user_id % 3 order by event_id) as u from events),
snap as (select symbol_id, min(u) + 1 as snap from numbered where event_type = 'signup' group by symbol_id),
fresh as (
  select n.symbol_id, u - 2 as first_u, u as last_u, snap, lag(u) over (partition by n.symbol_id order by u) as prev
  from numbered n join snap using (symbol_id) where u > snap and event_type <> 'error'),
marked as (
  select *, case when prev is null then not (first_u <= snap + 1 and snap + 1 <= last_u)
                 else first_u <> prev + 1 end as is_gap from fresh)
select symbol_id, first_u, last_u, is_gap,
       cast(sum(is_gap::int) over (partition by symbol_id order by last_u) as bigint) as resync_epoch
from marked""",
)
def depth_gap_detect(spark, sf_dir):
    """Sign-ups stand for snapshots; the first one of a symbol starts its sequence."""
    feed = inputs.depth_feed(spark, sf_dir)
    snapshots = (
        feed.where(F.col("event_type") == "signup")
        .groupBy("symbol_id")
        .agg((F.min("last_u") + 1).alias("last_update_id"))
    )
    events = feed.where(F.col("event_type") != "error").drop("event_type")
    return book.check_sequence(events, snapshots)


@query(
    "book_top_n_diff",
    f"""
with {s.BOOK},
changes as (
  select symbol_id, side, price_level, if(event_type = 'error', 0, quantity) as quantity, event_id,
         row_number() over (partition by symbol_id, side order by event_id) as k from book),
spans as (
  select symbol_id, side, price_level, quantity, k as since,
         coalesce(lead(k) over (partition by symbol_id, side, price_level order by k), 9223372036854775807) as until
  from changes),
tops as (
  select c.symbol_id, c.side, c.k, s.price_level, s.quantity
  from changes c join spans s
    on s.symbol_id = c.symbol_id and s.side = c.side and s.since <= c.k and c.k < s.until and s.quantity > 0
  qualify row_number() over (partition by c.symbol_id, c.side, c.k
                             order by if(c.side = 'bid', -s.price_level, s.price_level)) <= 20),
both_ as (
  select symbol_id, side, k, price_level, max(quantity) filter (which = 'new') as new, max(quantity) filter (which = 'old') as old
  from (select symbol_id, side, k, price_level, quantity, 'new' as which from tops
        union all
        select symbol_id, side, k + 1, price_level, quantity, 'old' from tops)
  group by symbol_id, side, k, price_level)
select symbol_id, side, {s.num("price_level")} as price_level, event_id as version,
       case when old is null then 'c' when new is null then 'd' else 'u' end as op,
       coalesce({s.num("new")}, -1) as quantity
from both_ join (select symbol_id, side, k, event_id from changes) using (symbol_id, side, k)
where new is distinct from old""",
)
def book_top_n_diff(spark, sf_dir):
    """What every change of the book does to the best 20 levels of its side."""
    diffs = _diffs(spark, sf_dir).withColumnRenamed("last_update_id", "version").drop("ts")
    found = depth.top_level_diffs(diffs, new_run_dir(spark, "depth"))
    return found.withColumn("quantity", F.coalesce("quantity", F.lit(-1)))


@query(
    "book_from_feed",
    f"""
with {s.BOOK},
numbered as (
  select *, row_number() over (partition by symbol_id order by event_id) as n, count(*) over (partition by symbol_id) as total
  from book),
-- The last change of the last message that applies after each snapshot.
epochs as (
  select distinct symbol_id, total // 4 as snapshot_id, (total * 3 // 8 // 4) * 4 - 1 as upto from numbered
  union all
  select distinct symbol_id, total // 2, (total * 7 // 8 // 4) * 4 - 1 from numbered)
select symbol_id, snapshot_id, side, {s.num("price_level")} as price_level, {s.num("quantity")} as quantity,
       if(n // 4 >= (snapshot_id + 1) // 4, (n // 4) * 4 + 3, snapshot_id) as last_update_id
from numbered join epochs using (symbol_id)
where n <= upto
qualify row_number() over (partition by symbol_id, snapshot_id, side, price_level order by n desc) = 1
    and event_type <> 'error' and quantity <> 0""",
)
def book_from_feed(spark, sf_dir):
    """Two snapshots and a gap after each: the book up to either gap."""
    return depth.book_from_feed(inputs.depth_messages(spark, sf_dir))
