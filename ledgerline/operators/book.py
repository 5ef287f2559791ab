"""Order-book state: rebuild it, compare it, measure it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.exprs import to_money
from ledgerline.functions.schemas import MONEY
from ledgerline.operators.latest import first_ranked, latest_per_key
from ledgerline.operators.merge import keyed_merge
from ledgerline.operators.ordered import CHUNK, WIDTH, chunked, in_ranges

LEVEL = ["symbol_id", "side", "price_level"]
TRACKED_DEPTH = 20


def latest_levels(changes: DataFrame) -> DataFrame:
    """Last change per level. A delete repeats its before-image's id, so the offset decides."""
    return latest_per_key(changes, LEVEL, ["last_update_id", "kafka_offset"])


def live_levels(changes: DataFrame) -> DataFrame:
    """Current book from a complete change log."""
    kept = latest_levels(changes).where(~F.col("deleted"))
    return kept.drop("deleted", "kafka_offset")


def merge_levels(state: DataFrame, changes: DataFrame, version_guard: bool = False) -> DataFrame:
    """Apply one batch of changes to a stored book.

    Without the guard a batch always overwrites. With it a change older than the stored level
    is ignored; a delete carries the id it deletes, so equal ids still apply.
    """
    newer = (lambda n, o: n["last_update_id"] >= o["last_update_id"]) if version_guard else None
    return keyed_merge(state, latest_levels(changes), LEVEL, update_when=newer)


def book_at_version(diffs: DataFrame, version) -> DataFrame:
    """Book after all diffs up to ``version``: the last quantity per level, zero removes it."""
    upto = diffs.where(F.col("last_update_id") <= version)
    return latest_per_key(upto, LEVEL, ["last_update_id"]).where(F.col("quantity") != 0)


def top_levels(levels: DataFrame, depth: int = TRACKED_DEPTH) -> DataFrame:
    """Best ``depth`` levels per symbol and side: highest bids, lowest asks."""
    signed = F.when(F.col("side") == "bid", -F.col("price_level")).otherwise(F.col("price_level"))
    return first_ranked(levels, ["symbol_id", "side"], [signed.asc()], depth)


def level_changes(stored: DataFrame, wanted: DataFrame) -> DataFrame:
    """What turns one book into another: ``c`` new, ``u`` other quantity, ``d`` gone.

    Always compare with the stored state: starting from an empty one forgets the deletes.
    """
    old = stored.select(*LEVEL, F.struct("quantity").alias("old"))
    new = wanted.select(*LEVEL, F.struct("quantity").alias("new"))
    o, n = F.col("old"), F.col("new")
    op = (
        F.when(o.isNull(), "c")
        .when(n.isNull(), "d")
        .when(~o["quantity"].eqNullSafe(n["quantity"]), "u")
    )
    return (
        old.join(new, LEVEL, "full_outer")
        .withColumn("op", op)
        .where(F.col("op").isNotNull())
        .select(*LEVEL, "op", n["quantity"].alias("quantity"))
    )


def apply_level_changes(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """Apply the result of ``level_changes``; ``stored`` has the level key and ``quantity``."""
    flagged = changes.withColumn("deleted", F.col("op") == "d")
    return keyed_merge(stored.select(*LEVEL, "quantity"), flagged, LEVEL)


def snapshot_levels(messages: DataFrame) -> DataFrame:
    """Levels of depth-snapshot messages (symbol_id, payload JSON); empty levels are dropped."""
    pairs = "array<array<string>>"
    body = F.from_json("payload", f"lastUpdateId bigint, bids {pairs}, asks {pairs}")
    sides = F.explode(
        F.array(
            F.struct(F.lit("bid").alias("side"), F.col("body")["bids"].alias("levels")),
            F.struct(F.lit("ask").alias("side"), F.col("body")["asks"].alias("levels")),
        )
    )
    pair = F.col("pair")
    return (
        messages.select("symbol_id", body.alias("body"))
        .select("symbol_id", F.col("body")["lastUpdateId"].alias("last_update_id"), sides.alias("s"))
        .select("symbol_id", "last_update_id", "s.side", F.explode("s.levels").alias("pair"))
        .select(
            "symbol_id",
            "side",
            to_money(pair[0]).alias("price_level"),
            to_money(pair[1]).alias("quantity"),
            "last_update_id",
        )
        .where(F.col("quantity") > 0)
    )


def sequenced(events: DataFrame, snapshots: DataFrame, width: int = WIDTH, path: str | None = None) -> DataFrame:
    """Depth events (symbol_id, first_u, last_u, ...) that some snapshot of their symbol precedes.

    Adds ``snapshot_id`` (the last snapshot below the event), ``is_gap``, ``resync_epoch`` and ``applies``: a
    gap ends what can be applied until the next snapshot. See ``check_sequence`` for the rules.

    Events and snapshots go through one exchange; everything that crosses a chunk's border is one row per
    chunk. With ``path`` chunks are ranges of the data (``in_ranges``), else of ids.
    """
    keys, axis, snap = ["symbol_id"], "__axis", F.col("__snap")
    # Events and snapshots on one axis: an event that ends at a snapshot's id still comes before it.
    points = events.withColumns({axis: F.col("last_u") * 2, "__snap": F.lit(None).cast("bigint")}).unionByName(
        snapshots.select("symbol_id", F.col("last_update_id").alias("__snap"))
        .distinct()
        .withColumn(axis, snap * 2 + 1),
        allowMissingColumns=True,
    )
    if path:
        points = in_ranges(points, keys, axis, path)
    cut = chunked(points, keys, axis, 2 * width)
    piece = [*keys, CHUNK]
    before = Window.partitionBy(*piece).orderBy(axis).rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy(*piece).orderBy(axis).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)

    # Ids grow along the axis, so the largest one so far is the last one.
    seen = cut.withColumns({"__s": F.max(snap).over(before), "__p": F.max("last_u").over(before)})
    last = cut.groupBy(*piece).agg(F.max(snap).alias("s"), F.max("last_u").alias("p"))
    carried = last.select(*piece, F.max("s").over(earlier).alias("s"), F.max("p").over(earlier).alias("p"))
    known = seen.join(carried, piece, "left").withColumns(
        {"snapshot_id": F.coalesce("__s", "s"), "__p": F.coalesce("__p", "p")}
    )
    fresh = known.where(snap.isNull() & F.col("snapshot_id").isNotNull())
    start, end, base = F.col("first_u"), F.col("last_u"), F.col("snapshot_id")
    follows = F.col("__p") > base
    ok = F.when(follows, start == F.col("__p") + 1).otherwise((start <= base + 1) & (base + 1 <= end))
    marked = fresh.select(*events.columns, CHUNK, axis, "snapshot_id", (~F.coalesce(ok, F.lit(False))).alias("is_gap"))

    gap = F.when(F.col("is_gap"), end)
    counted = marked.withColumns({"__n": F.count(gap).over(upto), "__g": F.max(gap).over(upto)})
    totals = marked.groupBy(*piece).agg(F.count(gap).alias("n"), F.max(gap).alias("g"))
    sums = totals.select(*piece, F.sum("n").over(earlier).alias("n"), F.max("g").over(earlier).alias("g"))
    return counted.join(sums, piece, "left").select(
        *events.columns,
        "snapshot_id",
        "is_gap",
        (F.col("__n") + F.coalesce("n", F.lit(0))).alias("resync_epoch"),
        (F.coalesce(F.greatest("__g", "g"), base) <= base).alias("applies"),
    )


def check_sequence(events: DataFrame, snapshots: DataFrame, width: int = WIDTH, path: str | None = None) -> DataFrame:
    """Continuity of depth events (symbol_id, first_u, last_u) after each snapshot of their symbol.

    An event belongs to the last snapshot below it; events that no snapshot precedes are dropped.
    The first event of a snapshot must straddle the snapshot's next id and each later one must
    start where its predecessor ended. ``is_gap`` marks the events that break this,
    ``resync_epoch`` counts the breaks of the symbol so far.
    """
    return sequenced(events, snapshots, width, path).drop("snapshot_id", "applies")


def top_of_book(levels: DataFrame) -> DataFrame:
    """One row per symbol: the most recently updated level of each side is the quote.

    Levels far from the mid can go stale in a book kept from diffs, so the best price over all
    levels may be crossed; freshness decides instead. Of levels sharing the newest update id the
    highest bid and the lowest ask win.
    """
    bid, ask = F.col("side") == "bid", F.col("side") == "ask"
    price, version = F.col("price_level"), F.col("last_update_id")
    fresh_bid = F.when(bid & version.isNotNull(), F.struct(version, price))
    fresh_ask = F.when(ask & version.isNotNull(), F.struct(version, (-price).alias("p")))
    quotes = levels.groupBy("symbol_id").agg(
        F.max("last_update_id").alias("book_version"),
        F.max_by("price_level", fresh_bid).alias("best_bid"),
        F.max_by("price_level", fresh_ask).alias("best_ask"),
        F.count_if(bid).alias("bid_levels"),
        F.count_if(ask).alias("ask_levels"),
    )
    # Spark drops a decimal place when it subtracts two decimal(38,18); one digit less is exact.
    bid_price, ask_price = (F.col(c).try_cast("decimal(37,18)") for c in ("best_bid", "best_ask"))
    gap = F.coalesce(ask_price - bid_price, F.col("best_ask") - F.col("best_bid"))
    pct = F.when(
        F.col("best_bid") > 0, gap.cast("double") / F.col("best_bid").cast("double") * 100
    )
    return quotes.select(
        "symbol_id",
        "book_version",
        "best_bid",
        "best_ask",
        gap.cast(MONEY).alias("spread"),
        pct.alias("spread_pct"),
        "bid_levels",
        "ask_levels",
    )


def best_quote(levels: DataFrame) -> DataFrame:
    """True best bid and ask over all live levels, and whether they cross."""
    bid = F.when(F.col("side") == "bid", F.col("price_level"))
    ask = F.when(F.col("side") == "ask", F.col("price_level"))
    quotes = levels.groupBy("symbol_id").agg(F.max(bid).alias("best_bid"), F.min(ask).alias("best_ask"))
    return quotes.withColumn("is_crossed", F.col("best_ask") < F.col("best_bid"))


def depth_imbalance(levels: DataFrame, depth: int = TRACKED_DEPTH) -> DataFrame:
    """(bid - ask) / (bid + ask) quantity over the tracked levels; NULL for an empty book."""
    qty = F.col("quantity").cast("double")
    sums = top_levels(levels, depth).groupBy("symbol_id").agg(
        F.sum(F.when(F.col("side") == "bid", qty).otherwise(0.0)).alias("bid_quantity"),
        F.sum(F.when(F.col("side") == "ask", qty).otherwise(0.0)).alias("ask_quantity"),
    )
    total = F.col("bid_quantity") + F.col("ask_quantity")
    skew = F.when(total > 0, (F.col("bid_quantity") - F.col("ask_quantity")) / total)
    return sums.withColumn("imbalance", skew)
