"""Inputs of the registered queries, derived by Spark from the given tables.

``events`` plays the market feed: one event is one trade and one order-book change. Its rows
are turned into the change log, feed messages and dimension changes the operators expect.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.ordered import with_previous, with_row_number
from ledgerline.sources.log import TOPIC_PREFIX
from ledgerline.sources.tables import spread, table

_ISO = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
_EXPLICIT_NULLS = {"ignoreNullFields": "false"}

CUT = "2024-01-16"


def at(day: str) -> Column:
    return F.lit(f"{day} 00:00:00").cast("timestamp_ntz")


def _symbol() -> Column:
    return (F.col("user_id") % 3 + 1).alias("symbol_id")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with the number ``k`` taken out of their JSON properties, parsed once."""
    rows = spread(table(spark, sf_dir, "events"))
    return rows.select("*", F.json_tuple("props", "k").alias("k")).drop("props")


def _record(topic: str, offset: Column, value: Column, ts: str) -> list[Column]:
    """A log record. The explode makes sure that its JSON is written once per record."""
    once = F.explode(F.array(F.struct(offset.alias("offset"), value.alias("value"))))
    return [F.lit(TOPIC_PREFIX + topic).alias("topic"), F.lit(0).alias("partition"), once.alias("r"), F.col(ts).alias("ts")]


_RECORD = ["topic", "partition", "r.offset", "r.value", "ts"]


def _iso(ts: str) -> Column:
    return F.date_format(ts, _ISO)


def _millis(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """every event as a trade. Operands of two decimals keep the product exact."""
    k = F.col("k")
    return events(spark, sf_dir).select(
        F.col("event_id").alias("trade_id"),
        _symbol(),
        F.col("value").cast("decimal(18,8)").alias("price"),
        k.cast("decimal(18,8)").alias("quantity"),
        (F.col("value").cast("decimal(12,2)") * k.cast("decimal(12,2)"))
        .cast("decimal(38,16)")
        .alias("quote_qty"),
        F.col("event_type").isin("view", "click").alias("is_buyer_maker"),
        F.col("ts").alias("trade_time"),
        "event_type",
    )


def redelivered_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1d: the trades, with every purchase delivered twice."""
    rows = trades(spark, sf_dir)
    again = F.when(F.col("event_type") == "purchase", F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return rows.withColumn("delivery", F.explode(again))


def book_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a change of one level; an error deletes it, anything else sets it."""
    return events(spark, sf_dir).select(
        "event_id",
        "ts",
        "event_type",
        _symbol(),
        F.when(F.col("user_id") % 2 == 0, "bid").otherwise("ask").alias("side"),
        F.floor("value").cast("bigint").alias("price_level"),
        F.col("k").cast("bigint").alias("quantity"),
    )


def book_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the change log of the book as JSON envelopes, with tombstones after deletes."""
    rows = with_previous(
        book_events(spark, sf_dir),
        ["symbol_id", "side", "price_level"],
        "event_id",
        {"event_id": "prev_id", "quantity": "prev_quantity"},
    )
    first = F.col("prev_id").isNull()
    op = F.when(F.col("event_type") == "error", "d").when(first, "c").otherwise("u")

    def image(quantity: str, update_id: str) -> Column:
        return F.struct(
            "symbol_id",
            "side",
            F.col("price_level").cast("string").alias("price_level"),
            F.coalesce(F.col(quantity), F.col("quantity")).cast("string").alias("quantity"),
            F.coalesce(F.col(update_id), F.col("event_id")).alias("last_update_id"),
            _iso("ts").alias("updated_at"),
        )

    envelope = F.struct(
        "op",
        _millis("ts").alias("ts_ms"),
        F.struct(F.col("event_id").alias("lsn")).alias("source"),
        F.when(F.col("op") != "c", image("prev_quantity", "prev_id")).alias("before"),
        F.when(F.col("op") != "d", image("quantity", "event_id")).alias("after"),
    )
    change = F.struct(
        (F.col("event_id") * 2).alias("offset"), F.to_json(envelope, _EXPLICIT_NULLS).alias("value")
    )
    tombstone = F.struct(
        (F.col("event_id") * 2 + 1).alias("offset"), F.lit(None).cast("string").alias("value")
    )
    records = F.when(F.col("op") == "d", F.array(change, tombstone)).otherwise(F.array(change))
    return rows.withColumn("op", op).select(
        F.lit(f"{TOPIC_PREFIX}orderbook_levels").alias("topic"),
        F.lit(0).alias("partition"),
        F.explode(records).alias("record"),
        "ts",
    ).select("topic", "partition", "record.*", "ts")


def trade_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the change log of the trades.

    Sign-ups arrive as snapshot reads, errors as updates (which trades never have), and a trade
    of quantity zero as text that is not JSON.
    """
    op = (
        F.when(F.col("event_type") == "error", "u")
        .when(F.col("event_type") == "signup", "r")
        .otherwise("c")
    )
    after = F.struct(
        "trade_id",
        "symbol_id",
        F.col("price").cast("string").alias("price"),
        F.col("quantity").cast("string").alias("quantity"),
        F.col("quote_qty").cast("string").alias("quote_qty"),
        "is_buyer_maker",
        _iso("trade_time").alias("trade_time"),
        _iso("trade_time").alias("ingested_at"),
    )
    envelope = F.struct(
        op.alias("op"),
        _millis("trade_time").alias("ts_ms"),
        F.struct(F.col("trade_id").alias("lsn")).alias("source"),
        F.lit(None).cast("string").alias("before"),
        after.alias("after"),
    )
    value = F.when(F.col("quantity") == 0, "garbage").otherwise(F.to_json(envelope, _EXPLICIT_NULLS))
    rows = trades(spark, sf_dir).select(*_record("trades", F.col("trade_id"), value, "trade_time"))
    return rows.select(*_RECORD)


def symbol_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of the symbol dimension: one entity per user, its status set by each event."""
    op = F.when(F.col("event_type") == "purchase", "d").otherwise("u")
    image = F.struct(
        F.col("user_id").alias("symbol_id"),
        F.concat(F.lit("SYM"), F.col("user_id").cast("string")).alias("symbol"),
        F.lit("BASE").alias("base_asset"),
        F.lit("QUOTE").alias("quote_asset"),
        status().alias("status"),
        F.col("value").cast("decimal(12,2)").cast("string").alias("tick_size"),
        F.col("k").alias("step_size"),
        _iso("ts").alias("created_at"),
        _iso("ts").alias("updated_at"),
    )
    is_delete = F.col("op") == "d"
    envelope = F.struct(
        "op",
        _millis("ts").alias("ts_ms"),
        F.struct(F.col("event_id").alias("lsn")).alias("source"),
        F.when(is_delete, image).alias("before"),
        F.when(~is_delete, image).alias("after"),
    )
    value = F.to_json(envelope, _EXPLICIT_NULLS)
    rows = events(spark, sf_dir).withColumn("op", op)
    return rows.select(*_record("symbols", F.col("event_id"), value, "ts")).select(*_RECORD)


def exchange_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exchange dimension as snapshot reads: every supplier is an exchange in its region."""
    envelope = F.struct(
        F.lit("r").alias("op"),
        F.lit(1704067200000).alias("ts_ms"),
        F.struct(F.col("exchange_id").alias("lsn")).alias("source"),
        F.lit(None).cast("string").alias("before"),
        F.struct("exchange_id", "name", "region", F.lit("2024-01-01T00:00:00Z").alias("updated_at")).alias(
            "after"
        ),
    )
    value = F.to_json(envelope, _EXPLICIT_NULLS)
    rows = exchanges(spark, sf_dir).withColumn("ts", at("2024-01-01"))
    return rows.select(*_record("exchanges", F.col("exchange_id"), value, "ts")).select(*_RECORD)


def whole_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = [f(spark, sf_dir) for f in (book_log, trade_log, symbol_log, exchange_log)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def status() -> Column:
    return (
        F.when(F.col("event_type") == "error", "HALT")
        .when(F.col("event_type") == "signup", "BREAK")
        .otherwise("TRADING")
    )


def status_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """status of every user over time; the price stands in for an unchecked attribute."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("symbol_id"),
        status().alias("status"),
        F.col("value").cast("decimal(12,2)").alias("tick_size"),
        "ts",
        "event_id",
    )


def depth_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """three update ids per event and symbol; error events are lost in transit."""
    numbered = with_row_number(
        table(spark, sf_dir, "events").select(_symbol(), "event_id", "event_type"),
        ["symbol_id"],
        "event_id",
        "n",
    )
    return numbered.select(
        "symbol_id",
        (F.col("n") * 3 - 2).alias("first_u"),
        (F.col("n") * 3).alias("last_u"),
        "event_type",
    )


def dimension_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, stored side."""
    return table(spark, sf_dir, "supplier")


def dimension_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6, incoming side: some rows absent, some changed, some deleted, some new.

    Negative balances are absent. The balance changes in nations below 10, only the name in
    nations from 20 on. Nation 15 is flagged deleted. Nations 10 to 14 come a second time under
    new keys.
    """
    nation = F.col("s_nationkey")
    shifts = F.when(nation.between(10, 14), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    balance = F.when(nation < 10, F.col("s_acctbal") + 1).otherwise(F.col("s_acctbal"))
    name = F.when(nation >= 20, F.upper("s_name")).otherwise(F.col("s_name"))
    return (
        table(spark, sf_dir, "supplier")
        .where(F.col("s_acctbal") >= 0)
        .withColumn("shift", F.explode(shifts))
        .select(
            (F.col("s_suppkey") + F.col("shift") * 100_000_000).alias("s_suppkey"),
            name.alias("s_name"),
            "s_nationkey",
            balance.alias("s_acctbal"),
            (nation == 15).alias("deleted"),
        )
    )


def exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as exchanges; nation and region are tables of fixed size (25 and 5 rows)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return (
        table(spark, sf_dir, "supplier")
        .join(places, F.col("s_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("s_suppkey").alias("exchange_id"),
            F.col("s_name").alias("name"),
            F.col("r_name").alias("region"),
        )
    )


def feed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw trade messages; the symbol is named after a supplier, known or not."""
    body = F.struct(
        F.format_string("Supplier#%09d", "user_id").alias("s"),
        F.col("value").cast("decimal(18,8)").cast("string").alias("p"),
        F.col("k").alias("q"),
        F.col("event_id").alias("t"),
        F.col("event_type").isin("view", "click").alias("m"),
        _millis("ts").alias("T"),
    )
    message = F.explode(F.array(F.to_json(F.struct(body.alias("data")))))
    return events(spark, sf_dir).select(message.alias("message"))


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("symbol"), F.col("s_suppkey").alias("symbol_id")
    )


def exchange_info_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol metadata pages of 50 parts each, with the trading rules as a nested list.

    Parts below a size of 10 lack the price rule, parts above 40 the lot rule. The page number
    comes from the unique part key, so no page can outgrow its 50 symbols.
    """
    size, price = F.col("p_size"), F.col("p_retailprice")
    rules = F.array(
        F.when(
            size >= 10,
            F.struct(
                F.lit("PRICE_FILTER").alias("filterType"),
                price.cast("decimal(12,2)").cast("string").alias("tickSize"),
                F.lit(None).cast("string").alias("stepSize"),
            ),
        ),
        F.struct(
            F.lit("MAX_ORDERS").alias("filterType"),
            F.lit(None).cast("string").alias("tickSize"),
            F.lit(None).cast("string").alias("stepSize"),
        ),
        F.when(
            size <= 40,
            F.struct(
                F.lit("LOT_SIZE").alias("filterType"),
                F.lit(None).cast("string").alias("tickSize"),
                size.cast("string").alias("stepSize"),
            ),
        ),
    )
    symbol = F.struct(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"),
        F.col("p_brand").alias("baseAsset"),
        F.col("p_type").alias("quoteAsset"),
        F.lit("TRADING").alias("status"),
        F.filter(rules, lambda r: r.isNotNull()).alias("filters"),
    )
    page = F.floor(F.col("p_partkey") / 50).alias("page")
    return (
        table(spark, sf_dir, "part")
        .groupBy(page)
        .agg(F.collect_list(symbol).alias("symbols"))
        .select(F.to_json(F.struct("symbols")).alias("message"))
    )


def snapshot_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth snapshots: the last quantity of every level, zeros included, in pages of 100 prices.

    Prices are whole numbers and unique per symbol and side, which bounds a page at 200 levels.
    """
    rows = book_events(spark, sf_dir).groupBy("symbol_id", "side", "price_level").agg(
        F.max_by("quantity", "event_id").alias("quantity"), F.max("event_id").alias("last_id")
    )
    pair = F.array(F.col("price_level").cast("string"), F.col("quantity").cast("string"))
    page = F.floor(F.col("price_level") / 100).alias("page")
    message = F.struct(
        F.col("last_id").alias("lastUpdateId"), F.col("bids").alias("bids"), F.col("asks").alias("asks")
    )
    return (
        rows.groupBy("symbol_id", page)
        .agg(
            F.max("last_id").alias("last_id"),
            F.collect_list(F.when(F.col("side") == "bid", pair)).alias("bids"),
            F.collect_list(F.when(F.col("side") == "ask", pair)).alias("asks"),
        )
        .select("symbol_id", F.to_json(message).alias("payload"))
    )


def depth_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every level change with its number n within the symbol, its message, and what befalls the feed.

    Four consecutive ids make a message. Two snapshots are taken, after a quarter and after half of a symbol's
    changes; the messages at three and at seven eighths are lost.
    """
    numbered = with_row_number(book_events(spark, sf_dir), ["symbol_id"], "event_id", "n")
    totals = numbered.groupBy("symbol_id").agg(F.max("n").alias("total"))
    n, total = F.col("n"), F.col("total")

    def message(number) -> Column:
        return F.floor(number / 4)

    taken = F.array(F.floor(total / 4), F.floor(total / 2))
    return numbered.join(totals, "symbol_id").select(
        "symbol_id",
        "side",
        "price_level",
        F.when(F.col("event_type") == "error", 0).otherwise(F.col("quantity")).alias("quantity"),
        "n",
        message(n).alias("message"),
        message(n).isin(message(total * 3 / 8), message(total * 7 / 8)).alias("lost"),
        taken.alias("snapshots"),
    )


def depth_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Depth feed: diff messages, some of them lost, and two snapshots per symbol with the whole book.

    A snapshot comes in pages of 100 prices, which bounds a message; its id may fall inside a message.
    """
    rows = depth_numbers(spark, sf_dir)
    pair = F.array(F.col("price_level").cast("string"), F.col("quantity").cast("string"))

    def side(name: str, order: str) -> Column:
        kept = F.collect_list(F.when(F.col("side") == name, F.struct(F.col(order).alias("at"), pair.alias("pair"))))
        return F.transform(F.array_sort(kept), lambda x: x["pair"])

    diffs = (
        rows.where(~F.col("lost"))
        .groupBy("symbol_id", "message")
        .agg(F.min("n").alias("first"), F.max("n").alias("last"), side("bid", "n").alias("b"), side("ask", "n").alias("a"))
        .select("symbol_id", F.to_json(F.struct(F.lit("depthUpdate").alias("e"), F.col("last").alias("u"), "b", "a")).alias("text"), "first")
        # Two names that differ in case only do not fit into one struct.
        .select("symbol_id", F.concat(F.lit('{"U":'), F.col("first").cast("string"), F.lit(","), F.expr("substring(text, 2)")).alias("payload"))
    )
    book = (
        rows.withColumn("snapshot", F.explode("snapshots"))
        .where(F.col("n") <= F.col("snapshot"))
        .groupBy("symbol_id", "snapshot", "side", "price_level")
        .agg(F.max_by("quantity", "n").alias("quantity"))
    )
    loads = (
        book.groupBy("symbol_id", "snapshot", F.floor(F.col("price_level") / 100).alias("page"))
        .agg(side("bid", "price_level").alias("bids"), side("ask", "price_level").alias("asks"))
        .select("symbol_id", F.to_json(F.struct(F.col("snapshot").alias("lastUpdateId"), "bids", "asks")).alias("payload"))
    )
    return diffs.unionByName(loads)
