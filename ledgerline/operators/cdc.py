"""Change envelopes: decode, type, classify."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import exprs
from ledgerline.functions.schemas import CURRENT, KEYS, LANDING, MONEY, PAYLOADS, columns
from ledgerline.sources.log import TOPIC_PREFIX


def decode(log: DataFrame, topic_prefix: str = TOPIC_PREFIX) -> DataFrame:
    """Log records to change rows; delete tombstones (no value) are dropped.

    ``json_tuple`` reads the record once and leaves the row images as the text they came in.
    ``symbol_id`` falls back to the before-image, so deletes can be routed too.
    """
    fields = ["op", "ts_ms", "source", "before", "after"]
    records = log.where(F.col("value").isNotNull()).select(
        F.col("topic").alias("kafka_topic"),
        F.col("partition").alias("kafka_partition"),
        F.col("offset").alias("kafka_offset"),
        F.col("value").cast("string").alias("value"),
    )
    parsed = records.select("*", F.json_tuple("value", *fields).alias(*fields))
    symbol = F.coalesce(
        F.get_json_object("after", "$.symbol_id"), F.get_json_object("before", "$.symbol_id")
    )
    topic = F.col("kafka_topic")
    stripped = topic.substr(F.lit(len(topic_prefix) + 1), F.length(topic))
    return parsed.select(
        "kafka_topic",
        "kafka_partition",
        "kafka_offset",
        "value",
        F.when(topic.startswith(topic_prefix), stripped).otherwise(topic).alias("src_table"),
        "op",
        F.col("ts_ms").try_cast("bigint").alias("ts_ms"),
        F.get_json_object("source", "$.lsn").try_cast("bigint").alias("source_lsn"),
        "after",
        "before",
        symbol.try_cast("bigint").alias("symbol_id"),
    )


def landing_rows(decoded: DataFrame) -> DataFrame:
    """The uniform append-only layout, plus ``src_table`` for routing.

    ``ingest_date`` is the day of the connector's event time, neither the clock nor the trade.
    """
    day = F.to_date(F.timestamp_millis("ts_ms"))
    return decoded.withColumn("ingest_date", day).select("src_table", *columns(LANDING))


def with_image(decoded: DataFrame, table: str, text: Column | None = None) -> DataFrame:
    """Add ``image``, the parsed row the envelope is about: ``before`` for a delete only.

    Picking the whole image by ``op`` (not column by column) lets an update set a column to NULL.
    The one-element explode keeps the parse in one place: filters on parsed fields would
    otherwise be pushed below it and repeat the parse in every predicate.
    """
    if text is None:
        text = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    parsed = F.explode(F.array(F.from_json(text, PAYLOADS[table])))
    return decoded.select("*", parsed.alias("image"))


def _typed(table: str) -> list[Column]:
    return exprs.conform(F.col("image"), PAYLOADS[table], CURRENT[table])


# What a typed row must have; records without it are rejects.
NEEDED = KEYS | {"orderbook_levels": ["symbol_id", "price_level"], "trades": ["trade_id"]}


def _usable(table: str, parent: str = "") -> Column:
    return reduce(lambda a, b: a & b, [F.col(parent + k).isNotNull() for k in NEEDED[table]])


def book_changes(decoded: DataFrame) -> DataFrame:
    """Typed order-book changes with a three-valued delete flag.

    A delete, a zero quantity and a missing quantity all empty the level. The flag is NULL when
    neither can be told (no ``op``, or a quantity that is not a number); merges then update a
    level they know and ignore one they do not.
    """
    qty = F.coalesce(F.col("image.quantity"), F.lit("0")).try_cast(MONEY)
    rows = with_image(decoded, "orderbook_levels").select(
        *_typed("orderbook_levels"),
        ((F.col("op") == "d") | (qty == 0)).alias("deleted"),
        "kafka_offset",
    )
    return rows.where(_usable("orderbook_levels"))


def trade_rows(decoded: DataFrame) -> DataFrame:
    """Typed trades from inserts and snapshot reads; trades are never updated."""
    inserted = decoded.where(F.col("op").isin("c", "r"))
    rows = with_image(inserted, "trades", F.col("after")).select(*_typed("trades"), "kafka_offset")
    return rows.where(_usable("trades"))


def dimension_changes(decoded: DataFrame, table: str) -> DataFrame:
    """Typed changes of a small keyed table, with the columns that order them."""
    rows = with_image(decoded, table).select(
        *_typed(table),
        (F.col("op") == "d").alias("deleted"),
        "ts_ms",
        "source_lsn",
        "kafka_offset",
    )
    return rows.where(_usable(table))


def _classified(decoded: DataFrame, table: str) -> DataFrame:
    """Records of a table with their ``outcome``: kept, ignored, or the reason of a reject."""
    op = F.col("op")
    kept, ignored = _usable(table, "typed."), F.lit(False)
    if table == "trades":
        kept, ignored = kept & op.isin("c", "r"), op.isin("u", "d")
    outcome = (
        F.when(kept, "kept")
        .when(ignored, "ignored")
        .when(op.isNull(), "no operation")
        .when(~op.isin("c", "r", "u", "d"), "unsupported operation")
        .when(~_usable(table, "image."), "no key")
        .otherwise("unreadable key")
    )
    own = decoded.where(F.col("src_table") == table)
    typed = with_image(own, table).withColumn("typed", F.struct(*_typed(table)))
    return typed.withColumn("outcome", outcome)


def outcomes(decoded: DataFrame, table: str) -> DataFrame:
    """(src_table, outcome) of every record of a table."""
    return _classified(decoded, table).select("src_table", "outcome")


def rejects(decoded: DataFrame, table: str) -> DataFrame:
    """Records of a table that its typed reader skips, with the reason.

    Updates and deletes of trades are no rejects; they are ignored by rule.
    """
    skipped = _classified(decoded, table).where(~F.col("outcome").isin("kept", "ignored"))
    return skipped.select("src_table", F.col("outcome").alias("reason"), "kafka_offset", "value")
