"""Declared layouts of log payloads, landing tables and current-state tables."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Table names, field names and types of the change log and of the tables behind it.
MONEY = "decimal(38,18)"

LOG = "topic string, partition int, offset bigint, value string"

# Numerics and times travel as text inside the JSON payload.
PAYLOADS = {
    "symbols": (
        "symbol_id bigint, symbol string, base_asset string, quote_asset string, status string, "
        "tick_size string, step_size string, created_at string, updated_at string"
    ),
    "exchanges": "exchange_id bigint, name string, region string, updated_at string",
    "trades": (
        "trade_id bigint, symbol_id bigint, price string, quantity string, quote_qty string, "
        "is_buyer_maker boolean, trade_time string, ingested_at string"
    ),
    "orderbook_levels": (
        "symbol_id bigint, side string, price_level string, quantity string, "
        "last_update_id bigint, updated_at string"
    ),
}

CURRENT = {
    "symbols": (
        "symbol_id bigint, symbol string, base_asset string, quote_asset string, status string, "
        f"tick_size {MONEY}, step_size {MONEY}, created_at timestamp, updated_at timestamp"
    ),
    "exchanges": "exchange_id bigint, name string, region string, updated_at timestamp",
    "trades": (
        f"trade_id bigint, symbol_id bigint, price {MONEY}, quantity {MONEY}, quote_qty {MONEY}, "
        "is_buyer_maker boolean, trade_time timestamp, ingested_at timestamp"
    ),
    "orderbook_levels": (
        f"symbol_id bigint, side string, price_level {MONEY}, quantity {MONEY}, "
        "last_update_id bigint, updated_at timestamp"
    ),
}

LANDING = (
    "op string, ts_ms bigint, source_lsn bigint, symbol_id bigint, kafka_topic string, "
    "kafka_partition int, kafka_offset bigint, ingest_date date, after string, before string"
)

KEYS = {
    "symbols": ["symbol_id"],
    "exchanges": ["exchange_id"],
    "trades": ["symbol_id", "trade_id"],
    "orderbook_levels": ["symbol_id", "side", "price_level"],
}

# High-volume tables land partitioned by symbol as well as by day.
FACTS = ["trades", "orderbook_levels"]


def columns(layout: str) -> list[str]:
    return StructType.fromDDL(layout).names
