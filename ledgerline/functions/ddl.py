"""Table definitions for catalogs."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ledgerline.functions.schemas import CURRENT, FACTS, LANDING

_DAY_COLUMN = ", trade_date date"


def table_ddl(namespace: str, provider: str = "parquet") -> dict[str, str]:
    """``CREATE TABLE IF NOT EXISTS`` per table.

    Providers with partition transforms get ``days(trade_time)``; Parquet tables get the day as
    a stored column.
    """
    transforms = provider != "parquet"
    out = {}
    for name in CURRENT:
        by = "ingest_date, symbol_id" if name in FACTS else "ingest_date"
        out[f"landing_{name}"] = (LANDING, by)
    for name, layout in CURRENT.items():
        by = {"orderbook_levels": "symbol_id, side", "trades": "days(trade_time), symbol_id"}.get(name)
        if name == "trades" and not transforms:
            layout, by = layout + _DAY_COLUMN, "trade_date, symbol_id"
        out[name] = (layout, by)
    return {
        name: f"CREATE TABLE IF NOT EXISTS {namespace}.{name} ({layout}) USING {provider}"
        + (f" PARTITIONED BY ({by})" if by else "")
        for name, (layout, by) in out.items()
    }


# Partition columns of the stored current state; trades come with the day they were made on.
STATE_PARTITIONS = {
    "orderbook_levels": ["symbol_id", "side", "bucket"],
    "symbols": ["bucket"],
    "exchanges": ["bucket"],
    "trades": ["trade_date", "symbol_id"],
}


def state_layout(table: str) -> str:
    """Columns of a current-state table as a stream keeps it."""
    if table == "trades":
        return CURRENT["trades"] + _DAY_COLUMN
    return CURRENT[table] + ", deleted boolean, kafka_offset bigint, bucket int"


def create_state_tables(spark: SparkSession, namespace: str) -> None:
    """Parquet tables for the current state, and for what became of the records of each batch."""
    layouts = {f"state_{t}": (state_layout(t), by) for t, by in STATE_PARTITIONS.items()}
    stamp = "run string, batch_id bigint"
    layouts["rejects"] = (f"src_table string, reason string, kafka_offset bigint, value string, {stamp}", ["run", "batch_id"])
    layouts["outcomes"] = (f"src_table string, outcome string, n bigint, {stamp}", ["run", "batch_id"])
    for name, (layout, by) in layouts.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {namespace}.{name} ({layout}) USING parquet PARTITIONED BY ({', '.join(by)})")


def create_tables(spark: SparkSession, namespace: str, provider: str = "parquet", location: str | None = None) -> None:
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {namespace}{place}")
    for ddl in table_ddl(namespace, provider).values():
        spark.sql(ddl)
