"""Append-only landing of the raw change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.functions.schemas import FACTS, LANDING, PAYLOADS, columns
from ledgerline.operators.cdc import decode, landing_rows
from ledgerline.sources.log import TOPIC_PREFIX
from ledgerline.sources.tables import write_clustered
from ledgerline.streaming.tables import BATCH, batch_number, read_batches

TRIGGER = {"processingTime": "10 seconds"}

_LAYOUT = ["src_table", "ingest_date", "symbol_part"]


def write_landing(decoded: DataFrame, path: str, batch_id: int) -> None:
    """Land one batch for all tables in a single job, partitioned by table, day and symbol.

    Only the high-volume tables are split by symbol. The batch's folder is overwritten, so a
    retry does not duplicate rows.
    """
    split = F.when(F.col("src_table").isin(FACTS), F.col("symbol_id"))
    rows = (
        landing_rows(decoded)
        .where(F.col("src_table").isin(list(PAYLOADS)))
        .withColumn("symbol_part", split)
    )
    number = batch_number(decoded.sparkSession, path, batch_id)
    write_clustered(rows, f"{path}/{BATCH}={number}", _LAYOUT)


def read_landing(spark: SparkSession, path: str, table: str) -> DataFrame:
    """One landed table. For the high-volume ones a filter on ``symbol_id`` prunes folders."""
    stored = f"{LANDING}, src_table string, symbol_part bigint, {BATCH} bigint"
    rows = read_batches(spark, path, StructType.fromDDL(stored)).where(F.col("src_table") == table)
    if table in FACTS:
        rows = rows.drop("symbol_id").withColumnRenamed("symbol_part", "symbol_id")
    return rows.select(*columns(LANDING))


def start_landing(
    log: DataFrame,
    path: str,
    checkpoint: str,
    trigger: dict | None = None,
    topic_prefix: str = TOPIC_PREFIX,
    name: str = "landing",
) -> StreamingQuery:
    def land(batch: DataFrame, batch_id: int) -> None:
        write_landing(batch, path, batch_id)

    return (
        decode(log, topic_prefix)
        .writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .foreachBatch(land)
        .start()
    )
