"""Change-log sources. Everything downstream needs only (topic, partition, offset, value)."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.schemas import LOG

TOPIC_PREFIX = "cdc.public."


def kafka_log(
    spark: SparkSession,
    bootstrap_servers: str,
    topic_prefix: str = TOPIC_PREFIX,
    starting_offsets: str = "earliest",
    max_per_trigger: int | None = None,
    starting_timestamp: int | None = None,
) -> DataFrame:
    """Every topic under the prefix as one stream. Needs the Kafka connector on the classpath.

    ``earliest`` replays the whole log on the first start, ``latest`` takes live changes only, and the text
    from ``starting_offsets_json`` resumes every partition where it was left; ``starting_timestamp`` (epoch
    milliseconds) starts each one at its first record of that time. Later starts resume from the checkpoint
    either way. ``max_per_trigger`` bounds a micro-batch; by
    default it takes all that has arrived.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("subscribePattern", re.escape(topic_prefix) + ".*")
        .option("startingOffsets", starting_offsets)
    )
    if starting_timestamp is not None:
        reader = reader.option("startingTimestamp", starting_timestamp)
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


def file_log(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The same log shipped as Parquet files, oldest file first; by default all new files at once."""
    reader = spark.readStream.schema(LOG)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def in_even_parts(records: DataFrame, most: int = 32 << 20) -> DataFrame:
    """Records in partitions of at most about ``most`` bytes of ``value``, so that each can be cached as one block.

    A split of a compressed file can hold many times its size. The records are dealt anew only where a
    partition is larger; one row reaches the driver.
    """
    parts = records.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(F.octet_length("value")).alias("size"))
    found = parts.agg(F.max("size").alias("largest"), F.sum("size").alias("total")).first()
    if (found["largest"] or 0) <= most:
        return records
    return records.repartition(max(-(-found["total"] // most), records.sparkSession.sparkContext.defaultParallelism))


def from_offset(log: DataFrame, start) -> DataFrame:
    """Replay of a stored log from just after ``start`` (a number or a scalar subquery)."""
    return log.where(F.col("offset") > start)


POSITION = ["topic", "partition"]


def committed_positions(log: DataFrame, upto=None) -> DataFrame:
    """The last offset per topic and partition, among the records for which ``upto`` holds."""
    rows = log if upto is None else log.where(upto)
    return rows.groupBy(*POSITION).agg(F.max("offset").alias("position"))


def from_positions(log: DataFrame, positions: DataFrame) -> DataFrame:
    """Replay of a stored log from just after each partition's own position.

    A partition without a position is replayed from its start. ``positions`` has a row per topic and
    partition at most, so Spark broadcasts it by its size.
    """
    last = positions.select(*POSITION, F.col("position").alias("__position"))
    ahead = F.col("__position").isNull() | (F.col("offset") > F.col("__position"))
    return log.join(last, POSITION, "left").where(ahead).select(*log.columns)


def starting_offsets_json(positions: DataFrame, all_partitions: DataFrame | None = None) -> str:
    """Kafka's ``startingOffsets`` for going on after ``positions``; others in ``all_partitions`` start over.

    One row per topic and partition reaches the driver.
    """
    known = positions.select(*POSITION, (F.col("position") + 1).alias("start"))
    if all_partitions is not None:
        # -2 is Kafka's number for the earliest offset.
        known = all_partitions.select(*POSITION).distinct().join(known, POSITION, "left").fillna(-2, ["start"])
    out: dict[str, dict[str, int]] = {}
    for r in known.orderBy(*POSITION).collect():
        out.setdefault(r["topic"], {})[str(r["partition"])] = r["start"]
    return json.dumps(out)
