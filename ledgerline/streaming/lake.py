"""Streams into catalog tables.

Landing tables are appended by Spark's file sink, whose log makes rows appear exactly once and spares
readers the listing of folders. Current-state tables are partitioned down to buckets of their keys; a
batch reads and rewrites the buckets it touches and leaves the files of all others alone. Rejected records
and the outcome of every record are stored together with their batch.

A bucket is replaced as a whole when the job commits, bucket by bucket. Merging a batch twice gives what
merging it once gives, so a restarted query repairs a commit that was cut short; should a bucket be lost
in that moment, replaying the landed log restores it. Tables with row-level operations do not need this:
use ``operators.merge.merge_into_table`` there.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions import ddl
from ledgerline.functions.schemas import CURRENT, FACTS, KEYS, LANDING, PAYLOADS, columns
from ledgerline.operators import cdc
from ledgerline.operators.latest import latest_per_key
from ledgerline.operators.merge import fold_changes, new_rows
from ledgerline.session import settings
from ledgerline.sources.log import TOPIC_PREFIX, in_even_parts

ORDERS = {
    "orderbook_levels": ["last_update_id", "kafka_offset"],
    "symbols": ["ts_ms", "source_lsn", "kafka_offset"],
    "exchanges": ["ts_ms", "source_lsn", "kafka_offset"],
    "trades": ["kafka_offset"],
}


def _same(partitions: list[str], rows: list) -> Column:
    """Partition filter for every value that ``rows`` has in each partition column."""
    out = F.lit(True)
    for c in partitions:
        values = {r[c] for r in rows}
        found = F.col(c).isin([v for v in values if v is not None])
        out = out & (found | F.col(c).isNull() if None in values else found)
    return out


def touched_rows(stored: DataFrame, changes: DataFrame, partitions: list[str]) -> DataFrame:
    """The stored rows of exactly those partitions that ``changes`` has rows of.

    The driver sees the list of these partitions, which the table's layout bounds. The filter prunes
    folders, the join takes out combinations that no change has.
    """
    parts = changes.select(*partitions).distinct().collect()
    wanted = stored.sparkSession.createDataFrame(parts, changes.select(*partitions).schema) if parts else changes.select(*partitions)
    same = reduce(lambda a, b: a & b, [F.col(f"s.{c}").eqNullSafe(F.col(f"w.{c}")) for c in partitions])
    pruned = stored.where(_same(partitions, parts))
    return pruned.alias("s").join(F.broadcast(wanted).alias("w"), same, "left_semi")


class Lake:
    """Landing and current-state tables in one namespace of the session's catalog."""

    def __init__(self, namespace: str, buckets: int = 16):
        self.namespace, self.buckets = namespace, buckets

    def create(self, spark: SparkSession, location: str | None = None) -> None:
        """Create what is missing; ``location`` is the folder of a namespace that is new."""
        ddl.create_tables(spark, self.namespace, location=location)
        ddl.create_state_tables(spark, self.namespace)

    def name(self, table: str) -> str:
        return f"{self.namespace}.{table}"

    def _stored(self, spark: SparkSession, table: str) -> DataFrame:
        spark.catalog.refreshTable(self.name(table))
        return spark.table(self.name(table))

    def read(self, spark: SparkSession, table: str) -> DataFrame:
        """A current-state table; filters on its partition columns prune folders."""
        rows = self._stored(spark, f"state_{table}")
        if table != "trades":
            rows = rows.where(~F.col("deleted"))
        return rows.select(*columns(CURRENT[table]))

    def landed(self, spark: SparkSession, table: str) -> DataFrame:
        return self._stored(spark, f"landing_{table}").select(*columns(LANDING))

    def rejected(self, spark: SparkSession) -> DataFrame:
        return self._stored(spark, "rejects").select("src_table", "reason", "kafka_offset", "value")

    def outcomes(self, spark: SparkSession) -> DataFrame:
        """Records per table and outcome over all batches: kept, ignored, or why not."""
        return self._stored(spark, "outcomes").groupBy("src_table", "outcome").agg(F.sum("n").alias("n"))

    def merge(self, table: str, changes: DataFrame) -> None:
        """Merge typed changes into a keyed table, rewriting the buckets they fall into.

        A deleted key stays as a row marked so, which keeps every touched bucket non-empty.
        """
        keys, partitions = KEYS[table], ddl.STATE_PARTITIONS[table]
        bucket = F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("int").alias("bucket")
        kept = [c for c in columns(ddl.state_layout(table)) if c != "bucket"]
        last = latest_per_key(changes, keys, ORDERS[table]).select(*kept, bucket).persist()
        try:
            stored = touched_rows(self._stored(changes.sparkSession, f"state_{table}"), last, partitions)
            both = stored.select(*kept, F.lit(0).alias("batch")).unionByName(last.select(*kept, F.lit(1).alias("batch")))
            merged = fold_changes(both, keys, F.col("batch")).select("*", bucket)
            self._replace(f"state_{table}", merged, partitions)
        finally:
            last.unpersist()

    def _replace(self, table: str, rows: DataFrame, partitions: list[str]) -> None:
        """Replace the partitions that ``rows`` has, and no others."""
        spark = rows.sparkSession
        ordered = rows.select(*spark.table(self.name(table)).columns)
        with settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
            ordered.hint("rebalance", *partitions).write.insertInto(self.name(table), overwrite=True)

    def insert_trades(self, rows: DataFrame) -> None:
        """Append the trades whose key is new; only the days and symbols of the batch are read."""
        partitions = ddl.STATE_PARTITIONS["trades"]
        day = F.to_date("trade_time").alias("trade_date")
        unique = latest_per_key(rows, KEYS["trades"], ORDERS["trades"]).select(*columns(CURRENT["trades"]), day).persist()
        try:
            spark = rows.sparkSession
            known = touched_rows(self._stored(spark, "state_trades"), unique, partitions)
            fresh = new_rows(known, unique, KEYS["trades"]).select(*spark.table(self.name("state_trades")).columns)
            fresh.hint("rebalance", *partitions).write.insertInto(self.name("state_trades"), overwrite=False)
        finally:
            unique.unpersist()

    def write_batch(self, decoded: DataFrame, batch_id: int) -> None:
        """Fold one micro-batch into every table it has rows for, and store what became of its records."""
        spark = decoded.sparkSession
        run = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        stamp = [F.lit(run).alias("run"), F.lit(batch_id).cast("bigint").alias("batch_id")]
        batch = decoded.where(F.col("src_table").isin(list(PAYLOADS))).persist()
        try:
            present = [r.src_table for r in batch.select("src_table").distinct().collect()]
            if not present:
                return
            mine = {t: batch.where(F.col("src_table") == t) for t in present}
            if "orderbook_levels" in mine:
                self.merge("orderbook_levels", cdc.book_changes(mine["orderbook_levels"]))
            for t in ("symbols", "exchanges"):
                if t in mine:
                    self.merge(t, cdc.dimension_changes(mine[t], t))
            if "trades" in mine:
                self.insert_trades(cdc.trade_rows(mine["trades"]))
            named = reduce(DataFrame.unionByName, [cdc.outcomes(rows, t) for t, rows in mine.items()])
            counts = named.groupBy("src_table", "outcome").agg(F.count("*").alias("n"))
            self._replace("outcomes", counts.select("*", *stamp), ["run", "batch_id"])
            bad = reduce(DataFrame.unionByName, [cdc.rejects(rows, t) for t, rows in mine.items()])
            self._replace("rejects", bad.select("*", *stamp), ["run", "batch_id"])
        finally:
            batch.unpersist()


def start_lake(
    log: DataFrame, lake: Lake, checkpoint: str, trigger: dict | None = None, topic_prefix: str = TOPIC_PREFIX, name: str = "lake"
) -> StreamingQuery:
    """Fold a change log into the lake's current-state tables."""

    def fold(batch: DataFrame, batch_id: int) -> None:
        lake.write_batch(cdc.decode(in_even_parts(batch), topic_prefix), batch_id)

    return (
        log.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "15 seconds"}))
        .foreachBatch(fold)
        .start()
    )


def start_landing_tables(
    log_of: Callable[[str], DataFrame],
    lake: Lake,
    checkpoint: str,
    trigger: dict | None = None,
    topic_prefix: str = TOPIC_PREFIX,
    name: str = "landing",
) -> list[StreamingQuery]:
    """Append the log to one landing table per source table, a stream each.

    ``log_of`` gives the log of a table, so that a stream subscribes to its own topic only.
    """
    queries = []
    for table in PAYLOADS:
        by = ["ingest_date", "symbol_id"] if table in FACTS else ["ingest_date"]
        rows = cdc.landing_rows(cdc.decode(log_of(table), topic_prefix)).where(F.col("src_table") == table)
        names = [c for c in columns(LANDING) if c not in by] + by
        queries.append(
            rows.select(*names)
            .writeStream.queryName(f"{name} {table}")
            .format("parquet")
            .outputMode("append")
            .partitionBy(*by)
            .option("checkpointLocation", f"{checkpoint}/{table}")
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .toTable(lake.name(f"landing_{table}"))
        )
    return queries
