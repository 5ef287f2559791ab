"""Current state of a keyed table held in Spark's state store.

The latest change per key is a streaming aggregate in update mode, so a late or repeated change cannot undo
a newer one, and the cost of a micro-batch is that of its own keys. RocksDB keeps the keys outside the JVM
heap. Each batch's updated keys go to a partition of their own, which a replayed batch overwrites.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ledgerline.operators.latest import latest_per_key
from ledgerline.session import settings

ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}
BATCH = "batch_id"


def newest_changes(changes: DataFrame, keys: list[str], values: list[str], order: list[str]) -> DataFrame:
    """Per key the values of its newest change and the newest delete flag that is known.

    Works on streams and tables alike. A change is as new as its ``order`` columns say.
    """
    rank = F.struct(*order)
    folded = changes.groupBy(*keys).agg(
        F.max_by(F.struct(*values), rank).alias("row"),
        F.max_by(F.col("deleted"), F.when(F.col("deleted").isNotNull(), rank)).alias("deleted"),
    )
    return folded.select(*keys, *[F.col("row")[c].alias(c) for c in values], "deleted")


class KeyedOutput:
    """What the state store gave out, one partition per micro-batch.

    Belongs to one checkpoint: a query that starts anew needs an output of its own.
    """

    def __init__(self, path: str, keys: list[str], layout: str):
        self.path, self.keys = path, keys
        self.names = StructType.fromDDL(layout).names
        self.schema = StructType.fromDDL(f"{layout}, deleted boolean, {BATCH} bigint")

    def write_batch(self, updated: DataFrame, batch_id: int) -> None:
        rows = updated.select(*self.names, "deleted", F.lit(batch_id).cast("bigint").alias(BATCH))
        self._overwrite(rows)

    def _overwrite(self, rows: DataFrame) -> None:
        """Replaces the partitions that ``rows`` has, and no others."""
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BATCH).parquet(self.path)

    def _newest(self, spark: SparkSession) -> DataFrame:
        stored = spark.read.schema(self.schema).parquet(self.path)
        return latest_per_key(stored, self.keys, [BATCH])

    def current(self, spark: SparkSession) -> DataFrame:
        return self._newest(spark).where(~F.col("deleted")).select(*self.names)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold all batches up to ``upto`` into its partition; run it beside the stream, not inside a trigger.

        ``upto`` must be committed, as the stream would overwrite a batch it replays. A reader meanwhile sees
        a key twice at most, and the newest row wins. The partitions below stay until they are removed.
        """
        stored = spark.read.schema(self.schema).parquet(self.path).where(F.col(BATCH) <= upto)
        folded = latest_per_key(stored, self.keys, [BATCH])
        self._overwrite(folded.withColumn(BATCH, F.lit(upto).cast("bigint")))

    def remove_below(self, spark: SparkSession, batch_id: int) -> None:
        """Delete the partitions that ``compact`` has made superfluous."""
        root = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = root.getFileSystem(spark._jsc.hadoopConfiguration())
        for folder in files.listStatus(root):
            name = folder.getPath().getName()
            if name.startswith(f"{BATCH}=") and int(name.split("=")[1]) < batch_id:
                files.delete(folder.getPath(), True)


def start_keyed(
    changes: DataFrame,
    output: KeyedOutput,
    order: list[str],
    checkpoint: str,
    trigger: dict | None = None,
    name: str = "keyed",
) -> StreamingQuery:
    """Keep the state of ``changes`` (a stream of typed rows with ``deleted``) and give out what moves.

    The store's provider and number of partitions are those of the first start.
    """
    spark = changes.sparkSession
    values = [c for c in output.names if c not in output.keys]
    state = newest_changes(changes, output.keys, values, order)
    writer = (
        state.writeStream.queryName(name)
        .outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "15 seconds"}))
        .foreachBatch(output.write_batch)
    )
    # A query keeps the settings it was started with; other streams of the session have theirs.
    with settings(spark, ROCKSDB):
        return writer.start()
