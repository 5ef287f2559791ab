"""Tables that a stream maintains on plain files, one folder per micro-batch.

Every write overwrites the folder named after its number, so a replayed batch leaves the table as it
was. The number is the batch id within an epoch; a query with a new checkpoint counts its batches
from 0 again and gets a new epoch, so its batches come after all earlier ones and overwrite none. A
batch counts once its folder has Spark's success marker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.operators.latest import latest_per_key
from ledgerline.operators.merge import fold_changes, new_rows
from ledgerline.sources.tables import finished_versions, remove_versions, write_clustered

BATCH = "batch_id"

EPOCH_BITS = 40


def batch_number(spark: SparkSession, path: str, batch_id: int) -> int:
    """The number of a micro-batch among all that were ever written to the tables at ``path``.

    The id of the running query, which lives as long as its checkpoint, stands for the epoch. Batches
    written outside a query belong to the first one.
    """
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query is None:
        return batch_id
    epochs = finished_versions(spark, f"{path}/epochs", "epoch")
    for epoch in epochs:
        if spark.read.schema("query string").parquet(f"{path}/epochs/epoch={epoch}").first()["query"] == query:
            return epoch << EPOCH_BITS | batch_id
    epoch = epochs[-1] + 1 if epochs else 0
    row = spark.createDataFrame([(query,)], "query string")
    row.write.mode("overwrite").parquet(f"{path}/epochs/epoch={epoch}")
    return epoch << EPOCH_BITS | batch_id


def read_batches(
    spark: SparkSession, path: str, schema: StructType, above: int = -1, upto: int | None = None
) -> DataFrame:
    """All finished batches n with ``above < n <= upto``; an empty frame if there are none."""
    done = finished_versions(spark, path, BATCH)
    done = [n for n in done if n > above and (upto is None or n <= upto)]
    if not done:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema).option("basePath", path)
    return reader.parquet(*[f"{path}/{BATCH}={n}" for n in done])


class MergedTable:
    """Current state of a keyed table, merged when it is read.

    A batch only appends its own folded changes, so its cost does not depend on the size of the
    state. ``compact`` folds everything so far into a new base, which bounds what a reader has to
    merge. With ``guard`` columns the newest version of a key wins whatever the order of arrival;
    deletes are then kept in the base, so that a late update cannot bring a level back.
    """

    def __init__(self, path: str, keys: list[str], layout: str, guard: list[str] | None = None):
        self.path, self.keys, self.guard = path, keys, guard
        self.names = StructType.fromDDL(layout).names
        extra = "deleted boolean, kafka_offset bigint"
        self.schema = StructType.fromDDL(f"{layout}, {extra}, {BATCH} bigint")

    def apply(self, changes: DataFrame, batch_id: int, order: list[str]) -> None:
        """Store one batch of changes: typed columns, ``deleted`` and ``kafka_offset``."""
        last = latest_per_key(changes, self.keys, order).select(*self.names, "deleted", "kafka_offset")
        last.write.mode("overwrite").parquet(f"{self.path}/delta/{BATCH}={batch_id}")

    def _folded(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        bases = [n for n in finished_versions(spark, f"{self.path}/base", BATCH) if upto is None or n < upto]
        base = bases[-1] if bases else -1
        rows = read_batches(spark, f"{self.path}/delta", self.schema, base, upto)
        if bases:
            old = read_batches(spark, f"{self.path}/base", self.schema, base - 1, base)
            rows = rows.unionByName(old)
        return fold_changes(rows, self.keys, self._order())

    def _order(self) -> Column:
        return F.struct(*self.guard) if self.guard else F.col(BATCH)

    def current(self, spark: SparkSession) -> DataFrame:
        return self._folded(spark).where(~F.col("deleted")).select(*self.names)

    def compact(self, spark: SparkSession, batch_id: int) -> None:
        """Write the state after ``batch_id`` as the new base."""
        folded = self._folded(spark, batch_id)
        if not self.guard:
            folded = folded.where(~F.col("deleted"))
        folded.drop(BATCH).write.mode("overwrite").parquet(f"{self.path}/base/{BATCH}={batch_id}")

    def vacuum(self, spark: SparkSession, keep_bases: int = 2) -> None:
        """Delete what no reader needs once it is older than the last ``keep_bases`` bases.

        Two bases are the least that lets the newest batch be replayed, compaction included.
        """
        bases = finished_versions(spark, f"{self.path}/base", BATCH)
        if len(bases) < max(keep_bases, 2):
            return
        oldest = bases[-max(keep_bases, 2)]
        deltas = finished_versions(spark, f"{self.path}/delta", BATCH)
        remove_versions(spark, f"{self.path}/delta", BATCH, [n for n in deltas if n <= oldest])
        remove_versions(spark, f"{self.path}/base", BATCH, [n for n in bases if n < oldest])


class AppendedTable:
    """Immutable rows, each key stored once and never rewritten.

    Rows are partitioned by a bucket of the id inside their key. A duplicate falls into the same
    bucket as its original, so a batch is compared with the few buckets it touches, however much
    history there is.
    """

    def __init__(self, path: str, keys: list[str], layout: str, id_column: str, bucket: int = 10_000_000):
        self.path, self.keys, self.id_column, self.bucket = path, keys, id_column, bucket
        self.names = StructType.fromDDL(layout).names
        self.schema = StructType.fromDDL(f"{layout}, id_bucket bigint, {BATCH} bigint")

    def append(self, rows: DataFrame, batch_id: int, order: list[str]) -> None:
        """Store the rows whose key is new. The batch is cached while it is compared."""
        spark = rows.sparkSession
        unique = latest_per_key(rows, self.keys, order).select(
            *self.names, F.floor(F.col(self.id_column) / self.bucket).alias("id_bucket")
        ).persist()
        try:
            stored = read_batches(spark, self.path, self.schema, upto=batch_id - 1)
            # The batch is the small side: a semi join can broadcast it, so the stored keys are
            # scanned but not shuffled, and only the duplicates reach the anti join.
            known = stored.where(self._touched(unique)).join(unique.select(*self.keys), self.keys, "left_semi")
            fresh = new_rows(known, unique, self.keys)
            write_clustered(fresh, f"{self.path}/{BATCH}={batch_id}", ["symbol_id", "id_bucket"])
        finally:
            unique.unpersist()

    def _touched(self, rows: DataFrame) -> Column:
        """Partition filter covering every bucket of the batch."""
        return F.col("id_bucket").isin([r.id_bucket for r in rows.select("id_bucket").distinct().collect()])

    def current(self, spark: SparkSession) -> DataFrame:
        return read_batches(spark, self.path, self.schema).select(*self.names)
