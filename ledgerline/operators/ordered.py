"""Ordered computations per key that survive a key holding a large share of all rows.

A window partitioned by the key alone sends every row of a hot key to one task. Here the integer
order column (an event id, offset or update id) is cut into chunks of ``width`` ids and windows
run per (key, chunk). Ids are unique within a key, so a window never holds more than ``width``
rows, however hot the key. What must cross a chunk border is one edge row per (key, chunk);
only these edges are ordered per key, and they are joined back on the partitioning the windows
already have.

Rows and edges come out of one shuffle: both branches read the same columns of the same
``repartition``, so Spark computes the input once and reuses the exchange.

Chunks of ids suit ids that are dense. Where they are sparse (times, or ids shared by many keys), such a
chunk holds a row or two and the edges are as many as the rows. ``in_ranges`` cuts the table by its own
quantiles instead: a range shuffle by key and order, each task's rows being a chunk. All functions take
its result in place of the plain rows, and keep its chunks for the next one.

Rows without a key or an order value belong to no sequence and are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WIDTH = 1_000_000

CHUNK = "__chunk"


def in_ranges(df: DataFrame, keys: list[str], order: str, path: str) -> DataFrame:
    """The rows in chunks of about equal size along (keys, order), written to ``path``.

    The bounds come from Spark's sample of the table, so a chunk's size does not depend on how ids lie. A key
    has no more chunks than there are shuffle partitions. Rows of one key with equal order values
    share a chunk. Written, so that all that follows sees the same bounds.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for c in (*keys, order):
        df = df.where(F.col(c).isNotNull())
    cut = df.repartitionByRange(tasks, *keys, order).withColumn(CHUNK, F.spark_partition_id().cast("bigint"))
    cut.write.mode("overwrite").parquet(path)
    return spark.read.schema(cut.schema).parquet(path)


def chunked(df: DataFrame, keys: list[str], order: str, width: int = WIDTH) -> DataFrame:
    """Rows with their chunk, in one exchange by (keys, chunk)."""
    if CHUNK in df.columns:
        return df.repartition(*keys, CHUNK)
    # First id of the chunk; stays in integers, so it is exact for any 64-bit id.
    chunk = F.col(order) - F.pmod(F.col(order), F.lit(width))
    for c in (*keys, order):
        df = df.where(F.col(c).isNotNull())
    return df.withColumn(CHUNK, chunk).repartition(*keys, CHUNK)


def _edges(rows: DataFrame, keys: list[str], order: str, pick) -> DataFrame:
    """First (``min_by``) or last (``max_by``) whole row of every (key, chunk)."""
    whole = F.struct(*rows.columns)
    return rows.groupBy(*keys, CHUNK).agg(pick(whole, F.col(order)).alias("edge"))


def _neighbour(df, keys, order, values, width, forward: bool) -> DataFrame:
    cut = chunked(df, keys, order, width)
    local = Window.partitionBy(*keys, CHUNK).orderBy(order)
    across = Window.partitionBy(*keys).orderBy(CHUNK)
    step, pick = (F.lead, F.min_by) if forward else (F.lag, F.max_by)

    carried = _edges(cut, keys, order, pick).select(
        *keys, CHUNK, step("edge").over(across).alias("carried")
    )
    inside = cut.withColumn("near", step(F.struct(*values)).over(local))
    near, far = F.col("near"), F.col("carried")
    return inside.join(carried, [*keys, CHUNK], "left").select(
        *[F.col(c) for c in df.columns],
        *[
            F.when(near.isNotNull(), near[c]).otherwise(far[c]).alias(name)
            for c, name in values.items()
        ],
    )


def with_previous(df, keys: list[str], order: str, values: dict[str, str], width=WIDTH) -> DataFrame:
    """Add ``values`` (source column -> new column) of the preceding row of the same key."""
    return _neighbour(df, keys, order, values, width, forward=False)


def with_next(df, keys: list[str], order: str, values: dict[str, str], width=WIDTH) -> DataFrame:
    """Add ``values`` (source column -> new column) of the following row of the same key."""
    return _neighbour(df, keys, order, values, width, forward=True)


def with_running_sum(
    df, keys: list[str], order: str, amount: Column, name: str, width=WIDTH
) -> DataFrame:
    """Add the running total of ``amount`` up to and including the current row of the key."""
    local = Window.partitionBy(*keys, CHUNK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    inside = chunked(df, keys, order, width).withColumn("__run", F.sum(amount).over(local))
    earlier = _edges(inside, keys, order, F.max_by).select(
        *keys, CHUNK, F.coalesce(F.sum("edge.__run").over(before), F.lit(0)).alias("base")
    )
    total = (F.col("__run") + F.col("base")).alias(name)
    return inside.join(earlier, [*keys, CHUNK], "left").select(*df.columns, total)


def with_row_number(df, keys: list[str], order: str, name: str, width=WIDTH) -> DataFrame:
    """Add 1, 2, 3 ... per key in the given order."""
    return with_running_sum(df, keys, order, F.lit(1).cast("bigint"), name, width)
