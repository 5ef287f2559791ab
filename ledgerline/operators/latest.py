"""One surviving row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep the row with the greatest ``order`` tuple per key (NULL sorts lowest).

    Written as an aggregate, so each task first reduces its own rows to one per key; a key with
    very many versions costs the shuffle one row per task.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), rank).alias("row"))
    return best.select(*[F.col(k) if k in keys else F.col("row")[k].alias(k) for k in df.columns])


def first_ranked(df: DataFrame, keys: list[str], order: list[Column], n: int = 1) -> DataFrame:
    """Keep the first ``n`` rows per key. Spark limits each group before the shuffle as well."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where(F.col("__rank") <= n).drop("__rank")
