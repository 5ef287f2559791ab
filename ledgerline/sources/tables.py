"""Readers for the given Parquet tables and helpers for tables kept in numbered versions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Use all cores for a table that comes in fewer splits than there are cores.

    A table of many files or row groups already keeps every core busy and is left as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def finished_versions(spark: SparkSession, path: str, column: str) -> list[int]:
    """Numbers n of the folders ``path/column=n`` whose write ran to its end.

    A writer that died leaves its folder without the success marker, so readers pass over it and
    the replayed batch overwrites it. Goes through the Hadoop file API and so works wherever
    Spark itself can write.
    """
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}=*/_SUCCESS")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    found = (re.search(rf"{column}=(\d+)/_SUCCESS$", f.getPath().toString()) for f in files or [])
    return sorted(int(m.group(1)) for m in found if m)


def remove_versions(spark: SparkSession, path: str, column: str, numbers: list[int]) -> None:
    for n in numbers:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{column}={n}")
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_clustered(df: DataFrame, path: str, partitions: list[str], mode: str = "overwrite"):
    """Write Hive-style partitions with few, evenly sized files.

    The rebalance hint gathers each partition's rows before the write, and adaptive execution
    splits a partition that outgrows the advisory size, so one hot symbol becomes many tasks
    and many files instead of one huge one.
    """
    df.hint("rebalance", *partitions).write.mode(mode).partitionBy(*partitions).parquet(path)
