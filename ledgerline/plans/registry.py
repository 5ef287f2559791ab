"""Register of runnable queries and of the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampType

from ledgerline.session import pin_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Types that every engine prints alike; the library itself keeps decimals and instants."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = F.round(c.cast("double"), 6)
        elif isinstance(f.dataType, TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(f.dataType, DateType):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return df.select(*out)


def query(name: str, oracle: str):
    """Register a query under ``name`` with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(pin_settings(spark), sf_dir))

        QUERIES[name] = run
        ORACLES[name] = oracle
        return run

    return register
