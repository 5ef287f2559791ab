"""Data-quality checks. Each returns the rows that violate it; an empty result passes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ordered import with_next

HOUR_MICROS = 3_600_000_000


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values that occur more than once; keys with a NULL part are another check's concern."""
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.where(whole).groupBy(*keys).agg(F.count("*").alias("n"))
    return counts.where(F.col("n") > 1)


def any_null(columns: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a NULL in any of the columns."""
    return df.where(any_null(columns))


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """NULLs per column as (column_name, n), all columns in a single pass over the table."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "n")


def outside_values(df: DataFrame, column: str, accepted: list) -> DataFrame:
    """Rows whose value is not among the accepted ones; NULL passes."""
    return df.where(~F.col(column).isin(accepted))


def orphans(facts: DataFrame, dimension: DataFrame, fact_key: str, dim_key: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension; NULL keys pass."""
    ids = dimension.select(F.col(dim_key).alias(fact_key))
    return facts.where(F.col(fact_key).isNotNull()).join(ids, fact_key, "left_anti")


def negative_spreads(snapshot: DataFrame) -> DataFrame:
    bad = snapshot.where(F.col("spread") < 0)
    return bad.select("symbol_id", "best_bid", "best_ask", "spread")


def overlapping_versions(dim: DataFrame, key: str = "symbol_id") -> DataFrame:
    """Versions that end after the next one of the same entity has started."""
    stamped = dim.select(key, "valid_from", "valid_to").withColumn(
        "__micros", F.unix_micros(F.col("valid_from").cast("timestamp"))
    )
    paired = with_next(
        stamped, [key], "__micros", {"valid_from": "next_valid_from"}, width=HOUR_MICROS
    )
    late = F.col("valid_to") > F.col("next_valid_from")
    return paired.where(late).select(key, "valid_from", "valid_to", "next_valid_from")


def not_one_current(dim: DataFrame, key: str = "symbol_id") -> DataFrame:
    """Entities without exactly one current version; one with none at all is caught as well."""
    counts = dim.groupBy(key).agg(F.count_if("is_current").alias("n_current"))
    return counts.where(F.col("n_current") != 1)


def broken_bars(bars: DataFrame) -> DataFrame:
    """Bars whose open or close lies outside [low, high]."""
    inside = [F.col(c).between(F.col("low"), F.col("high")) for c in ("open", "close")]
    return bars.where(~(inside[0] & inside[1]))


def summarise(checks: dict[str, DataFrame]) -> DataFrame:
    """(check_name, violations) for a set of checks, as one job."""
    counted = [
        violations.agg(F.count("*").alias("violations")).select(F.lit(name).alias("check_name"), "violations")
        for name, violations in checks.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def profile(
    df: DataFrame,
    unique: dict[str, list[str]],
    flags: dict[str, Column] | None = None,
    exactly_one: dict[str, tuple[list[str], Column]] | None = None,
) -> DataFrame:
    """(check_name, violations) for several checks in one scan and one shuffle of a table.

    ``unique``: key values that occur more than once (a key with a NULL part is passed over). ``flags``:
    rows for which a condition holds. ``exactly_one``: key values without exactly one row for which
    a condition holds. A row takes part once per key, combined in its task before the shuffle.
    """
    flags, exactly_one = flags or {}, exactly_one or {}
    keys = [*[(cols, F.lit(False)) for cols in unique.values()], *exactly_one.values()]
    n_unique = len(unique)

    def entry(kind: int, cols: list[str], mark: Column) -> Column:
        # NULL parts: only uniqueness passes over them.
        skip = any_null(cols) if kind < n_unique else F.lit(False)
        key = F.when(~skip, F.array(*[F.col(c).cast("string") for c in cols]))
        bad = [F.coalesce(c, F.lit(False)) if kind == 0 else F.lit(False) for c in flags.values()]
        return F.struct(
            F.lit(kind).alias("kind"),
            key.alias("key"),
            F.coalesce(mark, F.lit(False)).alias("mark"),
            *[b.alias(f"flag{k}") for k, b in enumerate(bad)],
        )

    entries = F.explode(F.array(*[entry(k, *key) for k, key in enumerate(keys)]))
    per_key = (
        df.select(entries.alias("e"))
        .select("e.*")
        .groupBy("kind", "key")
        .agg(F.count("*").alias("n"), F.count_if("mark").alias("marked"), *[F.count_if(f"flag{k}").alias(f"flag{k}") for k in range(len(flags))])
    )
    kind, whole = F.col("kind"), F.col("key").isNotNull()
    found = {name: F.count_if((kind == k) & whole & (F.col("n") > 1)) for k, name in enumerate(unique)}
    found |= {name: F.count_if((kind == n_unique + k) & (F.col("marked") != 1)) for k, name in enumerate(exactly_one)}
    found |= {name: F.coalesce(F.sum(f"flag{k}"), F.lit(0)) for k, name in enumerate(flags)}
    row = per_key.agg(*[c.alias(f"v{k}") for k, c in enumerate(found.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"v{k}").alias("violations")) for k, name in enumerate(found)])
    return row.select(F.explode(pairs).alias("p")).select("p.*")
