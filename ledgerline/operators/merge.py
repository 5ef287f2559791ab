"""Keyed merges as DataFrame compositions, for tables without row-level operations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Condition = Callable[[Column, Column], Column]


def keyed_merge(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    delete_flag: str | None = "deleted",
    update_when: Condition | None = None,
) -> DataFrame:
    """The state of ``target`` after merging ``source``; keys are unique on both sides.

    In this order: a matched row flagged deleted goes; any other matched row takes the source's
    values; an unmatched source row is inserted if its flag is false, and otherwise ignored.
    A NULL flag therefore updates but never inserts. ``update_when(new, old)`` can hold back a
    matched row, deletes included, which then keeps its old values.

    One full outer join on the keys. Both sides hold a key once, so no join partition can be
    skewed by a hot key.
    """
    values = [c for c in target.columns if c not in keys]
    flag = F.col(delete_flag) if delete_flag else F.lit(False)
    old = target.select(*keys, F.struct(*values).alias("old"))
    new = source.select(*keys, F.struct(*values).alias("new"), flag.alias("gone"))
    joined = old.join(new, keys, "full_outer")

    o, n, gone = F.col("old"), F.col("new"), F.col("gone")
    matched = o.isNotNull() & n.isNotNull()
    applies = matched
    if update_when is not None:
        applies = matched & F.coalesce(update_when(n, o), F.lit(False))
    survives = (
        F.when(applies, ~F.coalesce(gone, F.lit(False)))
        .when(o.isNotNull(), True)
        .otherwise(F.coalesce(~gone, F.lit(False)))
    )
    row = F.when(o.isNull() | applies, n).otherwise(o)
    out = [F.col(c) if c in keys else F.col("row")[c].alias(c) for c in target.columns]
    return joined.where(survives).select(*keys, row.alias("row")).select(*out)


def new_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-only merge: the source rows whose key the target lacks, ready to be appended.

    The target is never rewritten and only its key columns are read.
    """
    return source.join(target.select(*keys), keys, "left_anti")


def upsert_if_changed(
    target: DataFrame, source: DataFrame, keys: list[str], watched: list[str]
) -> DataFrame:
    """Upsert that leaves a matched row alone unless one of the watched columns differs."""

    def differs(new: Column, old: Column) -> Column:
        changed = F.lit(False)
        for c in watched:
            changed = changed | ~new[c].eqNullSafe(old[c])
        return changed

    return keyed_merge(target, source, keys, delete_flag=None, update_when=differs)


def fold_changes(changes: DataFrame, keys: list[str], order: Column, flag: str = "deleted") -> DataFrame:
    """Collapse an ordered run of merges to one change per key with the same net effect.

    The values are those of the last change. The flag is the last one that was not NULL, since a
    NULL flag neither removes nor inserts a row. Being an aggregate it combines map-side.
    """
    values = [c for c in changes.columns if c not in [*keys, flag]]
    folded = changes.groupBy(*keys).agg(
        F.max_by(F.struct(*values), order).alias("row"),
        F.max_by(F.col(flag), F.when(F.col(flag).isNotNull(), order)).alias(flag),
    )
    return folded.select(*keys, *[F.col("row")[c].alias(c) for c in values], flag)


def merge_into_table(
    source: DataFrame, table: str, keys: list[str], values: list[str], delete_flag: str = "deleted"
) -> None:
    """The same merge against a catalog table that supports row-level operations."""
    s, t = "source", table
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"{t}.{k}") == F.col(f"{s}.{k}"))
    gone = F.col(f"{s}.{delete_flag}")
    assign = {c: F.col(f"{s}.{c}") for c in values}
    (
        source.alias(s)
        .mergeInto(table, on)
        .whenMatched(gone)
        .delete()
        .whenMatched()
        .update(assign)
        .whenNotMatched(~gone)
        .insert({**{k: F.col(f"{s}.{k}") for k in keys}, **assign})
        .merge()
    )
