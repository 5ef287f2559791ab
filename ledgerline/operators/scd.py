"""Type-2 history of slowly changing dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.ordered import WIDTH, with_next, with_previous
from ledgerline.sources.tables import finished_versions


def version_key(key: str, valid_from: str) -> Column:
    """Surrogate key of a version, from an explicit text form of key and start time."""
    start = F.date_format(valid_from, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.md5(F.concat_ws("~", F.col(key).cast("string"), start))


def history_from_log(
    log: DataFrame, key: str, checked: list[str], event_time: str, order: str, width: int = WIDTH
) -> DataFrame:
    """Every version of every entity, straight from its change log.

    A version opens where a checked column differs from the entity's previous row and ends when
    the next one opens. Event time is used, so flips between two snapshot runs are kept.
    """
    seen = log.withColumn("__seen", F.lit(True))
    before = {**{c: f"__prev_{c}" for c in checked}, "__seen": "__had"}
    changed = F.col("__had").isNull()
    for c in checked:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"__prev_{c}"))
    opened = (
        with_previous(seen, [key], order, before, width)
        .where(changed)
        .select(*log.columns)
        .withColumnRenamed(event_time, "valid_from")
    )
    return with_next(opened, [key], order, {"valid_from": "valid_to"}, width).drop(order)


def snapshot_step(
    current: DataFrame, source: DataFrame, key: str, checked: list[str], run_time: Column
) -> DataFrame:
    """One snapshot run over the open versions: rows with ``state`` 'open' or 'closed'.

    New entities open a version; a change in a checked column closes the old version and opens
    a new one, both at the run time; other changes and vanished entities leave it untouched.
    Closed history takes no part, so a run costs the open rows and the source, not the history.
    """
    attrs = [c for c in source.columns if c != key]
    old = current.select(key, F.struct(*attrs, "valid_from").alias("old"))
    new = source.select(key, F.struct(*attrs).alias("new"))
    o, n = F.col("old"), F.col("new")
    differs = F.lit(False)
    for c in checked:
        differs = differs | ~o[c].eqNullSafe(n[c])
    replaced = o.isNotNull() & n.isNotNull() & differs

    def version(attrs_from: Column, start: Column, end: Column, state: Column) -> Column:
        return F.struct(
            *[attrs_from[c].alias(c) for c in attrs],
            start.alias("valid_from"),
            end.alias("valid_to"),
            state.alias("state"),
        )

    stamp = F.col("run_time")
    never = F.lit(None).cast(current.schema["valid_from"].dataType)
    state = F.when(replaced, "closed").otherwise("open")
    kept = F.when(
        o.isNotNull(), version(o, o["valid_from"], F.when(replaced, stamp).otherwise(never), state)
    )
    opened = F.when(o.isNull() | replaced, version(n, stamp, never, F.lit("open")))
    rows = F.filter(F.array(kept, opened), lambda r: r.isNotNull())
    joined = old.join(new, key, "full_outer").withColumn("run_time", run_time)
    return joined.select(key, F.explode(rows).alias("v")).select(key, "v.*")


class SnapshotHistory:
    """Snapshot history on plain files: each run writes its open rows and newly closed ones.

    Run ``n`` reads run ``n - 1`` and overwrites only its own folder, so repeating a run changes
    nothing. The history is all closed rows plus the open rows of the last run.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, checked: list[str]):
        self.spark, self.path, self.key, self.checked = spark, path, key, checked

    def _read(self) -> DataFrame:
        return self.spark.read.parquet(self.path)

    def run(self, number: int, source: DataFrame, run_time: Column) -> None:
        earlier = [n for n in finished_versions(self.spark, self.path, "run") if n < number]
        if earlier:
            last = (F.col("run") == earlier[-1]) & (F.col("state") == "open")
            current = self._read().where(last).drop("run", "state", "valid_to")
        else:
            current = source.withColumn("valid_from", run_time).where(F.lit(False))
        step = snapshot_step(current, source, self.key, self.checked, run_time)
        step.write.mode("overwrite").partitionBy("state").parquet(f"{self.path}/run={number}")

    def history(self) -> DataFrame:
        runs = finished_versions(self.spark, self.path, "run")
        if not runs:
            raise ValueError(f"no finished snapshot run under {self.path}")
        closed = (F.col("state") == "closed") & F.col("run").isin(runs)
        live = (F.col("state") == "open") & (F.col("run") == runs[-1])
        return self._read().where(closed | live).drop("run", "state")


def symbol_dimension(history: DataFrame, key: str = "symbol_id") -> DataFrame:
    """The dimension surface: surrogate key, attributes, validity, current flag."""
    attrs = [c for c in history.columns if c not in (key, "valid_from", "valid_to")]
    return history.select(
        version_key(key, "valid_from").alias("symbol_version_key"),
        key,
        *attrs,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
    )
