"""Current-state tables folded from the change log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerline.functions.schemas import CURRENT, KEYS
from ledgerline.operators.cdc import book_changes, decode, dimension_changes, trade_rows
from ledgerline.sources.log import TOPIC_PREFIX, in_even_parts
from ledgerline.streaming.tables import AppendedTable, MergedTable, batch_number

TRIGGER = {"processingTime": "15 seconds"}

VERSION = ["last_update_id", "kafka_offset"]
LOG_ORDER = ["ts_ms", "source_lsn", "kafka_offset"]


class CurrentState:
    """The four current-state tables under one folder."""

    def __init__(self, path: str, version_guard: bool = False, compact_every: int = 20):
        self.path, self.compact_every = path, compact_every
        self.book = MergedTable(
            f"{path}/orderbook_levels",
            KEYS["orderbook_levels"],
            CURRENT["orderbook_levels"],
            guard=VERSION if version_guard else None,
        )
        self.dims = {
            t: MergedTable(f"{path}/{t}", KEYS[t], CURRENT[t]) for t in ("symbols", "exchanges")
        }
        self.trades = AppendedTable(f"{path}/trades", KEYS["trades"], CURRENT["trades"], "trade_id")

    def write_batch(self, decoded: DataFrame, batch_id: int) -> None:
        """Fold one micro-batch into every table it has rows for.

        The tables commit one after the other. After a crash in between, the batch is replayed
        and writes the same folders again.
        """
        spark = decoded.sparkSession
        number = batch_number(spark, self.path, batch_id)
        batch = decoded.persist()
        try:
            known = batch.where(F.col("src_table").isin(list(KEYS)))
            present = {r.src_table for r in known.select("src_table").distinct().collect()}
            if "orderbook_levels" in present:
                rows = book_changes(batch.where(F.col("src_table") == "orderbook_levels"))
                self.book.apply(rows, number, VERSION)
            if "trades" in present:
                rows = trade_rows(batch.where(F.col("src_table") == "trades"))
                self.trades.append(rows, number, ["kafka_offset"])
            for name, table in self.dims.items():
                if name in present:
                    rows = dimension_changes(batch.where(F.col("src_table") == name), name)
                    table.apply(rows, number, LOG_ORDER)
            if batch_id > 0 and batch_id % self.compact_every == 0:
                for table in (self.book, *self.dims.values()):
                    table.compact(spark, number)
                    table.vacuum(spark)
        finally:
            batch.unpersist()

    def read(self, spark: SparkSession, name: str) -> DataFrame:
        if name == "trades":
            return self.trades.current(spark)
        return (self.book if name == "orderbook_levels" else self.dims[name]).current(spark)


def start_current(
    log: DataFrame,
    state: CurrentState,
    checkpoint: str,
    trigger: dict | None = None,
    topic_prefix: str = TOPIC_PREFIX,
    name: str = "current",
) -> StreamingQuery:
    def fold(batch: DataFrame, batch_id: int) -> None:
        state.write_batch(decode(in_even_parts(batch), topic_prefix), batch_id)

    return (
        log.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or TRIGGER))
        .foreachBatch(fold)
        .start()
    )
