"""Streams into catalog tables, the state store, event time, and positions in the log."""

import datetime as dt
import json
import re
from decimal import Decimal

import pytest
from conftest import SF, rows
from pyspark.sql import functions as F

from ledgerline.functions.schemas import CURRENT, KEYS
from ledgerline.operators import book, cdc
from ledgerline.plans import inputs
from ledgerline.sources.log import TOPIC_PREFIX, committed_positions, file_log, from_positions, starting_offsets_json
from ledgerline.streaming.current import VERSION
from ledgerline.streaming.keyed import KeyedOutput, newest_changes, start_keyed
from ledgerline.streaming.lake import Lake, start_lake, start_landing_tables
from ledgerline.streaming.market import closed_bars, distinct_trades, late_rows, start_append

ONCE = {"availableNow": True}
LOG = "topic string, partition int, offset bigint, value string"


@pytest.fixture
def lake(spark, run_dir):
    lake = Lake("lake_" + re.sub(r"\W", "", run_dir)[-40:], buckets=4)
    lake.create(spark, f"{run_dir}/tables")
    return lake


@pytest.fixture(scope="module")
def book_log(spark):
    return inputs.book_log(spark, SF).drop("ts").persist()


@pytest.fixture(scope="module")
def expected(spark, book_log):
    return rows(book.live_levels(cdc.book_changes(cdc.decode(book_log))))


def halves(log):
    top = log.agg(F.max("offset")).first()[0]
    return [log.where(F.col("offset") <= top // 2), log.where(F.col("offset") > top // 2)]


def deliver(log, path):
    log.coalesce(1).write.mode("append").parquet(path)


def files(spark, name):
    """Data files of a table with the time they were written."""
    where = spark.sql(f"describe table extended {name}").where("col_name = 'Location'").first()["data_type"]
    root = spark._jvm.org.apache.hadoop.fs.Path(where)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).listFiles(root, True)
    out = {}
    while found.hasNext():
        f = found.next()
        if f.getPath().getName().startswith("part-"):
            out[f.getPath().toString()] = f.getModificationTime()
    return out


def level(price, quantity, version, symbol=1, side="bid", deleted=False, offset=0):
    return symbol, side, Decimal(price), Decimal(quantity), version, dt.datetime(2024, 1, 1), deleted, offset


LEVELS = CURRENT["orderbook_levels"] + ", deleted boolean, kafka_offset bigint"


def test_untouched_buckets_keep_their_files(spark, lake):
    first = [level(p, 1, p, symbol=p % 2, side=s) for p in range(40) for s in ("bid", "ask")]
    lake.merge("orderbook_levels", spark.createDataFrame([*first, level(99, 1, 1, side=None)], LEVELS))
    before = files(spark, lake.name("state_orderbook_levels"))
    change = [level(7, 5, 100, offset=1), level(9, 0, 101, deleted=True, offset=2), level(50, 2, 102, side=None, offset=3)]
    lake.merge("orderbook_levels", spark.createDataFrame(change, LEVELS))
    after = files(spark, lake.name("state_orderbook_levels"))
    gone, kept = before.keys() - after.keys(), before.keys() & after.keys()
    assert all("symbol_id=1/side=bid" in f or "side=__HIVE" in f for f in gone)
    assert len(gone) <= 4 and len(kept) >= len(before) - 4 and all(before[f] == after[f] for f in kept)
    now = {(r.symbol_id, r.side, int(r.price_level)): int(r.quantity) for r in lake.read(spark, "orderbook_levels").collect()}
    want = {(p % 2, s, p): 1 for p in range(40) for s in ("bid", "ask")} | {(1, None, 99): 1, (1, "bid", 7): 5, (1, None, 50): 2}
    del want[1, "bid", 9]
    assert now == want


@pytest.mark.parametrize("n", [1, 2])
def test_streamed_book_equals_the_batch(spark, run_dir, lake, book_log, expected, n):
    parts = halves(book_log) if n == 2 else [book_log]
    for part in parts:
        deliver(part, f"{run_dir}/log")
        start_lake(file_log(spark, f"{run_dir}/log"), lake, f"{run_dir}/cp", ONCE, name=run_dir).awaitTermination()
    assert rows(lake.read(spark, "orderbook_levels")) == expected
    counted = lake.outcomes(spark).agg(F.sum("n")).first()[0]
    # A batch that is replayed leaves everything as it was.
    lake.write_batch(cdc.decode(parts[-1]), 0)
    assert rows(lake.read(spark, "orderbook_levels")) == expected
    assert counted == cdc.decode(book_log).count()


def test_every_table_of_a_batch(spark, run_dir, lake):
    log = inputs.whole_log(spark, SF).drop("ts")
    lake.write_batch(cdc.decode(log), 0)
    lake.write_batch(cdc.decode(log), 0)
    decoded = cdc.decode(log)
    trades = cdc.trade_rows(decoded.where("src_table = 'trades'")).drop("kafka_offset")
    assert rows(lake.read(spark, "trades")) == rows(trades)
    for t in ("symbols", "exchanges"):
        changes = cdc.dimension_changes(decoded.where(f"src_table = '{t}'"), t)
        last = newest_changes(changes, KEYS[t], [c for c in changes.columns if c not in (*KEYS[t], "deleted")], ["ts_ms", "source_lsn", "kafka_offset"])
        want = last.where("not deleted").select(*lake.read(spark, t).columns)
        assert rows(lake.read(spark, t)) == rows(want)
    got = {(r.src_table, r.outcome): r.n for r in lake.outcomes(spark).collect()}
    per_table = {r.src_table: r["count"] for r in decoded.groupBy("src_table").count().collect()}
    for t, n in per_table.items():
        assert sum(v for (table, _), v in got.items() if table == t) == n
    bad = {(r.src_table, r.reason): r["count"] for r in lake.rejected(spark).groupBy("src_table", "reason").count().collect()}
    assert bad == {k: v for k, v in got.items() if k[1] not in ("kept", "ignored")} and bad


def test_filters_prune_folders(spark, run_dir, lake):
    log = inputs.whole_log(spark, SF).drop("ts")
    deliver(log, f"{run_dir}/log")
    for q in start_landing_tables(lambda t: file_log(spark, f"{run_dir}/log").where(F.col("topic") == TOPIC_PREFIX + t), lake, f"{run_dir}/cp", ONCE, name=run_dir):
        q.awaitTermination()
    landed = lake.landed(spark, "trades").where("ingest_date = date'2024-01-05' and symbol_id = 2")
    plan = landed._jdf.queryExecution().executedPlan().toString()
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "ingest_date" in found and "symbol_id" in found
    decoded = cdc.landing_rows(cdc.decode(log)).where("src_table = 'trades'").drop("src_table")
    assert rows(landed) == rows(decoded.where("ingest_date = date'2024-01-05' and symbol_id = 2"))
    assert rows(lake.landed(spark, "trades")) == rows(decoded)
    lake.write_batch(cdc.decode(log), 0)
    side = lake.read(spark, "orderbook_levels").where("symbol_id = 1 and side = 'ask'")
    found = re.search(r"PartitionFilters: \[([^\]]*)\]", side._jdf.queryExecution().executedPlan().toString()).group(1)
    assert "symbol_id" in found and "side" in found


def test_state_store_survives_restarts_and_late_changes(spark, run_dir, book_log, expected):
    output = KeyedOutput(f"{run_dir}/out", KEYS["orderbook_levels"], CURRENT["orderbook_levels"])
    for part in reversed(halves(book_log)):  # the newer half first
        deliver(part, f"{run_dir}/log")
        changes = cdc.book_changes(cdc.decode(file_log(spark, f"{run_dir}/log")))
        start_keyed(changes, output, VERSION, f"{run_dir}/cp", ONCE, run_dir).awaitTermination()
    assert rows(output.current(spark)) == expected
    output.compact(spark, 0)
    output.compact(spark, 0)
    assert rows(output.current(spark)) == expected
    output.compact(spark, 1)
    output.remove_below(spark, 1)
    assert rows(output.current(spark)) == expected


def trade_record(trade, second, price=1, symbol=1):
    at = (dt.datetime(2024, 1, 1) + dt.timedelta(seconds=second)).isoformat() + "Z"
    after = {"trade_id": trade, "symbol_id": symbol, "price": str(price), "quantity": "1", "quote_qty": "1", "is_buyer_maker": True, "trade_time": at, "ingested_at": at}
    value = json.dumps({"op": "c", "ts_ms": 0, "source": {"lsn": trade}, "before": None, "after": after})
    return f"{TOPIC_PREFIX}trades", 0, trade, value


def trades_of(spark, path):
    return cdc.trade_rows(cdc.decode(file_log(spark, path))).drop("kafka_offset")


def run_slices(spark, run_dir, slices, make):
    """Delivers each slice and restarts the query; the rows of the sink and the late ones."""
    late = 0
    for part in slices:
        deliver(spark.createDataFrame(part, LOG), f"{run_dir}/log")
        q = start_append(make(trades_of(spark, f"{run_dir}/log")), f"{run_dir}/out", f"{run_dir}/cp", ONCE, run_dir)
        q.awaitTermination()
        late += late_rows(q)
    return spark.read.parquet(f"{run_dir}/out"), late


def test_bars_are_given_out_once_closed(spark, run_dir):
    slices = [
        [trade_record(1, 5, 10), trade_record(2, 30, 12), trade_record(3, 65, 20)],
        [trade_record(4, 70, 21), trade_record(5, 59, 11)],  # 5 is out of order, yet in time
        [trade_record(6, 800, 30)],
        [trade_record(7, 20, 99), trade_record(8, 810, 31)],  # 7 is late
    ]
    bars, late = run_slices(spark, run_dir, slices, lambda t: closed_bars(t, "2 minutes"))
    got = {r.bar_start.minute: (int(r.open), int(r.high), int(r.close), r.trade_count) for r in bars.collect()}
    assert got == {0: (10, 12, 11, 3), 1: (20, 21, 21, 2)}
    assert late == 1


def test_redelivered_trades_appear_once(spark, run_dir):
    slices = [[trade_record(1, 5), trade_record(1, 5), trade_record(2, 6)], [trade_record(2, 6), trade_record(3, 7, symbol=2), trade_record(3, 7)]]
    out, _ = run_slices(spark, run_dir, slices, lambda t: distinct_trades(t, "2 minutes"))
    assert sorted((r.symbol_id, r.trade_id) for r in out.collect()) == [(1, 1), (1, 2), (1, 3), (2, 3)]


def test_positions(spark):
    data = [("a", 0, k, "x") for k in range(5)] + [("a", 1, k, "x") for k in range(3)] + [("b", 0, 9, "x")]
    log = spark.createDataFrame(data, LOG)
    done = committed_positions(log, (F.col("topic") == "a") & (F.col("offset") < F.col("partition") * -2 + 3))
    assert rows(done) == [("a", 0, 2), ("a", 1, 0)]
    assert rows(from_positions(log, done), "topic", "partition", "offset") == [("a", 0, 3), ("a", 0, 4), ("a", 1, 1), ("a", 1, 2), ("b", 0, 9)]
    assert json.loads(starting_offsets_json(done, log)) == {"a": {"0": 3, "1": 1}, "b": {"0": -2}}
    assert from_positions(log, done.limit(0)).count() == len(data)


def test_settings_of_the_session_come_back(spark, run_dir, lake, book_log):
    names = ["spark.sql.sources.partitionOverwriteMode", "spark.sql.streaming.stateStore.providerClass"]
    before = [spark.conf.get(n, None) for n in names]
    lake.merge("orderbook_levels", spark.createDataFrame([level(1, 1, 1)], LEVELS))
    deliver(book_log.limit(5), f"{run_dir}/log")
    output = KeyedOutput(f"{run_dir}/out", KEYS["orderbook_levels"], CURRENT["orderbook_levels"])
    q = start_keyed(cdc.book_changes(cdc.decode(file_log(spark, f"{run_dir}/log"))), output, VERSION, f"{run_dir}/cp", ONCE, run_dir)
    q.awaitTermination()
    assert [spark.conf.get(n, None) for n in names] == before
    offsets = spark.read.text(f"{run_dir}/cp/offsets").collect()
    assert any("RocksDBStateStoreProvider" in r.value for r in offsets)
