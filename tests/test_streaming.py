import json
import os

import pytest
from conftest import SF, rows
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.functions.schemas import CURRENT, KEYS, LOG
from ledgerline.operators import book, cdc
from ledgerline.plans import inputs
from ledgerline.plans.build import run_build
from ledgerline.plans.gold import rebuild_trades
from ledgerline.sources.log import file_log
from ledgerline.sources.tables import finished_versions
from ledgerline.streaming.current import VERSION, CurrentState, start_current
from ledgerline.streaming.landing import read_landing, start_landing, write_landing
from ledgerline.streaming.run import run_available, run_forever
from ledgerline.streaming.tables import AppendedTable, MergedTable, read_batches

ONCE = {"availableNow": True}


@pytest.fixture(scope="module")
def book_log(spark):
    return inputs.book_log(spark, SF).drop("ts").persist()


@pytest.fixture(scope="module")
def expected(spark, book_log):
    return rows(book.live_levels(cdc.book_changes(cdc.decode(book_log))))


def slices(log, n):
    """The log in n parts by offset."""
    top = log.agg(F.max("offset")).first()[0] + 1
    part = F.floor(F.col("offset") * n / top)
    return [log.where(part == i) for i in range(n)]


def deliver(log, path):
    log.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("n", [1, 3, 5])
def test_state_does_not_depend_on_the_batches(spark, run_dir, book_log, expected, n):
    for part in slices(book_log, n):
        deliver(part, f"{run_dir}/log")
    state = CurrentState(f"{run_dir}/current", compact_every=2)
    stream = file_log(spark, f"{run_dir}/log", max_files_per_trigger=1)
    start_current(stream, state, f"{run_dir}/cp", ONCE).awaitTermination()
    assert finished_versions(spark, f"{run_dir}/current/orderbook_levels/delta", "batch_id")[-1] == n - 1
    assert rows(state.read(spark, "orderbook_levels")) == expected


def test_restart_resumes_and_a_replayed_batch_changes_nothing(spark, run_dir, book_log, expected):
    state = CurrentState(f"{run_dir}/current")
    parts = slices(book_log, 2)
    for part in parts:
        deliver(part, f"{run_dir}/log")
        start_current(file_log(spark, f"{run_dir}/log"), state, f"{run_dir}/cp", ONCE).awaitTermination()
    assert rows(state.read(spark, "orderbook_levels")) == expected
    for n in (1, 1):
        state.write_batch(cdc.decode(parts[n]), n)
    assert rows(state.read(spark, "orderbook_levels")) == expected


def test_compaction_keeps_the_state_and_survives_a_replay(spark, run_dir, book_log, expected):
    table = MergedTable(run_dir, KEYS["orderbook_levels"], CURRENT["orderbook_levels"])
    parts = [cdc.book_changes(cdc.decode(p)) for p in slices(book_log, 3)]
    for n, p in enumerate(parts):
        table.apply(p, n, VERSION)
        table.compact(spark, n)
    assert rows(table.current(spark)) == expected
    table.apply(parts[2], 2, VERSION)
    table.compact(spark, 2)
    assert rows(table.current(spark)) == expected


def test_unfinished_batch_is_not_read(spark, run_dir, book_log):
    table = MergedTable(run_dir, KEYS["orderbook_levels"], CURRENT["orderbook_levels"])
    parts = [cdc.book_changes(cdc.decode(p)) for p in slices(book_log, 2)]
    table.apply(parts[0], 0, VERSION)
    before = rows(table.current(spark))
    table.apply(parts[1], 1, VERSION)
    os.rename(f"{run_dir}/delta/batch_id=1/_SUCCESS", f"{run_dir}/marker")
    assert rows(table.current(spark)) == before


@pytest.mark.parametrize("order", [[2, 1, 0], [1, 2, 0], [0, 2, 1]])
def test_guard_makes_arrival_order_irrelevant(spark, run_dir, book_log, expected, order):
    table = MergedTable(run_dir, KEYS["orderbook_levels"], CURRENT["orderbook_levels"], guard=VERSION)
    parts = [cdc.book_changes(cdc.decode(p)) for p in slices(book_log, 3)]
    for batch_id, n in enumerate(order):
        table.apply(parts[n], batch_id, VERSION)
        table.compact(spark, batch_id)
    assert rows(table.current(spark)) == expected


def test_empty_tables_can_be_read(spark, run_dir):
    state = CurrentState(run_dir)
    for name in KEYS:
        assert state.read(spark, name).isEmpty()
    assert read_landing(spark, run_dir, "trades").isEmpty()


def trade(i, price="1", symbol=1):
    after = {"trade_id": i, "symbol_id": symbol, "price": price, "quantity": "1", "quote_qty": price}
    return json.dumps({"op": "c", "ts_ms": 0, "source": {"lsn": i}, "before": None, "after": after})


def trade_batch(spark, *values):
    data = [("cdc.public.trades", 0, i, v) for i, v in enumerate(values)]
    return cdc.trade_rows(cdc.decode(spark.createDataFrame(data, LOG)))


def test_trades_are_stored_once(spark, run_dir):
    table = AppendedTable(run_dir, KEYS["trades"], CURRENT["trades"], "trade_id", bucket=2)
    table.append(trade_batch(spark, trade(1), trade(2), trade(2), trade(5)), 0, ["kafka_offset"])
    # A redelivered trade is ignored even if it reads differently; the same id of another symbol is not.
    second = trade_batch(spark, trade(2, "9"), trade(2, symbol=2), trade(7))
    for _ in range(2):
        table.append(second, 1, ["kafka_offset"])
        got = [(r.symbol_id, r.trade_id, int(r.price)) for r in table.current(spark).collect()]
        assert sorted(got) == [(1, 1, 1), (1, 2, 1), (1, 5, 1), (1, 7, 1), (2, 2, 1)]


def test_trades_with_many_buckets(spark, run_dir):
    table = AppendedTable(run_dir, KEYS["trades"], CURRENT["trades"], "trade_id", bucket=2)
    table.append(trade_batch(spark, trade(1), trade(6), trade(20)), 0, ["kafka_offset"])
    table.append(trade_batch(spark, trade(6), trade(9), trade(20)), 1, ["kafka_offset"])
    assert rows(table.current(spark), "trade_id") == [(1,), (20,), (6,), (9,)]


def test_landing_is_append_only_and_replay_safe(spark, run_dir, book_log):
    decoded = cdc.decode(book_log)
    for batch_id in (0, 1, 1):
        write_landing(decoded, run_dir, batch_id)
    landed = read_landing(spark, run_dir, "orderbook_levels")
    assert landed.count() == 2 * decoded.count()
    assert landed.columns[:4] == ["op", "ts_ms", "source_lsn", "symbol_id"]


def test_landing_prunes_by_symbol_and_day(spark, run_dir, book_log):
    write_landing(cdc.decode(book_log), run_dir, 0)
    day = F.col("ingest_date") == F.lit("2024-01-05").cast("date")
    one = read_landing(spark, run_dir, "orderbook_levels").where((F.col("symbol_id") == 1) & day)
    plan = one._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    assert "symbol_part" in filters and "ingest_date" in filters and "src_table" in filters


def test_both_streams_of_the_whole_pipeline(spark, run_dir):
    log = inputs.whole_log(spark, SF).drop("ts")
    deliver(log, f"{run_dir}/log")
    state = CurrentState(f"{run_dir}/current")
    run_available(file_log(spark, f"{run_dir}/log"), run_dir, state)
    decoded = cdc.decode(log)
    for name in KEYS:
        in_table = F.col("src_table") == name
        assert read_landing(spark, f"{run_dir}/landing", name).count() == decoded.where(in_table).count()
        assert not state.read(spark, name).isEmpty()
    # The state stays bounded by its keys while the landing keeps every change.
    assert state.read(spark, "orderbook_levels").count() < decoded.where("src_table = 'orderbook_levels'").count()


def test_landing_stream_admits_a_limited_number_of_files(spark, run_dir, book_log):
    for part in slices(book_log, 3):
        deliver(part, f"{run_dir}/log")
    q = start_landing(file_log(spark, f"{run_dir}/log", 1), f"{run_dir}/landing", f"{run_dir}/cp", ONCE)
    q.awaitTermination()
    assert finished_versions(spark, f"{run_dir}/landing", "batch_id") == [0, 1, 2]


def test_vacuum_keeps_state_and_replay(spark, run_dir, book_log, expected):
    state = CurrentState(run_dir, compact_every=1)
    parts = [cdc.decode(p) for p in slices(book_log, 4)]
    for n, p in enumerate(parts):
        state.write_batch(p, n)
    book_path = f"{run_dir}/orderbook_levels"
    assert finished_versions(spark, f"{book_path}/base", "batch_id") == [2, 3]
    assert finished_versions(spark, f"{book_path}/delta", "batch_id") == [3]
    assert rows(state.read(spark, "orderbook_levels")) == expected
    state.write_batch(parts[3], 3)
    assert rows(state.read(spark, "orderbook_levels")) == expected


@pytest.mark.parametrize("batches", [3, 60])
def test_unfinished_batches_are_never_read(spark, run_dir, batches):
    for n in range(batches):
        trade_batch(spark, trade(n)).write.parquet(f"{run_dir}/batch_id={n}")
    os.remove(f"{run_dir}/batch_id=1/_SUCCESS")
    got = read_batches(spark, run_dir, StructType.fromDDL("trade_id bigint, batch_id bigint"))
    assert sorted(r.batch_id for r in got.collect()) == [n for n in range(batches) if n != 1]


def test_new_checkpoint_replays_into_the_same_tables(spark, run_dir, book_log):
    """Run, compact, run again from the start with a new checkpoint: as if run once."""
    log = book_log.unionByName(inputs.trade_log(spark, SF).limit(200).select(book_log.columns))
    state = CurrentState(f"{run_dir}/current", compact_every=1)
    for n, part in enumerate(slices(log, 3)):
        deliver(part, f"{run_dir}/log")
    for turn in range(2):
        run_available(file_log(spark, f"{run_dir}/log", 1), f"{run_dir}/{turn}", state, name=f"turn {turn}")
        got = {t: rows(state.read(spark, t)) for t in ("orderbook_levels", "trades")}
        if turn == 0:
            once = got
    assert got == once
    assert len({r.trade_id for r in state.read(spark, "trades").collect()}) == state.read(spark, "trades").count()
    epochs = {n >> 40 for n in finished_versions(spark, f"{run_dir}/current/trades", "batch_id")}
    assert epochs == {0, 1}


def test_build_after_the_streams(spark, run_dir):
    """Stream, build, flip a status, build again: a second version, the first one closed."""
    state = CurrentState(f"{run_dir}/current")
    log = inputs.whole_log(spark, SF).drop("ts")
    state.write_batch(cdc.decode(log), 0)
    at = lambda d: F.lit(f"2024-02-0{d} 00:00:00").cast("timestamp")
    gold, checks = run_build(spark, state, f"{run_dir}/gold", 0, at(1))
    first = gold["dim_symbol"].collect()
    assert first and all(r.is_current for r in first)
    failed = {r.check_name for r in checks.where("violations > 0").collect()}
    assert failed <= {"spread not negative"}

    flipped = {"symbol_id": first[0].symbol_id, "symbol": "S", "status": "FLIPPED"}
    value = json.dumps({"op": "u", "ts_ms": 2000000000000, "source": {"lsn": 10**9}, "after": flipped})
    change = spark.createDataFrame([("cdc.public.symbols", 0, 10**9, value)], LOG)
    state.write_batch(cdc.decode(change), 1)
    gold, checks = run_build(spark, state, f"{run_dir}/gold", 1, at(2))
    versions = gold["dim_symbol"].where(F.col("symbol_id") == first[0].symbol_id)
    assert rows(versions, "is_current") == [(False,), (True,)]
    assert checks.where("check_name like '%version%' and violations > 0").isEmpty()
    assert gold["dim_symbol"].count() == len(first) + 1


def test_rebuild_from_landing_deduplicates_and_compacts(spark, run_dir):
    decoded = cdc.decode(inputs.trade_log(spark, SF))
    for batch_id in range(2):
        write_landing(decoded, f"{run_dir}/landing", batch_id)
    rebuild_trades(spark, f"{run_dir}/landing", f"{run_dir}/trades")
    rebuilt = spark.read.parquet(f"{run_dir}/trades")
    assert rebuilt.count() == cdc.trade_rows(decoded).count()
    folders = [files for _, _, files in os.walk(f"{run_dir}/trades") if any(f.startswith("part-") for f in files)]
    assert folders and all(len([f for f in files if f.startswith("part-")]) == 1 for files in folders)


def test_pipeline_stops_with_the_error_of_a_dead_stream(spark, run_dir, book_log):
    deliver(book_log, f"{run_dir}/log")
    with open(f"{run_dir}/current", "w") as f:
        f.write("a file where the tables should go")
    with pytest.raises(StreamingQueryException):
        run_forever(spark, file_log(spark, f"{run_dir}/log"), run_dir)
    assert not spark.streams.active
