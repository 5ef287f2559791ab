import datetime as dt
import json
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from ledgerline.functions import exprs
from ledgerline.functions.ddl import create_tables, table_ddl
from ledgerline.functions.schemas import LOG
from ledgerline.operators import cdc
from ledgerline.operators.feed import flatten_symbol_info, parse_trades, resolve_symbols
from ledgerline.plans.queries_log import SLICES, ship
from ledgerline.sources.log import from_offset, in_even_parts, kafka_log

LEVEL = {
    "symbol_id": 1,
    "side": "bid",
    "price_level": "100.5",
    "quantity": "2.50",
    "last_update_id": 7,
    "updated_at": "2024-01-01T00:00:08Z",
}


def envelope(op="c", after=None, before=None, ts_ms=1704067207179, lsn=42):
    return json.dumps({"op": op, "ts_ms": ts_ms, "source": {"lsn": lsn}, "before": before, "after": after})


def log(spark, *values, table="orderbook_levels", prefix="cdc.public."):
    data = [(prefix + table, 0, i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, LOG)


def test_decode_fields_and_tombstone(spark):
    out = cdc.decode(log(spark, envelope(after=LEVEL), None)).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.src_table, r.op, r.ts_ms, r.source_lsn, r.symbol_id) == ("orderbook_levels", "c", 1704067207179, 42, 1)
    assert json.loads(r.after) == LEVEL and r.before is None
    assert '"2.50"' in r.after


def test_decode_delete_routes_by_before_image(spark):
    r = cdc.decode(log(spark, envelope("d", None, LEVEL))).first()
    assert (r.op, r.symbol_id, r.after) == ("d", 1, None)


@pytest.mark.parametrize(
    "value",
    ["garbage", "[1,2]", "{}", '{"op":null}', '{"op":"c","after":{bad}}', '"text"', "", '{"op":"c","ts_ms":"x"}'],
)
def test_decode_odd_records_agree_with_json_paths(spark, value):
    got = cdc.decode(log(spark, value)).select("op", "ts_ms", "after", "before")
    paths = log(spark, value).select(
        F.get_json_object("value", "$.op"),
        F.get_json_object("value", "$.ts_ms").try_cast("bigint"),
        F.get_json_object("value", "$.after"),
        F.get_json_object("value", "$.before"),
    )
    assert rows(got) == rows(paths)


def test_custom_topic_prefix(spark):
    raw = log(spark, envelope(after=LEVEL), prefix="shop.")
    assert cdc.decode(raw, "shop.").first().src_table == "orderbook_levels"
    assert cdc.decode(raw).first().src_table == "shop.orderbook_levels"


def test_ingest_date_is_event_time(spark):
    r = cdc.landing_rows(cdc.decode(log(spark, envelope(after=LEVEL, ts_ms=0)))).first()
    assert r.ingest_date == dt.date(1970, 1, 1)


def changed(**kw):
    return {**LEVEL, **kw}


@pytest.mark.parametrize(
    "op,after,before,flag",
    [
        ("c", LEVEL, None, False),
        ("u", changed(quantity="0"), LEVEL, True),
        ("u", changed(quantity="0.000"), LEVEL, True),
        ("u", changed(quantity=None), LEVEL, True),
        ("d", None, LEVEL, True),
        (None, LEVEL, None, None),
        (None, changed(quantity="0"), None, True),
        ("u", changed(quantity="abc"), LEVEL, None),
    ],
)
def test_delete_flag_is_three_valued(spark, op, after, before, flag):
    out = cdc.book_changes(cdc.decode(log(spark, envelope(op, after, before)))).collect()
    assert [r.deleted for r in out] == [flag]


def test_one_bad_field_is_null_not_fatal(spark):
    r = cdc.book_changes(cdc.decode(log(spark, envelope(after=changed(last_update_id="x", updated_at="no"))))).first()
    assert (r.last_update_id, r.updated_at, r.price_level) == (None, None, Decimal("100.5"))


def test_rows_without_key_are_rejected_and_counted(spark):
    values = [
        envelope(after=changed(symbol_id=None)),
        envelope("u", "text", LEVEL),
        envelope("t"),
        "garbage",
        envelope(after=LEVEL),
    ]
    decoded = cdc.decode(log(spark, *values))
    assert cdc.book_changes(decoded).count() == 1
    assert rows(cdc.rejects(decoded, "orderbook_levels"), "kafka_offset", "reason") == [
        (0, "no key"),
        (1, "no key"),
        (2, "unsupported operation"),
        (3, "no operation"),
    ]


def test_a_record_is_either_kept_or_rejected(spark):
    values = [
        envelope(after=changed(price_level="abc")),
        envelope(after=changed(side=None)),
        envelope(after=LEVEL),
        "garbage",
    ]
    decoded = cdc.decode(log(spark, *values))
    assert rows(cdc.book_changes(decoded), "kafka_offset") == [(1,), (2,)]
    assert rows(cdc.rejects(decoded, "orderbook_levels"), "kafka_offset", "reason") == [
        (0, "unreadable key"),
        (3, "no operation"),
    ]


def test_trades_are_kept_rejected_or_ignored_by_rule(spark):
    trade = {"trade_id": 1, "price": "abc"}
    values = [envelope(after=trade), envelope("u", trade, trade), envelope(after={"symbol_id": 1}), envelope("t", trade)]
    decoded = cdc.decode(log(spark, *values, table="trades"))
    assert rows(cdc.trade_rows(decoded), "kafka_offset") == [(0,)]
    assert rows(cdc.rejects(decoded, "trades"), "kafka_offset", "reason") == [(2, "no key"), (3, "unsupported operation")]


def test_dimension_update_can_set_null(spark):
    old = {"exchange_id": 1, "name": "X", "region": "EU", "updated_at": "2024-01-01T00:00:00Z"}
    new = {**old, "region": None}
    decoded = cdc.decode(log(spark, envelope("u", new, old), envelope("d", None, old), table="exchanges"))
    assert rows(cdc.dimension_changes(decoded, "exchanges"), "region", "deleted") == [(None, False), ("EU", True)]


def test_trades_keep_inserts_and_snapshots_only(spark):
    t = {"trade_id": 1, "symbol_id": 1, "price": "1.1", "quantity": "2", "quote_qty": "2.2", "is_buyer_maker": True}
    values = [envelope(op, {**t, "trade_id": i}) for i, op in enumerate("crud")]
    assert rows(cdc.trade_rows(cdc.decode(log(spark, *values, table="trades"))), "trade_id") == [(0,), (1,)]


@pytest.mark.parametrize(
    "text,want",
    [
        ("2024-01-01T00:00:07Z", dt.datetime(2024, 1, 1, 0, 0, 7)),
        ("2024-01-01T00:00:07.75Z", dt.datetime(2024, 1, 1, 0, 0, 7, 750000)),
        ("2024-01-01T00:00:07.179575Z", dt.datetime(2024, 1, 1, 0, 0, 7, 179575)),
        ("2024-01-01T02:00:07+02:00", dt.datetime(2024, 1, 1, 0, 0, 7)),
        ("2024-01-01", None),
        ("1704067207179", None),
        (None, None),
    ],
)
def test_instants(spark, text, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(exprs.to_instant("t").cast("timestamp_ntz")).first()[0] == want


def test_notional_is_exact(spark):
    df = spark.createDataFrame([("64000.12345678", "0.00012345"), ("x", "1"), (None, "1")], "p string, q string")
    got = [r[0] for r in df.select(exprs.notional("p", "q")).collect()]
    assert got == [Decimal("64000.12345678") * Decimal("0.00012345"), None, None]


@pytest.mark.parametrize(
    "price, quantity, want",
    [
        ("0.123456789123", "1", "0.123456789123"),
        ("12345678901.5", "1", "12345678901.5"),
        ("0.000000001234", "1000000", "0.001234"),
        ("-1.5", "0.000000000000000002", "-0.000000000000000003"),
        ("1000000000000000000", "1000000000000000000", None),
    ],
)
def test_notional_keeps_digits_and_large_amounts(spark, price, quantity, want):
    df = spark.createDataFrame([(price, quantity)], "p string, q string")
    got = df.select(exprs.notional("p", "q")).first()[0]
    assert got == (None if want is None else Decimal(want))


def test_taker_side_of_unknown_is_buy(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "m boolean")
    assert [r[0] for r in df.select(exprs.taker_side("m")).collect()] == ["sell", "buy", "buy"]


def test_replay_from_offset(spark):
    raw = log(spark, *[envelope(after=LEVEL)] * 4)
    assert rows(from_offset(raw, 1), "offset") == [(2,), (3,)]


def test_trade_messages(spark):
    msgs = [
        {"data": {"s": "A", "p": "1.5", "q": "2", "t": 9, "m": False, "T": 1704067207179}},
        {"data": {"s": "?", "p": "1", "q": "1", "t": 10, "m": True, "T": 0}},
    ]
    parsed = parse_trades(spark.createDataFrame([(json.dumps(m),) for m in msgs], "message string"))
    symbols = spark.createDataFrame([("A", 4)], "symbol string, symbol_id bigint")
    got = resolve_symbols(parsed, symbols).collect()
    assert [(r.symbol_id, r.trade_id, r.quote_qty) for r in got] == [(4, 9, Decimal(3))]
    assert got[0].trade_time == dt.datetime.fromtimestamp(1704067207.179)


def test_symbol_info_filters(spark):
    def sym(name, *filters):
        return {"symbol": name, "baseAsset": "b", "quoteAsset": "q", "status": "TRADING", "filters": list(filters)}

    price = lambda v: {"filterType": "PRICE_FILTER", "tickSize": v}
    lot = lambda v: {"filterType": "LOT_SIZE", "stepSize": v}
    body = {"symbols": [sym("A", price("0.1"), lot("2")), sym("B", lot("3")), sym("C", price("1"), price("2")), sym("D")]}
    df = spark.createDataFrame([(json.dumps(body),)], "message string")
    assert rows(flatten_symbol_info(df), "symbol", "tick_size", "step_size") == [
        ("A", Decimal("0.1"), Decimal(2)),
        ("B", None, Decimal(3)),
        ("C", Decimal(2), None),
        ("D", None, None),
    ]


def test_ddl(spark):
    create_tables(spark, "lake_test")
    create_tables(spark, "lake_test")
    names = {r.tableName for r in spark.sql("show tables in lake_test").collect()}
    assert {"landing_trades", "trades", "orderbook_levels", "symbols", "exchanges"} <= names
    assert "days(trade_time), symbol_id" in table_ddl("x.y", "iceberg")["trades"]


def test_kafka_source_asks_for_its_connector(spark):
    """The connector is not on this classpath; everything up to loading it is in order."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        kafka_log(spark, "broker:9092", "shop.", "latest", 5)


def test_a_shipped_log_is_not_cached_and_comes_whole(spark, run_dir):
    made = log(spark, *[f"v{i}" for i in range(40)]).withColumn("slice", F.col("offset") % 6)
    kept, seen = spark.sparkContext._jsc.getPersistentRDDs().size(), []
    for n in ship(made, run_dir):
        assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
        seen.append(spark.read.schema(LOG).parquet(run_dir).count())
    assert seen == [sum(i % 6 <= n for i in range(40)) for n in range(SLICES)]
    assert rows(spark.read.schema(LOG).parquet(run_dir)) == rows(made.where("slice < 5").drop("slice"))


def test_a_large_split_of_a_log_is_dealt_out(spark):
    values = [f"{i:0100}" for i in range(2000)] + [None]
    made = log(spark, *values).coalesce(1)
    assert in_even_parts(made).rdd.getNumPartitions() == 1
    dealt = in_even_parts(made, most=20_000)
    sizes = [sum(len(r.value or "") for r in part) for part in dealt.rdd.glom().collect()]
    assert len(sizes) == 10 and max(sizes) < 25_000
    assert rows(dealt) == rows(made)
    assert in_even_parts(made.limit(0)).count() == 0
