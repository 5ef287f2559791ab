from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from ledgerline.operators import book

LEVELS = "symbol_id bigint, side string, price_level decimal(38,18), quantity decimal(38,18), last_update_id bigint"


def levels(spark, *data):
    return spark.createDataFrame([(s, side, Decimal(p), Decimal(q), u) for s, side, p, q, u in data], LEVELS)


def test_top_of_book_takes_the_freshest_level(spark):
    df = levels(spark, (1, "bid", 10, 1, 5), (1, "bid", 99, 1, 2), (1, "ask", 12, 1, 6), (1, "ask", 11, 1, 1))
    r = book.top_of_book(df).first()
    assert (r.best_bid, r.best_ask, r.spread, r.spread_pct) == (10, 12, 2, 20.0)
    assert (r.book_version, r.bid_levels, r.ask_levels) == (6, 2, 2)


def test_top_of_book_ties_and_one_side(spark):
    df = levels(spark, (1, "bid", 10, 1, 5), (1, "bid", 11, 1, 5), (1, "ask", 14, 1, 5), (1, "ask", 13, 1, 5), (2, "bid", 3, 1, 1))
    got = {r.symbol_id: r for r in book.top_of_book(df).collect()}
    assert (got[1].best_bid, got[1].best_ask) == (11, 13)
    assert (got[2].best_ask, got[2].spread, got[2].spread_pct, got[2].ask_levels) == (None, None, None, 0)


def test_spread_pct_needs_a_positive_bid(spark):
    r = book.top_of_book(levels(spark, (1, "bid", 0, 1, 1), (1, "ask", 2, 1, 1))).first()
    assert (r.spread, r.spread_pct) == (2, None)


def test_spread_of_wide_decimals_is_exact(spark):
    df = levels(spark, (1, "bid", "64000.123456789012345678", 1, 1), (1, "ask", "64000.123456789012345688", 1, 1))
    assert book.top_of_book(df).first().spread == Decimal("0.000000000000000010")


def test_best_quote_shows_a_crossed_book(spark):
    r = book.best_quote(levels(spark, (1, "bid", 10, 1, 1), (1, "bid", 12, 1, 2), (1, "ask", 11, 1, 3))).first()
    assert (r.best_bid, r.best_ask, r.is_crossed) == (12, 11, True)


def test_top_levels_per_side(spark):
    df = levels(spark, *[(1, s, p, 1, 1) for s in ("bid", "ask") for p in range(1, 6)])
    assert rows(book.top_levels(df, 2), "side", "price_level") == [
        ("ask", Decimal(1)),
        ("ask", Decimal(2)),
        ("bid", Decimal(4)),
        ("bid", Decimal(5)),
    ]


def test_depth_imbalance(spark):
    df = levels(spark, (1, "bid", 10, 6, 1), (1, "ask", 11, 2, 1), (1, "ask", 50, 100, 1), (2, "bid", 1, 0, 1))
    assert rows(book.depth_imbalance(df, 1), "symbol_id", "imbalance") == [(1, 0.5), (2, None)]


def test_diff_and_apply(spark):
    old = levels(spark, (1, "bid", 1, 5, 1), (1, "bid", 2, 5, 1), (1, "ask", 3, 5, 1))
    new = levels(spark, (1, "bid", 1, 5, 9), (1, "bid", 2, 6, 9), (1, "ask", 4, 7, 9))
    diff = book.level_changes(old, new)
    assert rows(diff, "side", "price_level", "op") == [
        ("ask", Decimal(3), "d"),
        ("ask", Decimal(4), "c"),
        ("bid", Decimal(2), "u"),
    ]
    assert rows(book.apply_level_changes(old, diff)) == rows(new.drop("last_update_id"))


def test_book_at_version(spark):
    diffs = levels(spark, (1, "bid", 1, 5, 1), (1, "bid", 1, 0, 2), (1, "bid", 1, 7, 3), (1, "ask", 2, 1, 2))
    at = lambda v: rows(book.book_at_version(diffs, v), "side", "quantity")
    assert at(1) == [("bid", Decimal(5))]
    assert at(2) == [("ask", Decimal(1))]
    assert at(3) == [("ask", Decimal(1)), ("bid", Decimal(7))]


def test_snapshot_levels_drop_zero(spark):
    payload = '{"lastUpdateId": 9, "bids": [["1.5","2"],["1.4","0.000"]], "asks": [["1.6","3"]]}'
    df = spark.createDataFrame([(1, payload)], "symbol_id bigint, payload string")
    assert rows(book.snapshot_levels(df), "side", "price_level", "quantity", "last_update_id") == [
        ("ask", Decimal("1.6"), Decimal(3), 9),
        ("bid", Decimal("1.5"), Decimal(2), 9),
    ]


def sequence(spark, events, snap, width):
    ev = spark.createDataFrame([(1, a, b) for a, b in events], "symbol_id bigint, first_u bigint, last_u bigint")
    sn = spark.createDataFrame([(1, snap)], "symbol_id bigint, last_update_id bigint")
    return rows(book.check_sequence(ev, sn, width).select("first_u", "is_gap", "resync_epoch"))


def test_sequence_check(spark):
    # (1,3) and (4,5) are covered by the snapshot; (6,8) straddles 7; (12,14) leaves a gap; (14,16) overlaps.
    events = [(1, 3), (4, 5), (6, 8), (9, 11), (14, 16), (17, 18), (18, 20)]
    want = [(6, False, 0), (9, False, 0), (14, True, 1), (17, False, 1), (18, True, 2)]
    for width in (2, 5, 1_000_000):
        assert sorted(sequence(spark, events, 6, width)) == want


def test_first_event_must_straddle_the_snapshot(spark):
    assert sequence(spark, [(9, 11)], 6, 1_000_000) == [(9, True, 1)]


CHANGES = LEVELS + ", deleted boolean, kafka_offset bigint"


def changes(spark, *data):
    return spark.createDataFrame([(1, "bid", Decimal(p), Decimal(q), u, d, o) for p, q, u, d, o in data], CHANGES)


def test_latest_change_of_a_level_wins_inside_a_batch(spark):
    """A delete repeats the id of what it deletes, so the offset tells them apart."""
    df = changes(spark, (1, 5, 7, False, 1), (1, 5, 7, True, 2), (2, 5, 8, True, 3), (2, 6, 9, False, 4))
    assert rows(book.live_levels(df), "price_level", "quantity") == [(Decimal(2), Decimal(6))]


def test_merge_levels_does_not_depend_on_the_batching(spark):
    log = [(1, 5, 1, False, 1), (1, 5, 1, True, 2), (2, 1, 3, False, 3), (2, 4, 4, False, 4), (3, 1, 5, False, 5), (1, 9, 6, False, 6)]
    whole = rows(book.live_levels(changes(spark, *log)))
    for cut in range(1, len(log)):
        first = book.live_levels(changes(spark, *log[:cut]))
        assert rows(book.merge_levels(first, changes(spark, *log[cut:]))) == whole


def test_guard_ignores_a_late_change(spark):
    stored = book.live_levels(changes(spark, (1, 5, 7, False, 10)))
    late = changes(spark, (1, 1, 6, False, 2))
    assert rows(book.merge_levels(stored, late), "quantity") == [(Decimal(1),)]
    assert rows(book.merge_levels(stored, late, version_guard=True), "quantity") == [(Decimal(5),)]


def test_book_side_is_lower_cased(spark):
    from ledgerline.plans.marts import staged_levels

    df = levels(spark, (1, "BID", 1, 1, 1)).withColumn("updated_at", F.lit(None).cast("timestamp"))
    assert staged_levels(df).first().side == "bid"
