"""The tracked depth over versions and books kept from the feed, against plain replays."""

import json
import random
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.operators import book, depth
from ledgerline.operators.ordered import CHUNK, in_ranges, with_next, with_previous, with_running_sum

CHANGES = "symbol_id bigint, side string, price_level decimal(38,18), quantity decimal(38,18), version bigint"


def make_changes(seed, n=240, spread=1):
    """Versions that change up to three levels of a side; symbol 1 has most of them."""
    rng, out = random.Random(seed), []
    for k in range(n):
        symbol, side = rng.choice([1, 1, 1, 2]), rng.choice(["bid", "ask"])
        for price in rng.sample(range(1, 30), rng.randrange(1, 4)):
            out.append((symbol, side, Decimal(price), Decimal(rng.choice([0, 0, 1, 2, 3])), (k + 1) * spread))
    return out


def replay(changes, n):
    """Every version's changes of the best n levels, and the levels at the end."""
    live, shown, out = {}, {}, []
    for version in sorted({c[4] for c in changes}):
        here = [c for c in changes if c[4] == version]
        for symbol, side, price, quantity, _ in here:
            levels = live.setdefault((symbol, side), {})
            if quantity:
                levels[price] = quantity
            else:
                levels.pop(price, None)
        for key in {c[:2] for c in here}:
            best = sorted(live[key], reverse=key[1] == "bid")[:n]
            target, old = {p: live[key][p] for p in best}, shown.get(key, {})
            out += [(*key, p, version, "u" if p in old else "c", q) for p, q in target.items() if old.get(p) != q]
            out += [(*key, p, version, "d", None) for p in old if p not in target]
            shown[key] = target
    return out, shown


@pytest.mark.parametrize("piece, spread", [(1, 1), (7, 10**12), (40, 3), (10_000, 1)])
def test_top_level_diffs(spark, run_dir, piece, spread):
    changes = make_changes(piece, spread=spread)
    frame = spark.createDataFrame(changes + [(None, "bid", None, None, 5)], CHANGES).repartition(3)
    found = depth.top_level_diffs(frame, run_dir, depth=4, piece=piece).collect()
    want, shown = replay(changes, 4)
    assert sorted(map(str, map(tuple, found))) == sorted(str(tuple(spark_row)) for spark_row in as_rows(want))
    # Applied in order, the changes are the tracked depth.
    state = {}
    for r in sorted(found, key=lambda r: r.version):
        levels = state.setdefault((r.symbol_id, r.side), {})
        levels.pop(r.price_level, None) if r.op == "d" else levels.update({r.price_level: r.quantity})
    assert state == shown


def as_rows(want):
    def money(x):
        return None if x is None else x.quantize(Decimal(1).scaleb(-18))

    return [(a, b, money(p), v, op, money(q)) for a, b, p, v, op, q in want]


def test_the_end_equals_the_top_of_the_book(spark, run_dir):
    changes = make_changes(11)
    frame = spark.createDataFrame(changes, CHANGES)
    found = depth.top_level_diffs(frame, run_dir, depth=4, piece=25)
    last = found.groupBy(*book.LEVEL).agg(F.max_by(F.struct("op", "quantity"), "version").alias("l")).where("l.op <> 'd'")
    whole = book.book_at_version(frame.withColumnRenamed("version", "last_update_id"), 10**9)
    assert rows(last, *book.LEVEL, "l.quantity") == rows(book.top_levels(whole, 4), *book.LEVEL, "quantity")


def test_a_hot_symbol_is_many_pieces(spark, run_dir):
    changes = [(1, "bid", Decimal(k % 9 + 1), Decimal(k % 3), k * 10**12) for k in range(600)]
    depth.top_level_diffs(spark.createDataFrame(changes, CHANGES), run_dir, depth=3, piece=20).collect()
    cut = spark.read.parquet(f"{run_dir}/cut")
    sizes = [r["count"] for r in cut.groupBy("symbol_id", "side", "part").count().collect()]
    assert sum(sizes) == 600 and max(sizes) <= 20


def test_no_changes(spark, run_dir):
    assert depth.top_level_diffs(spark.createDataFrame([], CHANGES), run_dir).collect() == []


def snapshot(symbol, update_id, bids, asks=()):
    return symbol, json.dumps({"lastUpdateId": update_id, "bids": bids, "asks": list(asks)})


def diff(symbol, first, last, bids=(), asks=()):
    return symbol, json.dumps({"e": "depthUpdate", "U": first, "u": last, "b": list(bids), "a": list(asks)})


FEED = [
    diff(1, 1, 3, [["9", "1"]]),  # before any snapshot
    snapshot(1, 5, [["10", "1"], ["9.5", "0"]], [["11", "2"]]),
    diff(1, 4, 5, [["7", "1"]]),  # covered by it
    diff(1, 5, 7, [["10", "3"], ["8", "1"], ["8", "2"]]),  # straddles its next id
    diff(1, 8, 9, [], [["11", "0"], ["12", "x"], ["12.5"], ["13", "4"]]),
    diff(1, 11, 12, [["10", "0"]]),  # 10 is missing
    diff(1, 13, 14, [["6", "1"]]),  # follows, but on a lost message
    snapshot(1, 20, [["5", "1"]]),
    diff(1, 21, 21, [["5", "2"]]),
    snapshot(2, 3, [["1", "1"]]),
    diff(2, 9, 9, [["2", "1"]]),  # does not reach back to the snapshot
    snapshot(3, 3, []),
    diff(3, 4, 4, [], [["2", "1"]]),
    diff(4, 1, 1, [["2", "1"]]),  # a symbol without a snapshot
    (5, None),
    (5, "no json"),
]
BOOKS = [
    (1, 5, "bid", "10", "3", 7),
    (1, 5, "bid", "8", "2", 7),
    (1, 5, "ask", "13", "4", 9),
    (1, 20, "bid", "5", "2", 21),
    (2, 3, "bid", "1", "1", 3),
    (3, 3, "ask", "2", "1", 4),
]


@pytest.mark.parametrize("width", [1, 3, 1_000_000, None])
def test_book_from_feed(spark, run_dir, width):
    """A snapshot starts a book, a gap ends it; ``None``: chunks by ranges of the data."""
    messages = spark.createDataFrame(FEED, "symbol_id bigint, payload string").repartition(3)
    how = {"path": run_dir} if width is None else {"width": width}
    found = depth.book_from_feed(messages, **how)
    want = [(a, b, c, Decimal(p), Decimal(q), u) for a, b, c, p, q, u in BOOKS]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_rows_pass_one_exchange(spark):
    """The feed is shuffled once for its sequence; what crosses chunks are aggregates of it."""
    ev = spark.range(100).selectExpr("id % 2 as symbol_id", "id as first_u", "id as last_u")
    sn = spark.range(2).selectExpr("id as symbol_id", "id as last_update_id")
    plan = book.check_sequence(ev, sn)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") >= 1
    physical = book.check_sequence(ev, sn)
    physical.collect()
    text = physical._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in text


@pytest.mark.parametrize("spread", [1, 10**12])
def test_ordered_functions_over_ranges(spark, run_dir, spread):
    """Ids that lie far apart: chunks are ranges of the rows, so edges stay few."""
    data = [(k % 3 if k % 5 else 0, k * spread, k) for k in range(400)]
    frame = spark.createDataFrame(data + [(None, 1, 1), (1, None, 1)], "key int, id bigint, v bigint").repartition(5)
    cut = in_ranges(frame, ["key"], "id", run_dir)
    assert cut.select("key", CHUNK).distinct().count() <= 4 + 3
    back = with_previous(cut, ["key"], "id", {"v": "before"})
    both = with_next(back, ["key"], "id", {"v": "after"})
    summed = with_running_sum(both, ["key"], "id", F.col("v"), "total").drop(CHUNK)
    want = []
    for key in range(3):
        mine = sorted(d for d in data if d[0] == key)
        for j, (k, i, v) in enumerate(mine):
            before = mine[j - 1][2] if j else None
            after = mine[j + 1][2] if j + 1 < len(mine) else None
            want.append((k, i, v, before, after, sum(m[2] for m in mine[: j + 1])))
    assert sorted(map(str, map(tuple, summed.collect()))) == sorted(map(str, want))
