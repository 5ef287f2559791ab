import itertools
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from ledgerline.operators.latest import first_ranked, latest_per_key
from ledgerline.operators.merge import fold_changes, keyed_merge, merge_into_table, new_rows, upsert_if_changed

ROW = "k int, v string, n int"


def state(spark, *data):
    return spark.createDataFrame(list(data), ROW)


def batch(spark, *data):
    return spark.createDataFrame(list(data), ROW + ", deleted boolean")


def test_merge_clauses(spark):
    old = state(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4))
    new = batch(
        spark,
        (1, "A", 10, False),
        (2, None, None, True),
        (3, "C", None, None),
        (5, "e", 5, False),
        (6, "f", 6, True),
        (7, "g", 7, None),
    )
    got = keyed_merge(old, new, ["k"])
    assert rows(got) == [(1, "A", 10), (3, "C", None), (4, "d", 4), (5, "e", 5)]


def test_merge_is_idempotent(spark):
    old, new = state(spark, (1, "a", 1)), batch(spark, (1, "A", 2, False), (2, "b", 1, False), (3, "c", 1, True))
    once = keyed_merge(old, new, ["k"])
    assert rows(keyed_merge(once, new, ["k"])) == rows(once)


def test_merge_into_or_from_empty(spark):
    old, new = state(spark), batch(spark, (1, "A", 2, False))
    assert rows(keyed_merge(old, new, ["k"])) == [(1, "A", 2)]
    assert rows(keyed_merge(state(spark, (1, "a", 1)), batch(spark), ["k"])) == [(1, "a", 1)]


def test_version_guard(spark):
    newer = lambda n, o: n["n"] >= o["n"]
    old = state(spark, (1, "a", 5), (2, "b", 5), (3, "c", 5))
    new = batch(spark, (1, "late", 4, False), (2, "same", 5, False), (3, None, 4, True))
    assert rows(keyed_merge(old, new, ["k"], update_when=newer)) == [(1, "a", 5), (2, "same", 5), (3, "c", 5)]


def test_insert_only(spark):
    got = new_rows(state(spark, (1, "a", 1)), state(spark, (1, "other", 9), (2, "b", 2)), ["k"])
    assert rows(got, "k", "v", "n") == [(2, "b", 2)]


def test_upsert_only_if_watched_column_differs(spark):
    old = state(spark, (1, "a", 1), (2, "b", 2), (3, "c", None), (4, "d", None))
    new = state(spark, (1, "A", 1), (2, "B", 3), (3, "C", 1), (4, "D", None), (5, "E", 5))
    got = upsert_if_changed(old, new, ["k"], ["n"])
    assert rows(got) == [(1, "a", 1), (2, "B", 3), (3, "C", 1), (4, "d", None), (5, "E", 5)]


@pytest.mark.parametrize("seed", range(3))
def test_folded_changes_equal_merging_one_by_one(spark, seed):
    """Any run of batches, with three-valued flags, has the net effect of its fold."""
    rng = random.Random(seed)
    batches = [
        [(k, f"{b}-{k}", b, rng.choice([True, False, None])) for k in rng.sample(range(8), 5)]
        for b in range(4)
    ]
    step = state(spark, *[(k, "old", 0) for k in range(4)])
    start = step
    for b in batches:
        step = keyed_merge(step, batch(spark, *b), ["k"])
    all_changes = spark.createDataFrame(
        [(*r, i) for i, b in enumerate(batches) for r in b], ROW + ", deleted boolean, batch int"
    )
    folded = fold_changes(all_changes, ["k"], F.col("batch")).drop("batch")
    assert rows(keyed_merge(start, folded, ["k"])) == rows(step)


def test_latest_forms_agree(spark):
    rng = random.Random(1)
    data = [(k, rng.choice([None, 1, 2, 3]), o, f"x{o}") for o, k in enumerate(itertools.islice(itertools.cycle(range(3)), 30))]
    df = spark.createDataFrame(data, "k int, version int, pos int, v string")
    ranked = first_ranked(df, ["k"], [F.col("version").desc_nulls_last(), F.col("pos").desc()])
    assert rows(latest_per_key(df, ["k"], ["version", "pos"])) == rows(ranked)


def test_first_ranked_keeps_n(spark):
    df = spark.createDataFrame([(k, i) for k in (1, 2) for i in range(5)], "k int, i int")
    assert rows(first_ranked(df, ["k"], [F.col("i").desc()], 2)) == [(1, 3), (1, 4), (2, 3), (2, 4)]


def test_catalog_merge_is_refused_by_plain_files_only(spark):
    """Parquet tables have no row-level operations; the statement itself is accepted."""
    spark.sql("create table if not exists merge_target (k int, v string, n int) using parquet")
    with pytest.raises(Exception, match="MERGE INTO TABLE"):
        merge_into_table(batch(spark, (1, "a", 1, False)), "merge_target", ["k"], ["v", "n"])
