"""Statistics of documents against plain Python, and what a decision list learns."""

import collections
import os
import random
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from ledgerline.llm import queries, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = collections.defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    covered = {p for at in windows.values() if len(at) > 1 for k in at for p in range(k, k + 8)}
    n, again = len(words), len(covered)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), again, n < 20 or 100 * again > 30 * n)


def odd_texts():
    rng = random.Random(4)
    texts = [None, "", " \n\t", "a", "\x1c\x85\xa0 x", "ÀÉ 日本 😀 # $", "same line\nsame line\n \nsame line \n", "| a | b |\n" * 30]
    for _ in range(60):
        words = [rng.choice("ab") * rng.randrange(1, 3) for _ in range(rng.randrange(60))]
        texts.append("".join(w + rng.choice([" ", "\n", "\t", "\r\n", "\x0b"]) for w in words))
    block = " ".join(f"w{k}" for k in range(9))
    texts += [block, f"{block} {block}", f"{block} x {block} y {block}", "z " * 300, " ".join(f"u{k}" for k in range(30000)) + f" {block} {block}"]
    return texts + texts[10:12]


def test_statistics(spark):
    texts = odd_texts()
    rows = [(k, t, "x", 1, None) for k, t in enumerate(texts)] + [(None, "no id", "x", 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, words string, n_words int, places string").repartition(3)
    got = {r.doc_id: r for r in rules.statistics(docs).collect()}
    assert len(got) == len(rows)
    for k, text in enumerate(texts):
        r = got[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text)[:5], text
        assert all(r[name] is not None for name in rules.GRID)


def grid_examples(spark, rows):
    """Examples with two statistics that vary: symbols per word and share of capitals."""
    names = [n for n in rules.GRID if n not in ("symbols_per_word", "capital_share")]
    frame = spark.createDataFrame(rows, "symbols_per_word double, capital_share double, good boolean, pruning boolean")
    return frame.select("*", *[F.lit(0.0).alias(n) for n in names])


def test_rules_are_conjunctions(spark):
    """Bad is what has many symbols and few capitals; neither alone decides."""
    rng = random.Random(6)
    rows = []
    for k in range(900):
        a, b = rng.random(), rng.random()
        rows.append((a, b, not (a >= 0.5 and b < 0.5), k % 3 == 0))
    examples = grid_examples(spark, rows)
    found = rules.learn(examples)
    assert found.default and all(not r.good for r in found.rules)
    assert {c.statistic for c in found.rules[0].conditions} == {"symbols_per_word", "capital_share"}
    wrong = examples.where(found.verdict() != F.col("good")).count()
    assert wrong <= 0.02 * len(rows)


def test_noise_is_not_learned(spark):
    rng = random.Random(8)
    rows = [(rng.random(), rng.random(), rng.random() < 0.8, k % 3 == 0) for k in range(600)]
    assert rules.learn(grid_examples(spark, rows)).rules == ()


@pytest.mark.parametrize("rows, default", [([], True), ([(0.1, 0.2, True, False)], True), ([(0.1, 0.2, False, True)], False)])
def test_one_class_or_none(spark, rows, default):
    assert rules.learn(grid_examples(spark, rows)) == rules.DecisionList((), default)


def test_judge(spark, run_dir):
    rng = random.Random(9)
    rows = []
    for k in range(400):
        words = [rng.choice("the of tree stone garden river".split()) + str(rng.randrange(900)) for _ in range(rng.randrange(25, 80))]
        bad = k % 5 == 0
        rows.append((k, " ".join(w + "***" if bad else w for w in words), "x"))
    rows += [(400, None, "x"), (None, rows[1][1], "x"), (401, "too short", "x"), rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, good string")
    marks = [(k, int(k % 5 != 0)) for k in range(200)] + [(1000, 1), (None, 0), (5, None)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    judged, found = rules.judge(docs, labels, run_dir)
    got = judged.collect()
    assert len(got) == len(rows) and found.rules
    for r in got:
        if r.doc_id is not None and r.doc_id < 400:
            assert r.kept == (r.doc_id % 5 != 0) and not r.base_failed
    assert {(r.doc_id, r.base_failed, r.kept) for r in got if r.doc_id in (400, 401)} == {(400, True, False), (401, True, False)}
    assert [r.kept for r in got if r.doc_id is None] == [True]
    empty, none = rules.judge(docs.limit(0), labels.limit(0), f"{run_dir}2")
    assert empty.count() == 0 and none == rules.DecisionList()


def test_main_path_is_native(spark):
    plan = queries.QUERIES["op11_quality_rules"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    plan += rules.statistics(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Python|MapIn|InPandas|CartesianProduct|NestedLoop", plan)


def test_registered_query(spark):
    # The smallest tables have too few labels for a rule to prove itself on.
    folder = f"{os.path.dirname(SF)}/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    got = queries.QUERIES["op11_quality_rules"](spark, folder).collect()
    assert len(got) == len(texts)
    for r in got:
        assert tuple(r)[1:7] == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    good = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    right = [r.kept == (good[r.doc_id] == 1) for r in got if r.doc_id in good and not r.base_failed]
    assert sum(right) >= 0.95 * len(right)
