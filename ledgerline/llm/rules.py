"""Quality rules learned as a decision list, in DataFrame functions alone.

Statistics of every document (words, symbols, repeated lines and windows, shares of capitals and so on)
are written once. Sequential covering learns from those of the labelled documents: a rule grows by the
threshold with the best information gain on two thirds of the examples, until it covers one class alone
or nothing gains; it is then pruned to the prefix that does best on the other third, and kept if it is
precise enough there. What it covers is taken away and the next rule is learned. The list ends up as one
chain of Spark conditions.

Thresholds lie on a fixed grid per statistic, so a step needs only counts by (statistic, cell, class): one
aggregation with partial sums, whatever the number of labelled documents.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import quoted

SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

CELLS = 256
# Statistic -> cells per unit. Powers of two keep cell numbers and thresholds exact.
GRID = {
    "n_words": 0.25,
    "mean_word": 8.0,
    "words_per_line": 4.0,
    "symbols_per_word": 64.0,
    "marks_per_word": 64.0,
    "capital_share": 256.0,
    "digit_share": 256.0,
    "distinct_share": 256.0,
    "dup_line_share": 256.0,
    "repeat_share": 256.0,
}
MAX_RULES = 12
MAX_CONDITIONS = 4
MIN_PRECISION = 0.9
MIN_EXAMPLES = 5


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns computed once per row, however often later expressions and lambdas read them."""
    names = list(columns)
    value = F.explode(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))).alias("__once")
    return df.select("*", value).select(*df.columns, *[F.col(f"__once.{k}").alias(k) for k in names])


def _without(text: Column, signs: str) -> Column:
    return F.translate(text, signs, "")


def _repeated_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words`` for array ``words``: the words inside windows that occur again.

    Windows are compared by hash first; texts where two are alike (few) sort them by 128 bits, and
    the sorted places of repeats give the covered words, so a text takes n log n steps.
    """
    last = F.size("words") - WINDOW

    def window(k):
        return F.slice("words", k + 1, WINDOW)

    starts = F.sequence(F.lit(0), last)
    df = _once(df, hashes=F.when(last > 0, F.transform(starts, lambda k: F.xxhash64(window(k)))))
    again = F.size(F.array_distinct("hashes")) < F.size("hashes")
    both = F.transform(starts, lambda k: F.struct(F.xxhash64(window(k)).alias("a"), F.xxhash64(F.lit(WINDOW), window(k)).alias("b"), k.alias("at")))
    df = _once(df, ordered=F.when(again, F.sort_array(both)))

    def same(x, y):
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]), F.lit(False))

    # get() beyond either end is null, which is no repeat.
    repeats = F.filter("ordered", lambda x, k: same(x, F.get("ordered", k + 1)) | same(x, F.get("ordered", k - 1)))
    df = _once(df, places=F.sort_array(F.transform(repeats, lambda x: x["at"])))
    steps = F.transform("places", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("places", k + 1) - p, F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda total, step: total + step)
    return df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0).cast("long"))).drop("hashes", "ordered", "places")


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the counts and the statistics of ``GRID`` for each row of ``docs``.

    Null texts have no words. A statistic whose denominator is 0 is 0.
    """
    df = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit("")).alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.length(_without(line, SPACE)) > 0)
    df = _once(df, words=F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), lines=lines)
    length = F.length("text")

    def long(c):
        return c.cast("long")

    df = _repeated_words(df).select(
        "doc_id",
        long(F.size("words")).alias("n_words"),
        long(F.length(_without(F.col("text"), SPACE))).alias("word_chars"),
        long(length - F.length(_without(F.col("text"), SYMBOLS))).alias("n_symbols"),
        long(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        "n_repeat_words",
        long(F.size("lines")).alias("n_lines"),
        long(F.size(F.array_distinct("words"))).alias("n_distinct"),
        long(length - F.length(_without(F.col("text"), "0123456789"))).alias("n_digits"),
        long(length - F.length(_without(F.col("text"), "!?"))).alias("n_marks"),
        long(F.regexp_count("text", F.lit(r"\p{Lu}"))).alias("n_capitals"),
    )

    def share(a, b):
        return F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)

    return df.select(
        "*",
        share("word_chars", "n_words").alias("mean_word"),
        share("n_words", "n_lines").alias("words_per_line"),
        share("n_symbols", "n_words").alias("symbols_per_word"),
        share("n_marks", "n_words").alias("marks_per_word"),
        share("n_capitals", "word_chars").alias("capital_share"),
        share("n_digits", "word_chars").alias("digit_share"),
        share("n_distinct", "n_words").alias("distinct_share"),
        share("n_dup_lines", "n_lines").alias("dup_line_share"),
        share("n_repeat_words", "n_words").alias("repeat_share"),
    )


@dataclass(frozen=True)
class Condition:
    """``statistic`` at least (or below) a threshold."""

    statistic: str
    at_least: bool
    threshold: float

    def column(self) -> Column:
        value = F.col(self.statistic)
        return value >= self.threshold if self.at_least else value < self.threshold

    def __str__(self) -> str:
        return f"{self.statistic} {'>=' if self.at_least else '<'} {self.threshold:g}"


@dataclass(frozen=True)
class Rule:
    """All conditions together decide that a document is ``good`` or not."""

    conditions: tuple[Condition, ...]
    good: bool

    def column(self) -> Column:
        return _all(self.conditions)

    def __str__(self) -> str:
        return f"{' and '.join(map(str, self.conditions))} -> {'good' if self.good else 'bad'}"


@dataclass(frozen=True)
class DecisionList:
    rules: tuple[Rule, ...] = ()
    default: bool = True
    history: tuple[str, ...] = field(default=(), compare=False)

    def verdict(self) -> Column:
        """The first rule that holds decides, else the default."""
        chain = None
        for rule in self.rules:
            chain = (F if chain is None else chain).when(rule.column(), F.lit(rule.good))
        return F.lit(self.default) if chain is None else chain.otherwise(F.lit(self.default))


def _all(conditions) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c.column()
    return out


def _gain(p0: int, n0: int, p1: int, n1: int) -> float:
    """Information that the p1 covered examples of the class gain."""
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else 0.0


def _best_condition(cells: dict[tuple[str, int], list[int]]) -> tuple[float, int, Condition] | None:
    """The threshold with the largest gain, the fewest others and then in the order of the grid."""
    best = None
    for place, (name, per_unit) in enumerate(GRID.items()):
        counts = [cells.get((name, k), [0, 0]) for k in range(CELLS)]
        p0, n0 = sum(c[0] for c in counts), sum(c[1] for c in counts)
        p, n = 0, 0
        for k in range(1, CELLS):
            p, n = p + counts[k - 1][0], n + counts[k - 1][1]
            for at_least, p1, n1 in ((False, p, n), (True, p0 - p, n0 - n)):
                if p1 + n1 in (0, p0 + n0):
                    continue
                key = (_gain(p0, n0, p1, n1), -n1, -place)
                if key[0] > 1e-9 and (best is None or key > best[0]):
                    best = (key, n1, Condition(name, at_least, k / per_unit))
    return (best[0][0], best[1], best[2]) if best else None


def _histogram(examples: DataFrame, covered: Column, target: bool) -> dict[tuple[str, int], list[int]]:
    """(statistic, cell) -> examples of the target class and of the other one."""
    cells = F.array(*[F.least(F.lit(CELLS - 1), F.floor(F.col(name) * per_unit).cast("int")) for name, per_unit in GRID.items()])
    counted = (
        examples.where(~F.col("pruning") & covered)
        .select("good", F.posexplode(cells).alias("statistic", "cell"))
        .groupBy("statistic", "cell")
        .agg(F.count_if(F.col("good") == target).alias("p"), F.count_if(F.col("good") != target).alias("n"))
    )
    names = list(GRID)
    return {(names[r["statistic"]], r["cell"]): [r["p"], r["n"]] for r in counted.collect()}


def _grown(examples: DataFrame, left: Column, target: bool) -> list[Condition]:
    conditions: list[Condition] = []
    while len(conditions) < MAX_CONDITIONS:
        found = _best_condition(_histogram(examples, left & _all(conditions), target))
        if found is None:
            break
        conditions.append(found[2])
        if found[1] == 0:
            break
    return conditions


def _pruned(examples: DataFrame, left: Column, conditions: list[Condition], target: bool) -> tuple[list[Condition], int, int]:
    """The prefix with the best (p - n) / (p + n) on the pruning examples, the shorter of two; its p and n."""
    prefixes = [_all(conditions[: k + 1]) for k in range(len(conditions))]
    hit = F.col("good") == target
    sums = [c for k, held in enumerate(prefixes) for c in (F.count_if(held & hit).alias(f"p{k}"), F.count_if(held & ~hit).alias(f"n{k}"))]
    r = examples.where(F.col("pruning") & left).agg(*sums).first()
    scored = [((r[f"p{k}"] - r[f"n{k}"]) / max(r[f"p{k}"] + r[f"n{k}"], 1), -k) for k in range(len(prefixes))]
    k = -max(scored)[1]
    return conditions[: k + 1], r[f"p{k}"], r[f"n{k}"]


def learn(examples: DataFrame, min_precision: float = MIN_PRECISION, max_rules: int = MAX_RULES) -> DecisionList:
    """A decision list from ``examples``: the statistics, ``good`` (boolean) and ``pruning`` (boolean).

    Rules are for the rarer class (the bad one of equal ones), the other one is the default. Without
    examples of both classes there are no rules; with none of either, everything is good.
    """
    totals = examples.agg(F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")).first()
    target = totals["good"] < totals["bad"]
    if not totals["good"] or not totals["bad"]:
        return DecisionList((), totals["bad"] == 0)
    rules, history = [], []
    while len(rules) < max_rules:
        left = ~F.coalesce(_any(rules), F.lit(False))
        conditions = _grown(examples, left, target)
        if not conditions:
            break
        conditions, p, n = _pruned(examples, left, conditions, target)
        if p < MIN_EXAMPLES or p < min_precision * (p + n):
            break
        rules.append(Rule(tuple(conditions), target))
        history.append(f"{rules[-1]}: right {p}, wrong {n}")
    return DecisionList(tuple(rules), not target, tuple(history))


def _any(rules) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | rule.column()
    return out


def judge(
    docs: DataFrame,
    labels: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> tuple[DataFrame, DecisionList]:
    """The statistics of every row with ``base_failed`` (fewer than 20 words, or over 30 % of them
    in repeated windows) and ``kept`` (not failed, and good by the list), and the list learned.

    Every label with a document is an example (label 1 is good); a document or label that is there twice
    gives several. Every third id by its checksum prunes. Labels with nulls are not used, null texts have
    no words and fail, null ids are judged like others; an empty table gives no rows. Other columns
    are not read. Statistics are written below ``folder``, so texts are read once.
    """
    spark = docs.sparkSession
    found = statistics(docs, id_col, text_col)
    found.write.mode("overwrite").parquet(f"{folder}/statistics")
    stored = spark.read.schema(found.schema).parquet(f"{folder}/statistics")
    known = labels.select(F.col(quoted(id_col)).alias("doc_id"), (F.col(quoted(label_col)).cast("int") == 1).alias("good")).dropna()
    pruning = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    examples = stored.join(known, "doc_id").select(*GRID, "good", pruning.alias("pruning"))
    examples.write.mode("overwrite").parquet(f"{folder}/examples")
    rules = learn(spark.read.schema(examples.schema).parquet(f"{folder}/examples"))
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return stored.withColumn("base_failed", failed).withColumn("kept", ~failed & rules.verdict()), rules
