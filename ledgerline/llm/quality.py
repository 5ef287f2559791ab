"""Document quality and toxicity by hierarchical empirical Bayes.

A classifier, fitted on a bounded sample of labelled documents, gives each document its evidence.
Evidence is summed per path and host; a host's rate is shrunk toward the global rate and a path's
toward its host's, the more the fewer documents it has. How far is itself estimated: the prior weight
comes from how much more the sites differ than their sizes explain (method of moments). A document's
posterior is its evidence moved by the difference between its path's rate and the global one.

Only sums per site are shuffled, added up per task first; no site's documents meet in one task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import map_rows, quoted

SAMPLE_PER_CLASS = 2000
VOCABULARY = 600
MIN_DOCS = 15
TARGETS = ("quality", "toxic")
MIN_PRIOR, MAX_PRIOR = 5.0, 10_000.0
_WORD = re.compile(r"[^\W\d_]+")


def shape(text: str, words: list[str]) -> list[float]:
    """How the text looks: length, case, punctuation, repetition."""
    n, tokens = max(len(text), 1), max(len(words), 1)
    letters = sum(map(len, words))
    lines = [x for x in text.split("\n") if x]
    return [
        1.0,
        np.log1p(tokens) / 5,
        sum(1 for w in words if w.isupper() and len(w) > 1) / tokens,
        letters / n,
        sum(text.count(c) for c in "!#$%&*|") / tokens,
        sum(text.count(c) for c in ".,") / tokens,
        letters / tokens / 10,
        len(set(words)) / tokens,
        1 - len(set(lines)) / max(len(lines), 1),
        text.count("http") / tokens,
    ]


SHAPES = 10


def words_of(text: str) -> list[str]:
    return _WORD.findall(text)


@dataclass
class DocumentClassifier:
    vocabulary: dict[str, int]
    weights: np.ndarray  # one row per target

    def features(self, text: str | None) -> tuple[list[float], list[int]]:
        words = words_of(text or "")
        get = self.vocabulary.get
        return shape(text or "", words), sorted({k for w in set(words) if (k := get(w.lower())) is not None})

    def matrix(self, texts: list[str | None]) -> np.ndarray:
        x = np.zeros((len(texts), SHAPES + len(self.vocabulary)))
        for row, text in enumerate(texts):
            look, present = self.features(text)
            x[row, :SHAPES] = look
            x[row, [SHAPES + k for k in present]] = 1
        return x

    def evidence(self, texts: list[str | None]) -> np.ndarray:
        """Log odds of each target, bounded so that no text is beyond doubt."""
        return np.clip(self.matrix(texts) @ self.weights.T, -12, 12)


def informative_words(texts: list[str], labels: np.ndarray, size: int) -> list[str]:
    """Words whose presence differs most between the classes (chi-square), of all targets in turn."""
    docs: dict[str, list[int]] = {}
    for row, text in enumerate(texts):
        for w in {w.lower() for w in words_of(text)}:
            docs.setdefault(w, []).append(row)
    common = sorted(w for w, rows in docs.items() if len(rows) >= MIN_DOCS)
    chosen: dict[str, None] = {}
    for target in range(labels.shape[1]):
        y = labels[:, target]
        share = y.mean()
        if not 0 < share < 1:
            continue
        n = np.array([len(docs[w]) for w in common], dtype=float)
        hits = np.array([y[docs[w]].sum() for w in common])
        # Words that speak for the class; their absence elsewhere is no evidence.
        score = np.where(hits > n * share, (hits - n * share) ** 2 / (n * share * (1 - share)), 0)
        for k in np.argsort(-score, kind="stable")[: size // labels.shape[1]]:
            chosen[common[k]] = None
    return list(chosen)


def ridge_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Weighted logistic regression by damped Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge * w
        step = np.linalg.solve(x.T @ (x * (weight * np.maximum(p * (1 - p), 1e-4))[:, None]) + ridge * np.eye(len(w)), slope)
        w += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-4:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", per_class: int = SAMPLE_PER_CLASS) -> DocumentClassifier:
    """The classifier from at most ``per_class`` labelled documents of each combination of labels.

    The sample is the first by a hash of the id, so it does not depend on the rows' order. Labels and
    documents with nulls are not used; a document with several labels gives several examples.
    """
    slim = docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).cast("string").alias("text")).where("id is not null and text is not null")
    known = labels.select(F.col(quoted(id_col)).alias("id"), *[F.col(t).cast("int").alias(t) for t in TARGETS]).dropna()
    having = known.join(slim.select("id"), "id", "left_semi").persist()
    texts, marks = [], []
    for classes in known.select(*TARGETS).distinct().orderBy(*TARGETS).collect():
        part = having.where(" and ".join(f"{t} = {classes[t]}" for t in TARGETS))
        chosen = part.orderBy(F.xxhash64("id"), "id").limit(per_class)
        for r in slim.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id"), "id").limit(per_class).collect():
            texts.append(r["text"])
            marks.append([r[t] for t in TARGETS])
    having.unpersist()
    y = np.array(marks, dtype=float).reshape(-1, len(TARGETS))
    if not texts:
        weights = np.zeros((len(TARGETS), SHAPES))
        weights[TARGETS.index("toxic"), 0] = -3.0
        return DocumentClassifier({}, weights)
    model = DocumentClassifier({w: k for k, w in enumerate(informative_words(texts, y, VOCABULARY))}, np.zeros((0, 0)))
    x = model.matrix(texts)
    # Classes were sampled alike; weights bring back their shares among all labels.
    total = {tuple(r[t] for t in TARGETS): r["n"] for r in known.groupBy(*TARGETS).agg(F.count("*").alias("n")).collect()}
    seen: dict[tuple, int] = {}
    for m in marks:
        seen[tuple(m)] = seen.get(tuple(m), 0) + 1
    weight = np.array([total[tuple(m)] / seen[tuple(m)] for m in marks])
    weight *= len(marks) / weight.sum()
    model.weights = np.stack([ridge_logistic(x, y[:, t], weight) for t in range(len(TARGETS))])
    return model


def shrunk_rates(evidence: DataFrame, target: str, folder: str) -> DataFrame:
    """Posterior rates of each host and path, from per-document chances ``target``."""
    spark = evidence.sparkSession
    evidence.groupBy("host", "path").agg(F.sum(target).alias("sum"), F.count("*").alias("n")).write.mode("overwrite").parquet(folder)
    paths = spark.read.schema("host string, path string, sum double, n bigint").parquet(folder)
    hosts = paths.groupBy("host").agg(F.sum("sum").alias("host_sum"), F.sum("n").alias("host_n"))

    def prior(sites: DataFrame, rate: str, n: str, mean) -> float:
        """Prior weight in documents: mean (1 - mean) / variance between sites, less 1."""
        spread = F.col(n) * (F.col(rate) - mean) ** 2
        noise = mean * (1 - mean) if isinstance(mean, float) else F.col("centre") * (1 - F.col("centre"))
        r = sites.agg(F.sum(spread).alias("s"), F.sum(F.lit(noise) if isinstance(noise, float) else noise).alias("e"), F.sum(n).alias("n"), F.avg(noise if not isinstance(noise, float) else F.lit(noise)).alias("v")).first()
        between = ((r["s"] or 0) - (r["e"] or 0)) / max(r["n"] or 1, 1)
        return float(np.clip((r["v"] or 0) / between - 1 if between > 0 else MAX_PRIOR, MIN_PRIOR, MAX_PRIOR))

    whole = hosts.agg(F.sum("host_sum").alias("s"), F.sum("host_n").alias("n")).first()
    centre = (whole["s"] or 0.0) / max(whole["n"] or 1, 1)
    with_rate = hosts.withColumn("rate", F.col("host_sum") / F.col("host_n"))
    host_prior = prior(with_rate, "rate", "host_n", centre)
    hosts = hosts.withColumn("host_rate", (F.col("host_sum") + host_prior * centre) / (F.col("host_n") + host_prior))
    sites = paths.join(hosts, paths["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    rated = sites.withColumn("rate", F.col("sum") / F.col("n")).withColumn("centre", F.col("host_rate"))
    path_prior = prior(rated, "rate", "n", F.col("centre"))
    return sites.select(
        "host",
        "path",
        F.col("host_rate").alias(f"{target}_host"),
        ((F.col("sum") + path_prior * F.col("host_rate")) / (F.col("n") + path_prior)).alias(f"{target}_path"),
        F.lit(centre).alias(f"{target}_global"),
    )


def score(
    docs: DataFrame,
    model: DocumentClassifier,
    host,
    path,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id``, ``host``, ``path``, the classifier's chances ``quality_doc``
    and ``toxic_doc``, the sites' rates, the posteriors ``quality`` and ``toxic``, and ``keep``
    (quality at least a half, toxicity less).

    Null texts are empty texts; null hosts and paths are a site of their own; repeated rows count
    each; an empty table gives no rows. Evidence is written below ``folder``, so texts are read once.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col(quoted(id_col)).alias("doc_id"), host.cast("string").alias("host"), path.cast("string").alias("path"), F.col(quoted(text_col)).cast("string").alias("text"))
    shared = spark.sparkContext.broadcast(model)

    def run(block):
        odds = shared.value.evidence(block["text"])
        return {t: odds[:, k].tolist() for k, t in enumerate(TARGETS)}

    found = map_rows(slim, {"text": F.col("text")}, ", ".join(f"{t} double" for t in TARGETS), run, block_bytes=2 << 20)
    odds = found.select("row.doc_id", "row.host", "row.path", *[F.col(f"result.{t}").alias(f"{t}_odds") for t in TARGETS])
    odds.write.mode("overwrite").parquet(f"{folder}/evidence")
    evidence = spark.read.schema(odds.schema).parquet(f"{folder}/evidence")

    def chance(odds):
        return 1 / (1 + F.exp(-odds))

    def logit(p):
        p = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
        return F.log(p / (1 - p))

    evidence = evidence.select("*", *[chance(F.col(f"{t}_odds")).alias(f"{t}_doc") for t in TARGETS])
    for t in TARGETS:
        rates = shrunk_rates(evidence, f"{t}_doc", f"{folder}/sites_{t}").toDF("h", "p", f"{t}_host", f"{t}_path", f"{t}_global")
        evidence = (
            evidence.join(rates, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("p")))
            .drop("h", "p")
            .withColumn(t, chance(F.col(f"{t}_odds") + logit(F.col(f"{t}_path")) - logit(F.col(f"{t}_global"))))
        )
    return evidence.select(
        "doc_id",
        "host",
        "path",
        *[f"{t}{end}" for t in TARGETS for end in ("_doc", "_host", "_path", "")],
        ((F.col("quality") >= 0.5) & (F.col("toxic") < 0.5)).alias("keep"),
    )
