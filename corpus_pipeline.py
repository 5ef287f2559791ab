"""From raw documents to packed training windows, in five stages.

Each stage takes all that its predecessor kept; all but the last return the columns of documents.
A document is rejected by language ID if no learned language holds a quarter of its n-grams; of each
group of near copies the one with the smallest id stays; passages of the benchmark are cut out, and
documents that mostly consist of them go; personal data is masked; what is left is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import fmindex, langid, packing, pii, setjoin
from ledgerline.llm.blocks import quoted
from ledgerline.llm.queries import prepare
from ledgerline.session import new_run_dir

MIN_LANGUAGE = 0.25
MAX_HIT = 0.5
COPY_WORDS = 5  # words of a shingle, and the least similarity of near copies
COPY_RULE = setjoin.Threshold(80, 100)


def _unpacked(df: DataFrame, columns: list[str], **changed) -> DataFrame:
    """The columns of struct ``row``, some of them changed."""
    return df.select(*[changed.get(c, F.col(f"row.{quoted(c)}")).alias(c) for c in columns])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents in a learned language; fills in the language where it is null. Keeps all if none is learned."""
    prepare(spark)
    model = langid.train(docs)
    if not model.languages:
        # No document names its language, so there is nothing to reject by.
        return docs
    found = langid.identify(docs, model)
    kept = found.where((F.col("result.lang_pred") != langid.UNKNOWN) & (F.col("result.score") >= MIN_LANGUAGE))
    return _unpacked(kept, docs.columns, lang=F.coalesce("row.lang", "result.lang_pred"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each component the document with the smallest id, and of repeated rows one."""
    prepare(spark)
    folder = new_run_dir(spark, "setjoin")
    key = F.struct("doc_id", F.xxhash64("text").alias("text_key"))
    found = setjoin.components(docs.select(key.alias("key"), "text"), folder, id_col="key", shingle=COPY_WORDS, rule=COPY_RULE)
    found.select(F.col("doc_id").alias("key"), F.col("component_id").alias("kept")).write.parquet(f"{folder}/decisions")
    decided = spark.read.parquet(f"{folder}/decisions")
    again = decided.groupBy("key").agg(F.count("*").alias("n"), F.first("kept").alias("kept"))
    gone = _few(again.where(~F.col("key").eqNullSafe(F.col("kept"))).select(F.col("key").alias("gone")))
    repeated = _few(again.where(F.col("key").eqNullSafe(F.col("kept")) & (F.col("n") > 1)).select(F.col("key").alias("again")))
    kept = docs.join(gone, key.eqNullSafe(F.col("gone")), "left_anti")
    single = kept.join(repeated, key.eqNullSafe(F.col("again")), "left_anti")
    first = kept.join(repeated, key.eqNullSafe(F.col("again")), "left_semi").dropDuplicates(["doc_id", "text"])
    return single.unionByName(first)


def _few(keys: DataFrame) -> DataFrame:
    """Broadcast if counted to be few, else joined by shuffling."""
    return F.broadcast(keys) if keys.count() <= setjoin.BROADCAST_IDS else keys


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts benchmark passages out; drops documents of which they are more than half."""
    prepare(spark)
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = fmindex.decontaminate(docs, benchmark)
    kept = found.where(F.col("result.n_hit") <= MAX_HIT * F.col("result.n_words"))
    spans = F.col("result.spans")
    text = F.col("row.text")
    # What stands between one span's end and the next one's start.
    starts = F.concat(F.array(F.lit(0).cast("bigint")), spans["end"])
    ends = F.concat(spans["start"], F.array(F.length(text).cast("bigint")))
    pieces = F.transform(
        F.arrays_zip(starts.alias("b"), ends.alias("e")), lambda p: text.substr((p["b"] + 1).cast("int"), (p["e"] - p["b"]).cast("int"))
    )
    cut = F.when(F.size(spans) > 0, F.array_join(pieces, "")).otherwise(text)
    return _unpacked(kept, docs.columns, text=cut, n_chars=F.coalesce(F.length(cut).cast("bigint"), F.col("row.n_chars")))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks personal data."""
    prepare(spark)
    found = pii.redact(docs, pii.train(docs))
    text = F.col("result.text")
    return _unpacked(found, docs.columns, text=text, n_chars=F.coalesce(F.length(text).cast("bigint"), F.col("row.n_chars")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full windows, with their token ids."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", language),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("PII", personal_data),
    ("packing", packed),
]

ORACLE_SQL = None  # no stage is expressible in SQL; tests compare them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_run_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
