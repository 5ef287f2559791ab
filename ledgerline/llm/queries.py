"""One query per operator, over its whole table and with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import chat, fmindex, langid, lm, merkle, packing, pii, quality, rules, setjoin, topk, warc, whitening
from ledgerline.llm.oracles import CHAT_SQL, DECONTAMINATION_SQL, TOP_K_SQL, WARC_SQL
from ledgerline.session import new_run_dir, pin_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

SETTINGS = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}


def prepare(spark: SparkSession) -> None:
    """Settings the operators rely on: UTC, adaptive execution, Arrow batches of bounded size."""
    pin_settings(spark)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)


def query(name: str, oracle: str | None = None):
    def register(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


@query("op1_packing")
def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "sequence_tokens", "step_group",
    )


@query("op3_decontamination", DECONTAMINATION_SQL)
def op3(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = fmindex.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("result.n_words").alias("n_words"),
        F.col("result.n_hit").alias("n_hit"),
        F.size("result.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.transform("result.items", lambda i: i.cast("string")), ","), 256).alias("items_sha256"),
        (F.col("result.n_hit") > 0).alias("contaminated"),
    )


@query("op2_chat_windows", CHAT_SQL)
def op2(spark, sf_dir):
    says = "\\### Assistant: </turn> ok"
    extra = spark.sql("select -7L as conv_id, t.turn, t.role, t.text from values (0L, 'user', :says), (1L, 'assistant', :says) as t(turn, role, text)", args={"says": says})
    turns = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text").unionByName(extra)
    read = chat.read_windows(chat.format_windows(turns))
    written = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(written, ""), 256).alias("turns_sha256"),
        F.length(F.array_join("loss", "")).cast("bigint").alias("loss_chars"),
        F.sha2(F.array_join("loss", ""), 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query("op5_warc", WARC_SQL)
def op5(spark, sf_dir):
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    chunks = warc.round_trip(pages, new_run_dir(spark, "warc"))
    response = F.col("record_type") == "response"
    return chunks.where("is_last").select(
        F.col("record_id").cast("bigint").alias("page_id"),
        F.when(response, F.col("bytes_so_far")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(response, F.col("digest_so_far")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        F.col("refers_to").cast("bigint").alias("refers_to"),
    )


@query("op7_quality")
def op7(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "source", "lang")
    model = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality", "toxic"))
    path = F.concat_ws("/", "source", "lang")
    return quality.score(docs, model, F.col("source"), path, new_run_dir(spark, "quality"))


@query("op8_topk", TOP_K_SQL)
def op8(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return topk.top_k(rows, F.col("id") % 50 == 0, new_run_dir(spark, "topk"))


@query("op9_language")
def op9(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = langid.train(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), model)
    return found.select(
        "row.doc_id", F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
        "result.lang_pred", "result.score",
    )


def joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def of_kind(kind):
    return lambda span: span["kind"] == kind


@query("op10_pii")
def op10(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = pii.find(docs, pii.train(docs)).select(
        "row.doc_id", F.col("result.spans").alias("all"), F.filter("result.spans", lambda s: s["strict"]).alias("base")
    )
    return found.select(
        "doc_id",
        *[F.size(F.filter("base", of_kind(kind))).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"),
        joined("all").alias("spans"),
    )


@query("op6_lm_scores")
def op6(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lm.score(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2, new_run_dir(spark, "lm"))


@query("op4_near_duplicates")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return setjoin.components(docs, new_run_dir(spark, "setjoin"))


@query("op11_quality_rules")
def op11(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    judged, _ = rules.judge(docs, labels, new_run_dir(spark, "rules"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


# H as in merkle.row_digest; the checksum of an id's decimal text is folded bit by bit.
_FIELD = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(c) for c in merkle.FIELDS) + ")"
_EVEN_CRC = """list_reduce(flatten(list_transform(string_split(doc_id::varchar, ''),
    lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda a, x: case when x >= 0 then xor(a, x) when a % 2 = 1 then xor(a // 2, 3988292384) else a // 2 end,
    4294967295::bigint) % 2 = 1"""

MERKLE_SQL = f"""
with recursive
rows_ as (
  select doc_id, if(source is null, '', 'x' || source) as s, {_LEAF} as leaf,
         {_LEAF.replace("text::", "came::")} as arrived
  from (select *, if(coalesce({_EVEN_CRC}, false), replace(text, chr(10), ''), text) as came from documents)),
leaves as (
  select *, row_number() over (order by s, doc_id nulls first, leaf) as id,
         row_number() over (partition by s order by doc_id nulls first, leaf) - 1 as pos
  from rows_),
nodes(s, level, pos, hash) as (
  select s, 0, pos, leaf from leaves
  union all
  select s, level + 1, pos // 3, sha256(string_agg(hash, '' order by pos))
  from (select *, count(*) over (partition by s) as n from nodes) where n > 1 group by s, level, pos // 3),
heights as (select s, max(level) as height from nodes group by s),
subroots as (
  select s, hash, row_number() over (order by s) - 1 as place from nodes join heights using (s) where level = height),
tops(level, pos, hash) as (
  select 0, place, hash from subroots
  union all
  select level + 1, pos // 3, sha256(string_agg(hash, '' order by pos))
  from (select *, count(*) over () as n from tops) where n > 1 group by level, pos // 3),
top as (select max(level) as height, max_by(hash, level) as root from tops),
-- Both trees as one: the nodes of a source, then those above all subroots.
runs as (
  select s, level, pos, hash from nodes join heights using (s) where level < height
  union all
  select h.s, h.height + t.level, t.pos, t.hash from heights h, tops t where t.level < (select height from top)),
paths as (
  select l.id, l.s, g.level, if(g.level < height, l.pos // (3 ** g.level)::bigint, place // (3 ** (g.level - height))::bigint) as own
  from leaves l join heights using (s) join subroots using (s),
       (select unnest(range(64)) as level) g
  where g.level < height + (select height from top)),
steps as (
  select p.id, p.level, own, r.pos, r.hash
  from paths p join runs r on r.s = p.s and r.level = p.level and r.pos // 3 = own // 3),
proofs as (
  select id, sha256(string_agg(hash, '' order by level, pos)) as proof_sha256 from steps where pos <> own group by id),
folds(id, level, node) as (
  select id, 0, arrived from leaves
  union all
  select f.id, f.level + 1, sha256(string_agg(if(t.pos = t.own, f.node, t.hash), '' order by t.pos))
  from folds f join steps t on t.id = f.id and t.level = f.level group by f.id, f.level)
select doc_id, leaf, r.hash as subroot, root, coalesce(proof_sha256, sha256('')) as proof_sha256,
       node as folded_root, node = root as verified
from leaves join subroots r using (s) join heights using (s) left join proofs using (id)
join folds f using (id) cross join top
where f.level = heights.height + top.height"""


@query("op12_merkle_manifest", MERKLE_SQL)
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents", *merkle.FIELDS)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    received = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    found = merkle.manifest(docs, new_run_dir(spark, "merkle"), {"text": received})
    return found.select(
        "doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query("op13_whitening")
def op13(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    white = whitening.whiten(rows, whitening.fit(rows))
    return white.withColumn("deviation", F.expr("try_cast(deviation as bigint)"))
