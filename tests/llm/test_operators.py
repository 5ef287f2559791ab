"""Each operator against brute force, on rows with nulls, empties, repeats and clashing names."""

import collections
import hashlib
import os
import random
import re
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import blocks, chat, fmindex, langid, lm, packing, pii, quality, setjoin, topk, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
WORDS = "the of and Ändern haus été niño garden tree 7 x1 river stone".split()


def make_texts(seed=3, n=40):
    rng = random.Random(seed)
    texts = [None, "", "  \n", "one", "one two three", "One two three", "a b c d"]
    for _ in range(n):
        words = [rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(rng.randrange(5, 80))]
        texts.append(" ".join(words))
        for _ in range(rng.randrange(3)):
            copy = list(words)
            copy[rng.randrange(len(copy))] = "edit"
            texts.append(" ".join(copy))
    return [*texts, texts[10], texts[10], " ".join(texts[12:30]) * 3]


@pytest.fixture(scope="module")
def texts():
    return make_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(k, t, "x", k, "en", 5) for k, t in enumerate(texts)] + [(None, "null id", "x", 1, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, row string, result long, lang string, class long").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def test_packing(docs, texts, empty):
    got = packing.pack(docs, TOKENIZER, pool_tokens=500).collect()
    by_doc, by_window = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    from tokenizers import Tokenizer

    encoder = Tokenizer.from_file(TOKENIZER)
    for k, text in enumerate(texts):
        ids = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        pieces = sorted(by_doc[k], key=lambda r: r.start)
        assert b"".join(r.ids for r in pieces) == ids.tobytes()
        assert all(r.doc_tokens == len(ids) for r in pieces)
    for rows in by_window.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == list(np.cumsum([0, *[r.length for r in rows[:-1]]]))
        total = sum(r.length for r in rows)
        assert total == rows[0].sequence_tokens <= 4096 and total & (total - 1) == 0
    assert packing.pack(empty, TOKENIZER).count() == 0


def test_tokens_of_odd_texts():
    from ledgerline.llm.tokens import WordTokenizer

    tokenizer, rng = WordTokenizer(TOKENIZER), random.Random(1)
    signs = [chr(c) for c in range(0x250)] + list("ΣςİẞT̈̇ﬁ日한　 '<|>") + ["<|endoftext|>", "<|ENDOFTEXT|>", "n't"]
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(30)))
        assert tokenizer.encode_all([text])[0] == tokenizer.encode(text)


def test_words_met_again_outlive_a_full_cache(monkeypatch):
    from ledgerline.llm import tokens

    monkeypatch.setattr(tokens, "CACHE_WORDS", 3)
    tokenizer, learned = tokens.WordTokenizer(TOKENIZER), []
    learn = tokenizer.learn
    monkeypatch.setattr(tokenizer, "learn", lambda words: (learned.extend(words), learn(words)))
    for k in range(6):
        text = f"common Words, new{k} other{k} third{k}"
        assert tokenizer.encode_all([text]) == [tokenizer.encode(text)]
    assert learned.count(b"common") == 1 and learned.count(b"words,") == 1 and len(learned) == 2 + 3 * 6
    assert len(tokenizer.known) + len(tokenizer.before) < 20


def test_tokens_of_new_words_together():
    from ledgerline.llm.tokens import WordTokenizer

    tokenizer, rng = WordTokenizer(TOKENIZER), random.Random(2)
    parts = [*"aBé\u0301ΣςİßǅÅ\u212b1²½'_\x00\x01.,!文\u0958\u200d", "\u3000", "\x85", " ", "\t", "'s", "<|endoftext|>", "<|ENDOFTEXT|>", "###"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(9000)]
    for _ in range(2):  # new words, then words from the cache
        assert tokenizer.encode_all([None, *texts]) == [b"", *map(tokenizer.encode, texts)]


def test_chat_round_trip(spark):
    odd = ["\\### Assistant: </turn> ok", "####", "</turn>\n### user: x", "\\", "", None, "a" * 5000, "é\\\\##</"]
    rows = [(1, k, r, t) for k, (r, t) in enumerate(zip(["system", "user", "assistant", "assistant", "we:ird\n", None, "user", "assistant"], odd))]
    rows += [(2, None, "user", "null turn"), (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (None, 0, "assistant", "no id")]
    rows += [(3, k, "assistant" if k % 2 else "user", f"turn {k} " * (k % 9)) for k in range(60)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("window", F.lit(9))
    windows = chat.format_windows(turns, budget=200, history=40)
    by = collections.defaultdict(list)
    for c, t, r, x in rows:
        by[c].append((-1 if t is None else t, r or "", x or ""))
    for r in chat.read_windows(windows).collect():
        want = sorted(by[r.conv_id])
        assert [(t.role, t.text) for t in r.turns] == [(b, c) for _, b, c in want]
        assert r.loss == [c for _, b, c in want if b == "assistant"]
    for w in windows.where("conv_id = 3").collect():
        assert w.n_tokens <= 200
    assert max(w.n_repeated for w in windows.collect()) > 0
    assert windows.where("conv_id = 1 and window > 0 and formatted not like '### system:%'").count() == 0
    assert chat.read_windows(chat.format_windows(turns.limit(0))).count() == 0


@pytest.mark.parametrize("block_words", [fmindex.BLOCK_WORDS, 5])
def test_decontamination(spark, docs, texts, empty, block_words):
    items = [(1, " ".join(texts[12].split()[2:20])), (2, "two THREE"), (3, None), (4, "..."), (None, "one"), (2, "two three"), (10, texts[20])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    find = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    owners = collections.defaultdict(set)
    for item, text in items:
        words = find(text)
        for k in range(max(1, len(words) - 9) if words else 0):
            owners[tuple(words[k : k + 10])].add(item)
    found = fmindex.decontaminate(docs, bench, block_words=block_words)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    for r in found.collect():
        words, hit, found = find(r.row.text), set(), set()
        for w, own in owners.items():
            for k in range(len(words) - len(w) + 1):
                if tuple(words[k : k + len(w)]) == w:
                    hit.update(range(k, k + len(w)))
                    found |= own - {None}
        assert (r.result.n_words, r.result.n_hit, r.result["items"]) == (len(words), len(hit), sorted(found, key=str))
        inside = " ".join(r.row.text[s.start : s.end] for s in r.result.spans)
        assert len(find(inside)) == len(hit)
    assert fmindex.decontaminate(empty, bench).count() == 0
    assert fmindex.decontaminate(docs, bench.limit(0)).where("result.n_hit > 0").count() == 0


def test_suffix_order_of_repeats():
    rng = np.random.default_rng(0)
    for text in (rng.integers(0, 3, 300), np.zeros(50, dtype=np.int64), np.tile([1, 2, 3], 40)):
        want = sorted(range(len(text)), key=lambda k: text[k:].tolist())
        assert fmindex.suffix_array(text.astype(np.int64)).tolist() == want


def components(sets, links):
    root = {k: k for k in sets}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in sets:
        for b in sets:
            if a < b and links(sets[a], sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in sets}


def test_near_copies_make_few_pairs(spark, run_dir):
    """A group of near copies costs a few pairs per member, not all its pairs, and is one component."""
    rng = random.Random(12)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(700):
        words = list(base)
        words[rng.randrange(120)] = f"own{k}"
        texts.append(" ".join(words))
    texts += [" ".join(f"x{rng.randrange(10**6)}" for _ in range(60)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = setjoin.components(docs, run_dir).collect()
    assert {r.component_id for r in got if r.doc_id < 700} == {0}
    assert all(r.component_id == r.doc_id for r in got if r.doc_id >= 700)
    tables = [f.name for f in os.scandir(run_dir) if f.name.endswith("-scanned")]
    pairs = sum(spark.read.schema(setjoin.LINKS).parquet(f"{run_dir}/{t}").count() for t in tables)
    assert 699 <= pairs <= 3 * 700


@pytest.mark.parametrize("rounds, partners", [(setjoin.ROUNDS, 8), ((1, 2, None), 0), ((1, None), 0)])
def test_near_duplicates(docs, texts, empty, run_dir, monkeypatch, rounds, partners):
    monkeypatch.setattr(setjoin, "ROUNDS", rounds)
    monkeypatch.setattr(setjoin, "MEAN_PARTNERS", partners)
    sets = {}
    for k, t in enumerate(texts):
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[k] = {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()
    want = components(sets, lambda a, b: bool(a and b) and 100 * len(a & b) >= 85 * len(a | b))
    got = {r.doc_id: r for r in setjoin.components(docs, run_dir).collect()}
    assert {k: (got[k].n_shingles, got[k].component_id) for k in sets} == {k: (len(sets[k]), want[k]) for k in sets}
    assert len(set(want.values())) < len(sets) and got[None].component_id is None
    assert setjoin.components(empty, run_dir + "e").count() == 0


@pytest.mark.parametrize("shingle, num", [(4, 85), (5, 80)])
def test_near_duplicates_of_short_texts(spark, run_dir, shingle, num):
    rng = random.Random(7)
    rows = []
    for n in [*range(6, 21)] * 4:
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        rows += [words, rng.choice([[*words, "end"], ["start", *words], words[:-1], words[1:]])]
    sets = {k: {tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))} for k, w in enumerate(rows)}
    sizes = collections.Counter(map(len, sets.values()))
    assert setjoin.small_boundary(sizes, setjoin.Threshold(num)) >= 8  # the smaller ones are in no list
    want = components(sets, lambda a, b: 100 * len(a & b) >= num * len(a | b))
    docs = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(rows)], "doc_id long, text string").repartition(3)
    got = setjoin.components(docs, run_dir, shingle=shingle, rule=setjoin.Threshold(num)).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def test_archives(spark, run_dir):
    long = "é" * 900
    rows = [(1, "http://a b/ü\r\n", long), (2, None, long), (9, "u", long), (3, "u", None), (4, "u", "short"), (5, "u", "short"), (None, "u", long)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("data", F.lit(1))
    chunks = warc.round_trip(pages, run_dir, chunk_bytes=7).collect()
    by = collections.defaultdict(list)
    for r in chunks:
        by[r.record_id].append(r)
    for page, url, html in rows:
        parts = sorted(by[None if page is None else str(page)], key=lambda r: r.chunk_no)
        payload = (html or "").encode()
        revisits = html == long and page != 9
        assert {(r.record_type, r.refers_to, r.url) for r in parts} == {("revisit" if revisits else "response", "9" if revisits else None, url)}
        assert parts[-1].is_last and parts[-1].payload_digest == hashlib.sha1(payload).hexdigest()
        if not revisits:
            assert b"".join(r.data for r in parts) == payload and max(len(r.data) for r in parts) <= 7
            assert parts[-1].digest_so_far == parts[-1].payload_digest
    assert warc.round_trip(pages.limit(0), run_dir + "e").count() == 0


def test_language_model(docs, texts, empty, run_dir):
    held = F.col("doc_id") % 5 == 0
    got = {r.doc_id: r for r in lm.score(docs, held, run_dir + "a").collect()}
    parts = {r.doc_id: r for r in lm.score(docs, held, run_dir + "b", broadcast_bytes=1).collect()}
    assert got == parts
    tokens = {k: [*(t or "").lower().split(), None] for k, t in enumerate(texts)}
    tokens[None] = ["null", "id", None]
    count = collections.Counter(w for k, row in tokens.items() if k is None or k % 5 for w in row)
    n, v = sum(count.values()), len(count)
    for k, row in tokens.items():
        base = sum(np.log10((count[w] + 1) / (n + v + 1)) for w in row)
        assert (got[k].n_tokens, got[k].n_known, got[k].train_tokens) == (len(row), sum(count[w] > 0 for w in row), n)
        assert got[k].base_score == pytest.approx(base) and got[k].score < 0
    assert lm.score(empty, held, run_dir + "e").count() == 0


def test_large_language_model_stays_in_its_shards(spark, docs, run_dir, monkeypatch):
    held = F.col("doc_id") % 5 == 0
    monkeypatch.setattr(lm, "SHARD_TOKENS", 40, raising=False)
    monkeypatch.setattr(lm, "BLOCK_BYTES", 300)
    want = {r.doc_id: r for r in lm.score(docs, held, run_dir + "a").collect()}
    sent = []
    monkeypatch.setattr(spark.sparkContext, "broadcast", lambda value: sent.append(value))
    got = {r.doc_id: r for r in lm.score(docs, held, run_dir + "b", broadcast_bytes=1).collect()}
    assert got == want and not sent
    # Texts without training texts beside them find no model at all.
    none = lm.score(docs, F.lit(True), run_dir + "c", broadcast_bytes=-1).collect()
    assert len(none) == len(docs.collect()) and {(r.n_known, r.train_tokens, r.base_score) for r in none} == {(0, 0, 0.0)}


def test_memory_of_the_language_model_is_bounded():
    """What a worker holds of a partition, block by block and shard by shard."""
    texts = [" ".join(f"w{k}" for k in range(at, at + 500)) for at in range(0, 1_200_000, 500)]
    full = pa.table({"id": range(len(texts)), "held": [False] * len(texts), "text": texts})
    types = {"tokens": pa.binary(), "keys": pa.binary()}

    def peak(fn, batches, size):
        tracemalloc.start()
        for got in fn(blocks.blocks(iter(batches), size)):
            yield pa.table({k: pa.array(v, type=types.get(k)) for k, v in got.items()})
        peaks.append(tracemalloc.get_traced_memory()[1] / 1e6)
        tracemalloc.stop()

    peaks = []
    made = [b for t in peak(lm._tokenize, full.to_batches(500), lm.BLOCK_BYTES) for b in t.to_batches()]
    counted = [b for t in peak(lm._count(64), made, 1) for b in t.to_batches()]
    assert sum(len(np.unique(np.frombuffer(x, np.uint64))) for b in counted for x in b.column("words").to_pylist()) == 1_200_001
    assert peaks[0] < 110 and peaks[1] < 80, peaks


def test_bigrams_seen_once_count(spark, run_dir):
    train = [t for k in range(20) for t in (f"h{k} x{k}", f"h{k} x{k}", f"g{k} y{k}", f"g{k} z{k}")]
    held = [t for k in range(20) for t in (f"g{k} y{k}", f"g{k} y{(k + 1) % 20}")]
    rows = [(k, t, False) for k, t in enumerate(train)] + [(1000 + k, t, True) for k, t in enumerate(held)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held boolean")
    got = {r.doc_id: r.score for r in lm.score(docs, F.col("held"), run_dir).collect()}
    # Same words, but the first pair of each two was seen once and the second never.
    assert sum(got[1000 + k] > got[1001 + k] + 0.5 for k in range(0, 40, 2)) >= 18


def test_filter_never_misses():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(1, 2**63, 5000).astype(np.uint64))
    levels = rng.integers(1, 12, len(keys))
    row = {"shard": 0, "words": b"", "word_counts": b"", "filter": lm.make_filter(keys, levels).tobytes()}
    part = lm.ModelPart([row], 1)
    assert (part.probe(keys) >= levels).all() and (part.probe(keys) == levels).mean() > 0.95
    assert (part.probe(rng.integers(1, 2**63, 5000).astype(np.uint64)) > 0).mean() < 0.03


def test_quality(spark, empty, run_dir):
    rng = random.Random(5)
    rows, labels = [], []
    for k in range(400):
        words = [rng.choice(WORDS) for _ in range(30)]
        toxic = k % 4 == 0
        junk = k % 7 == 0
        text = " ".join(words + (["awful", "nasty"] if toxic else []))
        rows.append((k, text.upper().replace(" ", "!! ") if junk else text, f"host{k % 3}"))
        labels.append((k, 0 if junk else 1, int(toxic)))
    docs = spark.createDataFrame([*rows, (None, None, None), (900, "", "rare")], "doc_id long, text string, source string")
    marks = spark.createDataFrame([*labels, (None, 1, 1), (1, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, marks)
    score = lambda d, at: quality.score(d, model, F.col("source"), F.col("source"), at)
    got = {r.doc_id: r for r in score(docs, run_dir).collect()}
    assert len(got) == 402
    wrong = [k for k, q, t in labels if got[k].keep != (q == 1 and t == 0)]
    assert len(wrong) < 12
    assert score(empty, run_dir + "e").count() == 0
    # Labels without a document take no place in the sample.
    gone = [(1000 * j + k, q, t) for j in range(10, 30) for k, q, t in labels]
    few = quality.fit(docs, marks, per_class=30)
    assert np.allclose(few.weights, quality.fit(docs, marks.union(spark.createDataFrame(gone, marks.schema)), per_class=30).weights)
    assert quality.score(docs, quality.fit(docs, marks.limit(0)), F.col("source"), F.col("source"), run_dir + "n").count() == 402


def test_top_k(spark, run_dir):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(300, 8)) / 3
    vectors[50:120] = vectors[50]
    rows = [(k, v.tolist()) for k, v in enumerate(vectors)] + [(7, vectors[7].tolist()), (900, None), (901, [float("nan")] * 8), (902, [None] * 8), (None, [1.0] * 8), (950, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df, F.col("id") % 50 == 0, run_dir).collect()}
    whole = np.floor(256 * vectors.astype(np.float32).astype(float)).astype(int)
    want = {}
    for q in range(0, 300, 50):
        score = whole @ whole[q]
        best = [k for k in np.lexsort((np.arange(300), -score)) if k != q][:5]
        want |= {(q, r + 1): (k, score[k]) for r, k in enumerate(best)}
    assert got == want
    assert topk.top_k(df.limit(0), F.col("id") % 50 == 0, run_dir + "e").count() == 0


def test_top_k_of_repeated_ids(spark, run_dir):
    rng = np.random.default_rng(3)
    vectors = rng.normal(size=(400, 8)) / 3
    ids = np.r_[np.arange(300), np.repeat([300, 301], 20), rng.integers(0, 300, 60)]
    for k in range(300, 340):
        vectors[k] = vectors[50 * (k % 6)] * rng.uniform(3, 4)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], "vec_id long, embedding array<float>")
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in topk.top_k(df.coalesce(1), F.col("id") % 50 == 0, run_dir).collect()}
    whole = np.floor(256 * vectors.astype(np.float32).astype(float)).astype(int)
    want = {}
    for q in range(0, 301, 50):
        score = (whole @ whole[ids == q].T).max(axis=1)
        best = sorted((-score[ids == i].max(), i) for i in set(ids.tolist()) - {q})[:5]
        want |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(best)}
    assert got == want


def _best(ids, vectors, query_id, query, k):
    scores = {}
    for vec_id, score in zip(ids.tolist(), (vectors @ query).tolist(), strict=True):
        if vec_id != query_id:
            scores[vec_id] = max(score, scores.get(vec_id, score))
    return sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:k]


@pytest.mark.parametrize("dense", [32, 0], ids=["products", "lists"])
@pytest.mark.parametrize(
    ("n", "dims", "top", "filled"),
    [(1, 3, 5, 1), (7, 5, 3, 1), (300, 9, 2, 1), (400, 70, 4000, 1), (400, 40, 90, 0.05), (200, 20, 1, 0.3), (300, 3, 2**27, 1), (50, 4, 9, 0)],
)
def test_top_k_blocks_equal_brute_force(monkeypatch, n, dims, top, filled, dense):
    monkeypatch.setattr(topk, "DENSE", dense)
    rng = np.random.default_rng(n + dims)
    vectors = rng.integers(-top, top + 1, (n, dims)) * (rng.random((n, dims)) < filled)
    for ids in (np.arange(n), rng.integers(0, n // 2 + 1, n)):
        q, found, score, share = topk.search_block(topk.build_block(ids, vectors, 5), ids[:70], vectors[:70], 5)
        for k in range(len(ids[:70])):
            assert list(zip(found[q == k].tolist(), score[q == k].tolist(), strict=True)) == _best(ids, vectors, ids[k], vectors[k], 5)
        assert ((share >= 0) & (share <= 1)).all()


def test_top_k_stops_by_proof_where_neighbours_are_close():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(200, 32))
    vectors = np.repeat(centres, 10, axis=0) + rng.normal(scale=0.05, size=(2000, 32))
    vectors = np.floor(256 * vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.int64)
    ids = np.arange(2000)
    q, found, score, share = topk.search_block(topk.build_block(ids, vectors, 5), ids[::20], vectors[::20], 5)
    assert share.mean() < 0.6
    for k, at in enumerate(ids[::20]):
        assert list(zip(found[q == k].tolist(), score[q == k].tolist(), strict=True)) == _best(ids, vectors, at, vectors[at], 5)


def test_language(spark, empty):
    rows = [(k, f"{w} garden stone tree {w}", "en") for k, w in enumerate("the of and with".split())]
    rows += [(k + 10, f"{w} straße größe und {w}", "de") for k, w in enumerate("der die das ist".split())]
    docs = spark.createDataFrame([*rows, (20, None, "en"), (21, "123 !?", None), (22, "Ω", None)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = {r.row.doc_id: r.result for r in langid.identify(docs, model).collect()}
    assert all(got[k].lang_pred == lang and got[k].score > 0.5 for k, _, lang in rows)
    assert got[20].lang_pred == got[21].lang_pred == "und" and got[22].lang_pred in ("de", "en") and got[22].score == 0
    nothing = langid.train(empty)
    assert {r.result.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_pipeline_keeps_a_rare_language(spark, run_dir):
    rows = [(k, f"{w} garden stone tree {w} and the river", "en") for k, w in enumerate("the of and with".split() * 10)]
    docs = spark.createDataFrame([*rows, (100, "hyvää päivää, kuinka voit", "fi")], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.lang for r in corpus_pipeline.language(spark, docs, run_dir).collect()}
    assert kept == {k: lang for k, _, lang in rows} | {100: "fi"}


def test_pipeline_without_languages_keeps_all(spark, docs):
    unnamed = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.language(spark, unnamed, "")
    assert kept.columns == unnamed.columns and kept.count() == unnamed.count()


def test_strict_spans_equal_the_patterns():
    rng = random.Random(4)
    signs = list("ab1@.-+ ()%") + ["@x.y", "1.2.3.4", "+1 (202) 555-0100", "4111 1111 1111 1111", "256.1.1.1", "é"]
    email, card = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]([\x20-]?[0-9])+"
    ip, phone = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"\+[0-9][\x20().0-9-]+[0-9]"
    digits = lambda s: re.sub("[^0-9]", "", s)
    checks = {
        "email": (email, lambda s: True),
        "ip": (ip, lambda s: all(int(p) <= 255 for p in s.split("."))),
        "card": (card, lambda s: 16 <= len(digits(s)) <= 19 and pii.luhn(digits(s))),
        "phone": (phone, lambda s: 8 <= len(digits(s)) <= 15),
    }
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(25)))
        want = [(k, *m.span()) for k, (p, ok) in checks.items() for m in re.finditer(p, text) if ok(m.group())]
        assert pii.strict_spans(text) == want


def test_pii_model(spark, docs, empty):
    rows = [(k, f"mail me at a{k}@x.com or call (202) 555-01{k:02d}, order no 123-456-7890") for k in range(20)]
    found = spark.createDataFrame([*rows, (50, None), (51, "")], "doc_id long, text string")
    got = {r.row.doc_id: r.result.spans for r in pii.find(found, pii.train(found)).collect()}
    assert all(s[0].kind == "email" and s[0].strict for k, s in got.items() if k < 50) and got[50] == got[51] == []
    masked = {r.row.doc_id: r.result.text for r in pii.redact(found, pii.train(found)).collect()}
    assert masked[50] is None and masked[51] == "" and "@" not in masked[3]
    assert pii.find(empty, pii.train(empty)).count() == 0


def test_pipeline_near_copies(spark, run_dir):
    rng = random.Random(9)
    texts = []
    for n, edits in [(94, (20, 60)), (94, (20, 40, 60)), (50, (25,)), (40, (20,)), (8, ())]:
        words = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        copy = [f"edit{k}" if k in edits else w for k, w in enumerate(words)]
        texts += [" ".join(words), " ".join(copy if edits else [*copy, "end"])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    # 80 of 100, 75 of 105, 41 of 51, 31 of 41 and 4 of 5 shingles of five words
    assert sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, run_dir).collect()) == [0, 2, 3, 4, 6, 7, 8]


def test_pipeline_keeps_clean_documents(spark, run_dir):
    rng = random.Random(8)
    word = lambda: rng.choice("ka lo mi ter san dor vel".split()) + rng.choice("na po rit ul em".split())
    clean = [" ".join(word() for _ in range(60)) for _ in range(12)]
    item = " ".join(word() for _ in range(20))
    copy = clean[0].split()
    copy[3] = "other"
    texts = [*clean, clean[1], " ".join(copy), f"{clean[2]} more {item} end", "123 456", None, " ".join(word() for _ in range(40)) + " a1@mail.com today"]
    rows = [(k, t, "en", "src", len(t or "")) for k, t in enumerate(texts)] + [(5, clean[5], "en", "src", len(clean[5]))]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{run_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{run_dir}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{run_dir}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, run_dir).write.parquet(f"{run_dir}/{k}")
        docs = spark.read.parquet(f"{run_dir}/{k}")
        kept[name] = docs
        if k < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {14, 15, 16} & {r.doc_id for r in kept["language ID"].collect()} == {14}
    ids = [r.doc_id for r in kept["n-gram Jaccard join"].collect()]
    assert sorted(ids) == [*range(12), 14, 17]
    cut = {r.doc_id: r.text for r in kept["benchmark decontamination"].collect()}
    assert item not in cut[14] and cut[14].startswith(clean[2]) and cut[4] == clean[4]
    masked = {r.doc_id: r.text for r in kept["PII"].collect()}
    assert "a1@mail.com" not in masked[17] and "<email>" in masked[17]
    assert {r.doc_id for r in kept["packing"].collect()} == set(masked)


@pytest.mark.parametrize("module, most_mb", [(setjoin, 65), (langid, 55)])
def test_memory_beside_a_block_of_texts_is_bounded(spark, run_dir, monkeypatch, module, most_mb):
    """What a worker makes of a partition of texts: a few workers fit beside an executor's heap."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(10**6)}" for _ in range(20_000)]
    texts = [" ".join(rng.choices(words, k=500)) for _ in range(4_000)]
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(texts[:20])], "doc_id long, text string, lang string")
    seen, plain = [], module.task_rows
    monkeypatch.setattr(module, "task_rows", lambda df, s, fn, size=blocks.BLOCK_BYTES: seen.append((df.columns, fn, size)) or plain(df, s, fn, size))
    if module is setjoin:
        setjoin.components(docs, run_dir).count()
    else:
        model, mapped = langid.train(docs), langid.map_rows
        monkeypatch.setattr(langid, "map_rows", lambda df, i, r, fn, out, block_bytes: seen.append((["text"], lambda parts: (fn({"text": p.column("text").to_pylist()}) for p in parts), block_bytes)) or mapped(df, i, r, fn, out, block_bytes=block_bytes))
        langid.identify(docs, model).count()
    full = {"doc_id": range(len(texts)), "text": texts, "lang": ["en"] * len(texts), "class": [0] * len(texts)}
    reads = [(c, fn, size) for c, fn, size in seen if "text" in c]
    assert len(reads) >= 2
    peaks = []
    for columns, fn, size in reads:
        batches = pa.table({c: full[c] for c in columns}).to_batches(500)
        tracemalloc.start()
        for _ in fn(blocks.blocks(iter(batches), size)):
            pass
        peak = tracemalloc.get_traced_memory()[1] / 1e6
        tracemalloc.stop()
        peaks.append(peak)
    assert max(peaks) < most_mb, peaks


def test_words_of_the_tokenizer_do_not_outlive_its_job(spark):
    docs = spark.createDataFrame([(k, f"one two word{k}") for k in range(40)], "doc_id long, text string").repartition(4)
    assert packing.pack(docs, TOKENIZER).count() >= 40

    def made(batches):
        import gc

        list(batches)
        n = sum(type(x).__name__ == "WordTokenizer" for x in gc.get_objects())
        yield pa.RecordBatch.from_pydict({"n": [n]})

    counts = [r.n for r in docs.mapInArrow(made, "n long").collect()]
    assert counts == [0] * 4
