"""Language-model scores from a log-frequency Bloom filter.

Unigrams and bigrams are counted over all training texts. An n-gram of count c has the quantised
level 1 + floor(log2 c) and is put into the filter once for each level up to its own; its level is
read back by probing levels 1, 2, ... until one is missing. A Bloom filter never misses, so a level
is exact or, rarely, too high.

The model is made in shards by n-gram hash, of a few million tokens each: a task counts what it reads,
a shard adds that up and makes its own part of the filter, sized by what it holds. Beside the filter the
shards carry exact word counts for the add-one base. A model of at most ``BROADCAST_BYTES`` goes to the
workers as one broadcast. A larger one stays where it is: each block of texts sends its distinct n-grams
to their shards and gets the levels back, so that a worker holds one shard or one block at a time,
however large the model.

Probability of a word w after v: weight(v) * count(v w) / count(v) + (1 - weight(v)) * (count(w) + 1)
/ (N + V + 1), with counts as read from the filter. The weight depends on the level of v and comes
from deleted interpolation over all training tokens: each votes for the order that predicts it better
once its own occurrence is taken out.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import quoted, task_rows
from ledgerline.session import settings

BLOCK_BYTES = 2 << 20
BROADCAST_BYTES = 192 << 20
ROWS_BYTES = 2 << 20  # of small rows that a worker takes or gives at once
SHARD_TOKENS = 5_000_000
MIN_SHARDS = 32
TASK_BLOCKS = 8  # that meet their answers in a task, on average
PROBED = 1 << 18  # n-grams looked up or stored together
FILTER_BITS = 10  # per stored (n-gram, level)
FILTER_HASHES = 5
LEVELS = 64
CACHE_WORDS = 400_000  # some 60 MB
HELD = 4_000_000
END = np.uint64(0x5851F42D4C957F2D)
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_known: dict[bytes, int] = {}

BLOCKS = "block bigint, ids array<{id}>, held array<boolean>, sizes array<bigint>, tokens binary, keys binary"
COUNTS = "shard int, words binary, word_counts binary, pairs binary, pair_counts binary"
MODEL = "shard int, words binary, word_counts binary, filter binary, tokens bigint, bytes bigint"
ASKED = "shard int, block bigint, words binary, pairs binary"
ANSWERS = "block bigint, shard int, count binary, single binary, pair binary"
SCORED = "ids array<{id}>, held array<boolean>, sizes array<bigint>, base array<double>, known array<bigint>, single binary, pair binary"

NOTHING = {"shard": 0, "words": b"", "word_counts": b"", "filter": b""}

# Rows of a block are megabytes, and a Parquet writer by default looks at its memory after 100 rows only.
WRITING = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1, "compression": "zstd"}
JOBS = {
    # The JVM holds a batch several times, outside its heap.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # What a job has shuffled goes when it has written its table, not when the driver happens to collect garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def word_keys(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, each text closed by END, and the number of tokens of each."""
    rows, sizes = [], []
    end = int(END)
    for text in texts:
        if len(_known) > CACHE_WORDS:
            _known.clear()
        words = (text or "").encode().lower().split()
        row = list(map(_known.get, words))
        if None in row:
            for k, w in enumerate(words):
                if row[k] is None:
                    row[k] = _known[w] = xxhash.xxh3_64_intdigest(w)
        row.append(end)
        rows.append(np.array(row, dtype=np.uint64))
        sizes.append(len(row))
    return np.concatenate(rows), np.array(sizes, dtype=np.int64)


def pair_keys(tokens: np.ndarray) -> np.ndarray:
    """Hash of each token with the one before it; END stands before a text."""
    before = np.empty_like(tokens)
    before[0], before[1:] = END, tokens[:-1]
    mixed = (before * _MIX[0] ^ before >> np.uint64(32)) + tokens * _MIX[1]
    mixed ^= mixed >> np.uint64(31)
    return mixed * _MIX[2] ^ mixed >> np.uint64(27)


def added(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their counts added up."""
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    del order
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.zeros(0, dtype=np.int64)
    return keys[first], np.add.reduceat(counts, first, dtype=np.int64) if len(first) else counts.astype(np.int64)


class Cut:
    """Sorted keys by shard: the highest bits of a key name its shard."""

    def __init__(self, shards: int):
        self.shift = 64 - (shards.bit_length() - 1)
        self.starts = np.arange(1, shards, dtype=np.uint64) << np.uint64(self.shift % 64)

    def edges(self, keys: np.ndarray) -> list[int]:
        """Where each shard begins, and the end."""
        return [0, *np.searchsorted(keys, self.starts).tolist(), len(keys)]

    def shard(self, key: int) -> int:
        return key >> self.shift


def levels_of(counts: np.ndarray) -> np.ndarray:
    """1 + floor(log2 c) for counts from 1, 0 for 0."""
    return np.frexp(counts.astype(np.float64))[1].astype(np.int64)


def count_at(level: np.ndarray) -> np.ndarray:
    """The count a level stands for: the geometric middle of its range; 1 is exact."""
    level = level.astype(np.float64)
    return np.where(level <= 1, level, 2.0 ** (level - 0.5))


def _hashed(keys: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and step from which the filter positions of (n-gram, level) follow."""
    mixed = (keys ^ np.uint64(level * int(_MIX[1]) % 2**64)) * _MIX[0]
    mixed ^= mixed >> np.uint64(29)
    return mixed, mixed * _MIX[2] | np.uint64(1)


def _position(start: np.ndarray, step: np.ndarray, which: int, bits: np.ndarray) -> np.ndarray:
    return ((start + step * np.uint64(which) >> np.uint64(32)) * bits >> np.uint64(32)).astype(np.int64)


def make_filter(keys: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Bytes of a filter that holds each key at all levels up to its own."""
    stored = int(levels.sum())
    size = max(8, -(-stored * FILTER_BITS // 8))
    cells = np.zeros(size * 8, dtype=bool)
    bits = np.uint64(size * 8)
    for at in range(0, len(keys), PROBED):
        part, high = keys[at : at + PROBED], levels[at : at + PROBED]
        for level in range(1, int(high.max()) + 1):
            start, step = _hashed(part[high >= level], level)
            for which in range(FILTER_HASHES):
                cells[_position(start, step, which, bits)] = True
    return np.packbits(cells, bitorder="little")


class ModelPart:
    """Some shards of the model: sorted words with exact counts, and the shards' filters."""

    def __init__(self, rows: list[dict], shards: int):
        self.shift = np.uint64(64 - (shards.bit_length() - 1)) if shards > 1 else None
        self.words = np.concatenate([np.frombuffer(r["words"], dtype=np.uint64) for r in rows])
        self.counts = np.concatenate([np.frombuffer(r["word_counts"], dtype=np.int64) for r in rows])
        self.cells = np.concatenate([np.frombuffer(r["filter"], dtype=np.uint8) for r in rows])
        self.first = np.zeros(shards, dtype=np.int64)
        self.bits = np.zeros(shards, dtype=np.uint64)
        at = 0
        for r in rows:
            self.first[r["shard"]], self.bits[r["shard"]] = at * 8, len(r["filter"]) * 8
            at += len(r["filter"])

    def shard(self, keys: np.ndarray) -> np.ndarray:
        return np.zeros(len(keys), np.int64) if self.shift is None else (keys >> self.shift).astype(np.int64)

    def exact(self, keys: np.ndarray) -> np.ndarray:
        """Counts of words; 0 for those unknown or held by other parts."""
        if not len(self.words):
            return np.zeros(len(keys), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.words, keys), len(self.words) - 1)
        return np.where(self.words[at] == keys, self.counts[at], 0)

    def probe(self, keys: np.ndarray) -> np.ndarray:
        """Levels of n-grams, by probing one level after the other; 0 for those held by other parts."""
        found = np.zeros(len(keys), dtype=np.uint8)
        for at in range(0, len(keys), PROBED):
            found[at : at + PROBED] = self._probe(keys[at : at + PROBED])
        return found

    def _probe(self, keys: np.ndarray) -> np.ndarray:
        shard, held = self.shard(keys), np.flatnonzero(self.bits)
        found, live = np.zeros(len(keys), dtype=np.uint8), np.flatnonzero(self.bits[shard])
        keys, shard = keys[live], shard[live]
        for level in range(1, LEVELS + 1):
            start, step = _hashed(keys, level)
            member = np.arange(len(live))
            # Each position is checked only where all before it were set.
            for which in range(FILTER_HASHES):
                own = held if len(held) == 1 else shard[member]
                at = _position(start[member], step[member], which, self.bits[own]) + self.first[own]
                member = member[(self.cells[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)]
            live, keys, shard = live[member], keys[member], shard[member]
            if not len(live):
                break
            found[live] = level
        return found


def _tokenize(parts):
    task = TaskContext.get()
    first = task.partitionId() << 32 if task else 0
    for k, part in enumerate(parts):
        tokens, sizes = word_keys(part.column("text").to_pylist())
        keys, index = np.unique(tokens, return_inverse=True)
        yield {
            "block": [first + k],
            "ids": [part.column("id").to_pylist()],
            "held": [part.column("held").to_pylist()],
            "sizes": [sizes],
            "tokens": [index.astype("<u4").tobytes()],
            "keys": [keys.tobytes()],
        }
    _known.clear()  # the worker goes on to hold a part of the model


def _rows(parts):
    """Rows of tables, as dictionaries."""
    for part in parts:
        yield from part.to_pylist()


def _tokens(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, each token's word, its hash, and whether it is in a training text."""
    keys = np.frombuffer(row["keys"], dtype=np.uint64)
    index = np.frombuffer(row["tokens"], dtype="<u4")
    train = np.repeat(~np.array(row["held"], dtype=bool), np.array(row["sizes"], dtype=np.int64))
    return keys, index, keys[index], train


def _in_batches(rows, names: list[str]):
    """Rows as columns, some megabytes at a time."""
    out, size = [], 0
    for row in rows:
        out.append(row)
        size += sum(len(v) for v in row if isinstance(v, bytes))
        if size >= ROWS_BYTES:
            yield {n: list(v) for n, v in zip(names, zip(*out, strict=True), strict=True)}
            out, size = [], 0
    if out:
        yield {n: list(v) for n, v in zip(names, zip(*out, strict=True), strict=True)}


def _count(shards: int):
    """Counts per task, one row for each shard whenever ``HELD`` n-grams have been gathered."""
    cut = Cut(shards)

    def drain(held):
        for shard in range(shards):
            row = [shard]
            for kind in held:
                cuts = [(keys[e[shard] : e[shard + 1]], counts[e[shard] : e[shard + 1]]) for keys, counts, e in kind]
                keys, counts = added([k for k, _ in cuts], [c for _, c in cuts])
                row += [keys.tobytes(), counts.astype("<u4").tobytes()]
            if row[1] or row[3]:
                yield row

    def run(parts):
        held, size = ([], []), 0
        names = ["shard", "words", "word_counts", "pairs", "pair_counts"]
        for row in _rows(parts):
            keys, index, tokens, train = _tokens(row)
            if not train.any():
                continue
            counts = np.bincount(index[train], minlength=len(keys))
            words, counts = keys[counts > 0], counts[counts > 0].astype("<u4")
            held[0].append((words, counts, cut.edges(words)))
            pairs, counts = np.unique(pair_keys(tokens)[train], return_counts=True)
            held[1].append((pairs, counts.astype("<u4"), cut.edges(pairs)))
            size += len(pairs) + len(words)
            if size > HELD:
                yield from _in_batches(drain(held), names)
                held, size = ([], []), 0
        if size:
            yield from _in_batches(drain(held), names)

    return run


def _make_shards(parts):
    """A shard's part of the model from all its counts; rows come ordered by shard."""

    def sums(rows, keys, counts):
        # Each row's bytes go once they are in the array of all.
        return added([np.frombuffer(r.pop(keys), np.uint64) for r in rows], [np.frombuffer(r.pop(counts), "<u4") for r in rows])

    def finish(shard, rows):
        words, word_counts = sums(rows, "words", "word_counts")
        pairs, pair_counts = sums(rows, "pairs", "pair_counts")
        levels = np.concatenate([levels_of(c).astype(np.uint8) for c in (word_counts, pair_counts)])
        del pair_counts
        keys = np.concatenate([words, pairs])
        del pairs
        cells = make_filter(keys, levels)
        row = (shard, words.tobytes(), word_counts.tobytes(), cells.tobytes(), int(word_counts.sum()), 16 * len(words) + len(cells))
        return {n: [v] for n, v in zip(("shard", "words", "word_counts", "filter", "tokens", "bytes"), row, strict=True)}

    held, shard = [], None
    for row in _rows(parts):
        if row["shard"] != shard and held:
            yield finish(shard, held)
            held = []
        shard = row["shard"]
        held.append(row)
    if held:
        yield finish(shard, held)


def _found(row: dict, index: np.ndarray, unseen: int, count: np.ndarray, single: np.ndarray, pair: np.ndarray) -> dict[str, list]:
    """A block with what the model knows of its words (``count``, ``single``) and of its tokens' pairs."""
    at = np.cumsum([0, *row["sizes"][:-1]])
    log = np.log10(count + 1.0) - np.log10(unseen)
    return {
        "ids": [row["ids"]],
        "held": [row["held"]],
        "sizes": [row["sizes"]],
        "base": [np.add.reduceat(log[index], at)],
        "known": [np.add.reduceat((count > 0).astype(np.int64)[index], at)],
        "single": [single[index].tobytes()],
        "pair": [pair.tobytes()],
    }


def _probe(shared, unseen: int):
    """What a broadcast model knows of each block's words and tokens."""

    def run(parts):
        for row in _rows(parts):
            part = shared.value
            keys, index, tokens, _ = _tokens(row)
            yield _found(row, index, unseen, part.exact(keys), part.probe(keys), part.probe(pair_keys(tokens)))

    return run


def _ask(shards: int):
    """Distinct words and pairs of each block, one row for each shard."""
    cut = Cut(shards)

    def run(parts):
        for row in _rows(parts):
            words, _, tokens, _ = _tokens(row)
            pairs = np.sort(pair_keys(tokens))
            pairs = pairs[np.r_[True, pairs[1:] != pairs[:-1]]]
            by_word, by_pair = cut.edges(words), cut.edges(pairs)
            rows = ((s, row["block"], words[by_word[s] : by_word[s + 1]].tobytes(), pairs[by_pair[s] : by_pair[s + 1]].tobytes()) for s in range(shards))
            yield from _in_batches((r for r in rows if r[2] or r[3]), ["shard", "block", "words", "pairs"])

    return run


def _answer(shards: int):
    """What a shard knows of the n-grams asked for; its own row, if it has one, comes before them."""

    def looked_up(part, asked):
        sizes = {kind: np.cumsum([len(r[kind]) // 8 for r in asked])[:-1] for kind in ("words", "pairs")}
        words, pairs = (np.frombuffer(b"".join(r[kind] for r in asked), np.uint64) for kind in sizes)
        count, single = np.split(part.exact(words), sizes["words"]), np.split(part.probe(words), sizes["words"])
        for r, c, s, p in zip(asked, count, single, np.split(part.probe(pairs), sizes["pairs"]), strict=True):
            yield r["block"], r["shard"], c.tobytes(), s.tobytes(), p.tobytes()

    def answers(parts):
        part, shard, asked, size = None, None, [], 0
        for row in _rows(parts):
            own = row["block"] is None
            # Many rows are looked up together, as each alone has only some thousand n-grams.
            if asked and (own or row["shard"] != shard or size >= 8 * PROBED):
                yield from looked_up(part, asked)
                asked, size = [], 0
            if own or row["shard"] != shard:
                shard = row["shard"]
                part = ModelPart([row if own else {**NOTHING, "shard": shard}], shards)
            if not own:
                asked.append(row)
                size += len(row["words"]) + len(row["pairs"])
        if asked:
            yield from looked_up(part, asked)

    return lambda parts: _in_batches(answers(parts), ["block", "shard", "count", "single", "pair"])


def _gather(unseen: int):
    """Blocks with the answers of all shards, which follow their block in order of their n-grams."""

    def finish(row, got):
        _, index, tokens, _ = _tokens(row)
        count, single, pair = (np.frombuffer(b"".join(r[k] for r in got), t) for k, t in (("count", np.int64), ("single", np.uint8), ("pair", np.uint8)))
        place = np.unique(pair_keys(tokens), return_inverse=True)[1]
        return _found(row, index, unseen, count, single, pair[place])

    def run(parts):
        block, got = None, []
        for row in _rows(parts):
            if row["shard"] is not None:
                got.append(row)
                continue
            if block:
                yield finish(block, got)
            block, got = row, []
        if block:
            yield finish(block, got)

    return run


def _before(single: np.ndarray, sizes: np.ndarray, end_level: int) -> np.ndarray:
    """Level of the token before each token; END stands before a text."""
    before = np.empty_like(single)
    before[1:] = single[:-1]
    before[np.cumsum(sizes) - sizes] = end_level
    return before


def _vote(total_tokens: int, end_level: int):
    """Per level of the word before: training tokens that the pair predicts better, and all."""

    def run(parts):
        votes = np.zeros((2, LEVELS + 1))
        for row in _rows(parts):
            sizes = np.array(row["sizes"], dtype=np.int64)
            train = np.repeat(~np.array(row["held"], dtype=bool), sizes)
            single, pair = np.frombuffer(row["single"], np.uint8), np.frombuffer(row["pair"], np.uint8)
            before = _before(single, sizes, end_level)[train]
            left, seen, alone = count_at(before), count_at(pair[train]), count_at(single[train])
            by_pair = np.where(left > 1.5, (seen - 1) / np.maximum(left - 1, 1), 0)
            by_word = (alone - 1) / max(total_tokens - 1, 1)
            votes[0] += np.bincount(before[by_pair > by_word], minlength=LEVELS + 1)
            votes[1] += np.bincount(before, minlength=LEVELS + 1)
        yield {"level": np.arange(LEVELS + 1), "pair": votes[0], "all": votes[1]}

    return run


def _score(weight: np.ndarray, total_tokens: int, types: int, end_level: int):
    def run(parts):
        for row in _rows(parts):
            sizes = np.array(row["sizes"], dtype=np.int64)
            single, pair = np.frombuffer(row["single"], np.uint8), np.frombuffer(row["pair"], np.uint8)
            before = _before(single, sizes, end_level)
            by_word = (count_at(single) + 1) / (total_tokens + types + 1)
            left = count_at(before)
            by_pair = np.where(left > 0, np.minimum(count_at(pair) / np.maximum(left, 1), 1), 0)
            chance = weight[before] * by_pair + (1 - weight[before]) * np.minimum(by_word, 1)
            yield {
                "doc_id": row["ids"], "held_out": row["held"], "n_tokens": sizes, "n_known": row["known"],
                "base_score": row["base"], "score": np.add.reduceat(np.log10(chance), np.cumsum(sizes) - sizes),
            }

    return run


def model_part(model: DataFrame, shards: int) -> ModelPart:
    got = sorted((r.asDict() for r in model.toLocalIterator()), key=lambda r: r["shard"])
    return ModelPart(got or [NOTHING], shards)


def score(
    docs: DataFrame,
    held_out: Column,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per document, scored by a model of those that are not ``held_out``.

    Columns ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (of them in the
    training texts), ``train_tokens``, ``base_score`` (add-one unigram, exact counts) and ``score``
    (log10 probability by the filter). Null and empty texts are the end alone; a null ``held_out``
    counts as false; repeated rows count each; without training texts every chance is 1 / (N + V + 1).
    An empty table gives no rows; other columns are not read. Intermediate tables are written below
    ``folder``, so each text is read once.
    """
    spark = docs.sparkSession
    slim = docs.select(
        F.col(quoted(id_col)).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(quoted(text_col)).cast("string").alias("text")
    )
    id_type = slim.schema["id"].dataType.simpleString()

    def stored(df: DataFrame, name: str) -> DataFrame:
        with settings(spark, JOBS):
            df.write.mode("overwrite").options(**WRITING).parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    def by_shard(df: DataFrame, *order: Column) -> DataFrame:
        return df.repartitionById(shards, "shard").sortWithinPartitions("shard", *order)

    blocks = stored(task_rows(slim, BLOCKS.format(id=id_type), _tokenize, BLOCK_BYTES), "blocks")
    size = blocks.agg(F.count("*").alias("blocks"), F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)")).alias("tokens")).first()
    shards = max(MIN_SHARDS, 1 << ((size["tokens"] or 0) // SHARD_TOKENS).bit_length())
    counts = task_rows(blocks, COUNTS, _count(shards), 1)
    model = stored(task_rows(by_shard(counts), MODEL, _make_shards, ROWS_BYTES), "model")
    whole = model.agg(
        F.sum("tokens").alias("n"), F.sum(F.octet_length("words") / 8).cast("bigint").alias("v"), F.sum("bytes").alias("bytes")
    ).first()
    total, types = whole["n"] or 0, whole["v"] or 0
    unseen = total + types + 1

    scored_type = SCORED.format(id=id_type)
    if (whole["bytes"] or 0) <= broadcast_bytes:
        part = model_part(model, shards)
        end_level = int(part.probe(np.array([END]))[0])
        shared = spark.sparkContext.broadcast(part)
        scored = stored(task_rows(blocks, scored_type, _probe(shared, unseen), 1), "scored")
        shared.destroy()
    else:
        end_level = int(model_part(model.where(F.col("shard") == Cut(shards).shard(int(END))), shards).probe(np.array([END]))[0])
        asked = model.select("shard", "words", "word_counts", "filter").unionByName(task_rows(blocks, ASKED, _ask(shards), 1), True)
        answers = stored(task_rows(by_shard(asked, F.col("block").asc_nulls_first()), ANSWERS, _answer(shards), ROWS_BYTES), "answers")
        both = blocks.unionByName(answers, True).repartition(-(-size["blocks"] // TASK_BLOCKS), "block")
        ordered = both.sortWithinPartitions("block", F.col("shard").asc_nulls_first())
        scored = stored(task_rows(ordered, scored_type, _gather(unseen), 1), "scored")
    votes = task_rows(scored, "level bigint, pair double, all double", _vote(total, end_level), 1)
    weight = np.zeros(LEVELS + 1)
    for r in votes.groupBy("level").agg(F.sum("pair").alias("pair"), F.sum("all").alias("all")).collect():
        weight[r["level"]] = min(r["pair"] / (r["all"] + 1), 0.99)
    schema = f"doc_id {id_type}, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"
    scores = task_rows(scored, schema, _score(weight, total, types, end_level), 1)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")
