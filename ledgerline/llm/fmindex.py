"""Benchmark decontamination with one FM-index per training shard.

A shard is a block of documents inside a task. Its text is a sequence of word numbers; words that
no benchmark item has are separators, and stretches too short for any phrase are left out. The
shard's suffix array gives the Burrows-Wheeler transform, kept as a wavelet matrix. All phrases are
searched backward together by ranks; occurrences are located by walking to sampled suffix positions;
overlapping ones merge to removal spans.

The benchmark is the stated query set. It is broadcast in blocks of at most ``block_words`` words,
so the broadcast has a fixed bound; each further block is one more pass over the documents, which are written
between passes.
"""

from __future__ import annotations

import re
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from ledgerline.llm.blocks import blocks, packed, quoted
from ledgerline.session import new_run_dir

SHARD_BYTES = 16 << 20
BLOCK_WORDS = 4_000_000
SAMPLE = 8
LOCATE_ROWS = 1 << 20
WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LETTERS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of letters, digits and other characters beyond ASCII, with A-Z in lower case."""
    return (text or "").encode().translate(_LETTERS).split()


class Phrases:
    """The distinct windows of a set of items as rows of word numbers."""

    def __init__(self, items: list[tuple], window: int):
        self.number: dict[bytes, int] = {}
        owners: dict[tuple, set] = {}
        for item, text in items:
            row = [self.number.setdefault(w, len(self.number) + 1) for w in words_of(text)]
            for at in range(max(1, len(row) - window + 1) if row else 0):
                owners.setdefault(tuple(row[at : at + window]), set()).add(item)
        self.windows = list(owners)
        self.owners = [sorted((i for i in x if i is not None), key=str) for x in owners.values()]
        self.length = np.array([len(w) for w in self.windows], dtype=np.int64)
        self.shortest = int(self.length.min()) if self.windows else 0
        self.symbols = np.zeros((len(self.windows), window), dtype=np.int64)
        for k, w in enumerate(self.windows):
            self.symbols[k, : len(w)] = w


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of the suffixes of ``text``, by prefix doubling over what is still tied."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    head = np.empty(n, dtype=np.int64)  # row at which a row's group of equal prefixes starts
    ranked = text[order]
    starts = np.r_[True, ranked[1:] != ranked[:-1]]
    head = np.maximum.accumulate(np.where(starts, np.arange(n), 0))
    rank = np.empty(n + 1, dtype=np.int64)
    rank[order], rank[n] = head, -1
    step = 1
    tied = np.flatnonzero(~(starts & np.r_[starts[1:], True]))
    while len(tied):
        suffix = order[tied]
        group, after = rank[suffix], rank[np.minimum(suffix + step, n)]
        by = np.lexsort((after, group))
        suffix, group, after = suffix[by], group[by], after[by]
        order[tied] = suffix
        starts = np.r_[True, (group[1:] != group[:-1]) | (after[1:] != after[:-1])]
        rank[suffix] = np.maximum.accumulate(np.where(starts, tied, 0))
        tied = tied[~(starts & np.r_[starts[1:], True])]
        step *= 2
    return order


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit of the symbols per level."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        self.bits = max(1, int(symbols - 1).bit_length())
        for bit in range(self.bits - 1, -1, -1):
            ones = (sequence >> bit & 1).astype(bool)
            count = np.zeros(len(sequence) + 1, dtype=np.int32)
            np.cumsum(ones, out=count[1:])
            zeros = len(sequence) - int(count[-1])
            self.levels.append((count, zeros))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])
        every = np.arange(symbols)
        self.first = self._down(every, np.zeros(symbols, dtype=np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for level, (count, zeros) in enumerate(self.levels):
            ones = count[at]
            at = np.where(symbol >> (self.bits - 1 - level) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each position."""
        return self._down(symbol, at) - self.first[symbol]

    def access(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols at positions, and their ranks there."""
        symbol = np.zeros(len(at), dtype=np.int64)
        for count, zeros in self.levels:
            ones = count[at]
            bit = count[at + 1] - ones
            symbol = symbol << 1 | bit
            at = np.where(bit, zeros + ones, at - ones)
        return symbol, at - self.first[symbol]


class FMIndex:
    """Index of word numbers in which 0 separates stretches; phrases never hold 0."""

    def __init__(self, text: np.ndarray, symbols: int):
        separators = np.flatnonzero(text == 0)
        # Each separator is a smallest symbol of its own, so no comparison runs past a stretch.
        distinct = text + len(separators)
        distinct[separators] = np.arange(len(separators))
        order = suffix_array(distinct)
        before = text[order - 1]
        before[order == 0] = 0
        self.tree = WaveletMatrix(before, symbols)
        self.start = np.zeros(symbols + 1, dtype=np.int64)
        np.cumsum(np.bincount(text, minlength=symbols), out=self.start[1:])
        # Sampled: every SAMPLE-th position and each first word of a stretch, where walks must end.
        sampled = np.arange(len(text)) % SAMPLE == 0
        sampled[separators] = True
        sampled[np.minimum(separators + 1, len(text) - 1)] = True
        sampled[0] = True
        self.is_sampled = sampled[order]
        self.sample_rank = np.cumsum(self.is_sampled, dtype=np.int32)
        self.samples = order[self.is_sampled]
        self.rows = len(text)

    def search(self, symbols: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row of the suffixes that start with each phrase, by backward steps."""
        low, high = np.zeros(len(length), dtype=np.int64), np.full(len(length), self.rows, dtype=np.int64)
        live = np.arange(len(length))
        for back in range(1, symbols.shape[1] + 1):
            live = live[(length[live] >= back) & (high[live] > low[live])]
            if not len(live):
                break
            symbol = symbols[live, length[live] - back]
            low[live] = self.start[symbol] + self.tree.rank(symbol, low[live])
            high[live] = self.start[symbol] + self.tree.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, by walking back to sampled positions."""
        found, at, steps = np.empty(len(rows), dtype=np.int64), rows.copy(), 0
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.is_sampled[at]
            found[open_[done]] = self.samples[self.sample_rank[at[done]] - 1] + steps
            open_, at = open_[~done], at[~done]
            symbol, rank = self.tree.access(at)
            at = self.start[symbol] + rank
            steps += 1
        return found


def stretches(text: np.ndarray, shortest: int) -> np.ndarray:
    """Positions kept: runs without 0 of at least ``shortest`` words, each with the 0 behind it."""
    zero = np.flatnonzero(text == 0)
    first, last = np.r_[0, zero + 1], np.r_[zero, len(text)]
    long = last - first >= shortest
    mark = np.zeros(len(text) + 2, dtype=np.int32)
    np.add.at(mark, first[long], 1)
    np.add.at(mark, np.minimum(last[long] + 1, len(text)), -1)
    return np.flatnonzero(np.cumsum(mark[: len(text)]))


def find_in_shard(texts: list[str | None], phrases: Phrases) -> tuple[list[int], dict[int, tuple[list, set]]]:
    """Word count of each text; per text with hits its merged word spans and the items found."""
    get, numbers, counts = phrases.number.get, [], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        numbers.append(np.array([get(w, 0) for w in words] + [0], dtype=np.int64))
    if not phrases.windows or not numbers:
        return counts, {}
    whole = np.concatenate(numbers)
    kept = stretches(whole, phrases.shortest)
    if not len(kept):
        return counts, {}
    index = FMIndex(whole[kept], len(phrases.number) + 1)
    low, high = index.search(phrases.symbols, phrases.length)
    hit = np.flatnonzero(high > low)
    first = np.r_[0, np.cumsum([len(x) for x in numbers])]
    covered = np.zeros(len(whole) + 1, dtype=np.int64)
    items: dict[int, set] = {}
    amounts = np.cumsum((high - low)[hit])
    for part in np.split(hit, np.unique(np.searchsorted(amounts, np.arange(LOCATE_ROWS, amounts[-1], LOCATE_ROWS)))) if len(hit) else []:
        if not len(part):
            continue
        amount = (high - low)[part]
        owner = np.repeat(part, amount)
        rows = np.arange(amount.sum()) - np.repeat(np.cumsum(amount) - amount, amount) + np.repeat(low[part], amount)
        at = kept[index.locate(rows)]
        np.add.at(covered, at, 1)
        np.add.at(covered, at + phrases.length[owner], -1)
        doc = np.searchsorted(first, at, side="right") - 1
        for d, w in np.unique(np.stack([doc, owner]), axis=1).T.tolist():
            items.setdefault(d, set()).update(phrases.owners[w])
    inside = np.r_[0, (np.cumsum(covered) > 0).astype(np.int8), 0]
    edge = np.diff(inside)
    begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    result: dict[int, tuple[list, set]] = {d: ([], found) for d, found in items.items()}
    for d, b, e in zip(np.searchsorted(first, begins, side="right") - 1, begins, ends, strict=True):
        result[int(d)][0].append((int(b - first[d]), int(e - first[d])))
    return counts, result


_prepared: dict[str, Phrases] = {}


def _phrases(key: str, items: list[tuple], window: int) -> Phrases:
    """The phrases of one broadcast block; a Python worker keeps those of one block."""
    if key not in _prepared:
        _prepared.clear()
        _prepared[key] = Phrases(items, window)
    return _prepared[key]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b, e in sorted(spans):
        if out and b <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((b, e))
    return out


def item_blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """The benchmark in parts of about ``block_words`` words; counted before anything is collected."""
    words = benchmark.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-words // (4 * block_words)))
    if parts == 1:
        return [benchmark]
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    filled = sorted(r["part"] for r in benchmark.select(part.alias("part")).distinct().collect())
    return [benchmark.where(part == k) for k in filled]


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 10,
    block_words: int = BLOCK_WORDS,
    out: str = "result",
    folder: str | None = None,
) -> DataFrame:
    """Rows of ``docs`` as struct ``row`` beside a struct ``out`` of what was found in their text.

    ``out`` has ``n_words``, ``n_hit`` (words inside an occurrence of a window of an item), ``items``
    (ids of items with occurring windows, sorted as text) and ``spans`` (start and end of removal
    spans in code points, end exclusive). A window is ``window`` consecutive words of an item, or all
    words of a shorter one. Null and empty texts have no words; items without words have no windows;
    an item with a null id hits words but is not listed; repeated items count once. Repeated
    documents are separate rows; empty tables give no rows or no hits; other columns are carried along.
    The benchmark is searched in blocks of about ``block_words`` words; between them, rows and what was found
    are written below ``folder`` (a new one by default).
    """
    items = benchmark.select(
        F.col(quoted(item_col)).alias("item"), F.col(quoted(item_text_col)).cast("string").alias("text")
    ).where("text is not null")
    item_type = items.schema["item"].dataType.simpleString()
    spark = docs.sparkSession
    found = packed(docs, text=F.col(quoted(text_col)).cast("string"))
    state = f"spans array<struct<start:bigint,end:bigint>>, items array<{item_type}>"
    parts = item_blocks(items, block_words)
    for k, part in enumerate(parts):
        shared = spark.sparkContext.broadcast([tuple(r) for r in part.collect()])
        last = k == len(parts) - 1
        names = ["row", out] if last else ["row", "text", "state"]
        result = _parse_datatype_string(f"n_words bigint, n_hit bigint, {state}" if last else state)
        kept = [found.schema[c] for c in names[:-1]]
        schema = StructType([*kept, StructField(names[-1], result)])
        found = found.mapInArrow(_shard_search(shared, uuid.uuid4().hex, window, last, to_arrow_schema(schema)), schema)
        if not last:
            # Written before the next block is searched, so that a task holds the phrases of one block.
            folder = folder or new_run_dir(spark, "decontamination")
            found.write.mode("overwrite").parquet(f"{folder}/pass{k % 2}")
            found = spark.read.schema(schema).parquet(f"{folder}/pass{k % 2}")
            shared.destroy()
    return found


def _shard_search(shared, key: str, window: int, last: bool, schema: pa.Schema):
    """One pass over the shards with one block of the benchmark; the last one finishes the result."""

    def run(batches):
        phrases = _phrases(key, shared.value, window)
        for block in blocks(batches, SHARD_BYTES):
            texts = block.column("text").to_pylist()
            earlier = block.column("state").to_pylist() if "state" in block.column_names else [None] * len(texts)
            counts, found = find_in_shard(texts, phrases)
            result = []
            for k, (text, n, before) in enumerate(zip(texts, counts, earlier, strict=True)):
                spans, items = found.get(k, ([], set()))
                if before:
                    spans = merged(spans + [(x["start"], x["end"]) for x in before["spans"]])
                    items = items | set(before["items"])
                row = {"n_words": n, "n_hit": sum(e - b for b, e in spans), "items": sorted(items, key=str)}
                if last and spans:
                    at = [m.span() for m in WORDS.finditer(text)]
                    spans = [(at[b][0], at[e - 1][1]) for b, e in spans]
                result.append(row | {"spans": [{"start": b, "end": e} for b, e in spans]})
            carried = [block.column(c).combine_chunks() for c in schema.names[:-1]]
            carried = [c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in carried]
            yield pa.RecordBatch.from_arrays([*carried, pa.array(result, type=schema.field(len(schema) - 1).type)], schema=schema)

    return run
