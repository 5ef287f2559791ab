"""Language identification by a bit-sliced Bloom filter of character n-grams.

Slot i of the filter holds one bit per language. An n-gram sets the bits of its languages in each of
its slots; the bitwise AND of its slots gives all languages that contain it (and, rarely, others).
A text's n-grams vote by population count per language; the counts are corrected for each language's
false-positive rate, and the largest decides.

Counts are gathered over all training rows, added up per task before they are shuffled. The filter
has at most ``MAX_SLOTS`` slots, so what is broadcast is bounded; a fuller filter has a higher
false-positive rate, which the correction takes out again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import map_rows, quoted, task_rows

GRAM = 3
HASHES = 3
MAX_SLOTS = 1 << 22
SHARE = 0.15  # a language contains an n-gram if it uses it at this share of the keenest language's rate
WORD_BITS = 62
HELD = 1_000_000
TEXT_BLOCK = 512 << 10  # bytes of texts cut up at a time; n-grams and slots take some eighty times as much
UNKNOWN = "und"
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_letters: list[np.ndarray] = []


def letter_table() -> np.ndarray:
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed n-grams of all texts, the text each belongs to, and whether a text has a letter.

    Texts are lower-cased; every run of other characters than letters is one blank, and a text
    starts and ends with one.
    """
    lowered = [" " + (t or "").lower() + " " for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le"), dtype="<u4")
    sizes = np.array([len(t) for t in lowered], dtype=np.int64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    letter = letter_table()[codes]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[np.cumsum(sizes) - sizes] = True
    has_letter = np.bincount(owner[letter], minlength=len(texts)) > 0
    codes = np.where(letter, codes, 32)[keep].astype(np.uint64)
    owner = owner[keep]
    n = len(codes) - GRAM + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int32), has_letter
    key = codes[:n]
    for k in range(1, GRAM):
        key = key << np.uint64(21) | codes[k : k + n]
    whole = owner[:n] == owner[GRAM - 1 :]
    return key[whole], owner[:n][whole], has_letter


def slots_of(key: np.ndarray, slots: int) -> list[np.ndarray]:
    """The slots of each n-gram; ``slots`` is a power of two."""
    shift = np.uint64(64 - (slots.bit_length() - 1))
    mixed = (key ^ key >> np.uint64(29)) * _MULTIPLIERS[0]
    mixed ^= mixed >> np.uint64(32)
    return [(mixed * m >> shift).astype(np.int64) for m in _MULTIPLIERS[:HASHES]]


@dataclass
class LanguageFilter:
    languages: list[str]
    words: list[np.ndarray] = field(default_factory=list)  # bit-sliced slots, WORD_BITS languages each
    false_rate: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def decide(self, texts: list[str | None]) -> dict[str, list]:
        key, owner, has_letter = grams(texts)
        n = np.bincount(owner, minlength=len(texts)).astype(float)
        if not self.languages:
            return {"lang_pred": [UNKNOWN] * len(texts), "score": [0.0] * len(texts)}
        slots = slots_of(key, len(self.words[0]))
        hits = np.zeros((len(self.languages), len(texts)))
        for w, word in enumerate(self.words):
            mask = word[slots[0]]
            for s in slots[1:]:
                mask &= word[s]
            for bit in range(min(WORD_BITS, len(self.languages) - w * WORD_BITS)):
                hits[w * WORD_BITS + bit] = np.bincount(owner[(mask >> bit & 1).astype(bool)], minlength=len(texts))
        rate = self.false_rate[:, None]
        true = np.clip((hits - n * rate) / np.maximum(1 - rate, 1e-9), 0, None)
        best = true.argmax(axis=0)
        score = np.clip(true[best, np.arange(len(texts))] / np.maximum(n, 1), 0, 1)
        return {
            "lang_pred": [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter, strict=True)],
            "score": [float(s) if ok else 0.0 for s, ok in zip(score, has_letter, strict=True)],
        }


def _count(parts):
    held: dict[str, list] = {}
    size = 0

    def drain():
        for lang, arrays in sorted(held.items()):
            keys, inverse = np.unique(np.concatenate([a for a, _ in arrays]), return_inverse=True)
            counts = np.bincount(inverse, weights=np.concatenate([c for _, c in arrays])).astype(np.int64)
            yield {"lang": [lang] * len(keys), "gram": keys.astype(np.int64), "n": counts}
        held.clear()

    for part in parts:
        key, owner, _ = grams(part.column("text").to_pylist())
        langs = np.array(part.column("lang").to_pylist(), dtype=object)[owner]
        for lang in set(langs):
            keys, counts = np.unique(key[langs == lang], return_counts=True)
            held.setdefault(lang, []).append((keys, counts))
            size += len(keys)
        if size > HELD:
            yield from drain()
            size = 0
    yield from drain()


def _slots(slots: int, words: int):
    def run(parts):
        for part in parts:
            key = part.column("gram").to_numpy().astype(np.uint64)
            out = {"slot": np.concatenate(slots_of(key, slots))}
            for w in range(words):
                out[f"w{w}"] = np.tile(part.column(f"w{w}").to_numpy(), HASHES)
            yield out

    return run


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", max_slots: int = MAX_SLOTS) -> LanguageFilter:
    """The filter of all rows with a text and a language."""
    slim = docs.select(F.col(quoted(text_col)).cast("string").alias("text"), F.col(quoted(lang_col)).cast("string").alias("lang"))
    partial = task_rows(slim.where("text is not null and lang is not null"), "lang string, gram bigint, n bigint", _count, TEXT_BLOCK)
    counts = partial.groupBy("lang", "gram").agg(F.sum("n").alias("n")).persist()
    totals = {r["lang"]: r["total"] for r in counts.groupBy("lang").agg(F.sum("n").alias("total")).collect()}
    languages = sorted(totals)
    if not languages:
        counts.unpersist()
        return LanguageFilter([])
    words = -(-len(languages) // WORD_BITS)
    numbers = range(len(languages))
    # From Arrow: rows of Python objects would start workers of another kind beside those of the tasks.
    lookup = docs.sparkSession.createDataFrame(
        pa.table(
            {
                "lang": pa.array(languages, pa.string()),
                "word": pa.array([k // WORD_BITS for k in numbers], pa.int32()),
                "bit": pa.array([1 << k % WORD_BITS for k in numbers], pa.int64()),
                "total": pa.array([float(totals[lang]) for lang in languages], pa.float64()),
            }
        )
    )
    used = counts.join(F.broadcast(lookup), "lang").withColumn("rate", F.col("n") / F.col("total"))
    by_gram = used.groupBy("gram").agg(F.max("rate").alias("peak"), F.collect_list(F.struct("word", "bit", "rate")).alias("uses"))

    def mask(w):
        return F.aggregate(
            "uses",
            F.lit(0).cast("bigint"),
            lambda acc, u: F.when((u["word"] == w) & (u["rate"] >= SHARE * F.col("peak")), acc.bitwiseOR(u["bit"])).otherwise(acc),
        )

    masks = by_gram.select("gram", *[mask(w).alias(f"w{w}") for w in range(words)])
    n = counts.select("gram").distinct().count()
    slots = min(max_slots, 1 << max(10, (2 * HASHES * n - 1).bit_length()))
    schema = "slot bigint, " + ", ".join(f"w{w} bigint" for w in range(words))
    filled = task_rows(masks, schema, _slots(slots, words)).groupBy("slot").agg(*[F.bit_or(f"w{w}").alias(f"w{w}") for w in range(words)]).toArrow()
    counts.unpersist()
    at = filled.column("slot").to_numpy()
    made = LanguageFilter(languages, [np.zeros(slots, dtype=np.int64) for _ in range(words)])
    for w in range(words):
        made.words[w][at] = filled.column(f"w{w}").to_numpy()
    fill = [np.mean(made.words[k // WORD_BITS] >> k % WORD_BITS & 1) for k in range(len(languages))]
    made.false_rate = np.array(fill) ** HASHES
    return made


def identify(docs: DataFrame, model: LanguageFilter, text_col: str = "text", out: str = "result") -> DataFrame:
    """Rows of ``docs`` as struct ``row`` beside a struct ``out`` (``lang_pred``, ``score``).

    ``score`` is the share of the text's n-grams that the language contains, corrected for false
    positives. A null text and one without letters are ``und`` with score 0, as is every text if the
    filter learned nothing. Ties go to the first language by name. Rows are independent, so repeated
    rows get equal results; other columns are carried along under any name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_rows(
        docs,
        {"text": F.col(quoted(text_col)).cast("string")},
        "lang_pred string, score double",
        lambda block: shared.value.decide(block["text"]),
        out,
        block_bytes=TEXT_BLOCK,
    )
