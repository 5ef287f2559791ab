"""Near-duplicate components by an exact, size-aware Jaccard join of word shingles.

Equal sets are one class from the start; everything else works on classes. Two sets of sizes n and m
link when their overlap is at least o(n, m) = ceil(J (n + m) / (1 + J)).

Small sets: all subsets of each possible overlap size o are enumerated. Sets that share a subset of
size o link if n + m <= o (1 + J) / J, so linking each to the smallest set of its subset gives the
same components as all pairs, in as many rows as there are subsets.

Large sets: of the shingles in one global order, rarest first, linked sets share one among the first
n - ceil(J n) + 1, so only those go into inverted lists. The lists are scanned from every set that is
not of a list's most frequent label (at first, each class is its own label). The first scan takes up one
partner of each set, the first in an order that is the same for all, so near copies meet at one of
them; what links is contracted to one label, until nothing changes. After that each list that still
has several labels is scanned without limit if that makes few pairs per entry, else with a growing
limit; the last scan has none: every pair of different labels that shares a list is checked. So a group
of thousands of near copies costs a check or two per member, not all its pairs, and no link is lost.
Between scans only labels are kept, one row per class, not the links they came from.

The boundary between small and large is where the counted sizes make enumeration and lists cost the
same. Candidates are checked by parity bitmaps (the number of differing bits is never more than the
number of differing shingles) and, if they pass, exactly.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import quoted, task_rows

SHINGLE = 4
HEAVY_IN_TASK = 4
HEAVY_DOCS = 64
HEAVY_MAX = 1_000_000  # entries of the broadcast order of frequent shingles; others go by their hash
BROADCAST_IDS = 500_000  # ids that may be broadcast; more are joined by shuffling
MAX_SMALL = 48
LIST_COST = 8.0  # what a list entry costs in rows of an enumerated subset: counting, scanning, checking
ROUNDS = (1, 8, 32, None)  # partners that a scan takes up of each set in long lists
MEAN_PARTNERS = 8  # open pairs per entry up to which a list is not long, once near copies are contracted
SCAN_BLOCK = 1024
HELD = 8_000_000
TEXT_BLOCK = 2 << 20  # bytes of documents made to sets at a time; words, ranks and bitmaps take some ten times as much
CACHE_WORDS = 100_000  # hashes a worker keeps from block to block, some 15 MB
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))
_known: dict[bytes, int] = {}

LINKS = "a bigint, b bigint"


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least ``num`` / ``den``."""

    num: int = 85
    den: int = 100

    def overlap(self, n, m):
        """Least overlap with which sets of n and m elements link."""
        return -(-self.num * (n + m) // (self.num + self.den))

    def most(self, overlap):
        """Largest n + m that links with this overlap."""
        return overlap * (self.num + self.den) // self.num

    def least_partner(self, n):
        return -(-self.num * n // self.den)

    def prefix(self, n):
        """Shingles of which one at least is shared with any linked set."""
        return n - self.least_partner(n) + 1

    def overlaps(self, n, largest) -> list[int]:
        """Overlap sizes with which a set of n elements can link to sets of at most ``largest``."""
        partners = range(max(1, self.least_partner(n)), min(largest, n * self.den // self.num) + 1)
        return sorted({o for m in partners if (o := self.overlap(n, m)) <= min(n, m)})

    def subsets(self, n, largest) -> int:
        return sum(comb(n, o) for o in self.overlaps(n, largest))


def mixed(keys: np.ndarray) -> np.ndarray:
    keys = (keys ^ keys >> np.uint64(31)) * _MIX[0]
    return keys ^ keys >> np.uint64(29)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``size`` words, or of the whole text if it has fewer."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    row = list(map(_known.get, words))
    if None in row:
        for k, w in enumerate(words):
            if row[k] is None:
                row[k] = _known[w] = xxhash.xxh3_64_intdigest(w)
    keys = np.array(row, dtype=np.uint64)
    size = min(size, len(keys))
    n = len(keys) - size + 1
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        out = (out ^ out >> np.uint64(32)) * _MIX[1] + keys[k : k + n]
    return np.unique(mixed(out))


def sets_of(texts: list[str | None], size: int) -> list[np.ndarray]:
    if len(_known) > CACHE_WORDS:
        _known.clear()
    return [shingle_set(t, size) for t in texts]


def set_id(shingles: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64)))


def parity_bitmap(shingles: np.ndarray) -> bytes:
    """One bit per hash value modulo a power of two: is it hit an odd number of times?"""
    bits = max(64, 1 << (4 * len(shingles) - 1).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(bool), bitorder="little").tobytes()


def differing_bits(a: bytes, b: bytes) -> int:
    x, y = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _frequent(size: int):
    """Per task: shingles that several of its distinct sets have, and how many small sets it has."""

    def run(parts):
        held, seen, sizes, total = [], set(), np.zeros(MAX_SMALL + 1, dtype=np.int64), 0

        def drain():
            whole = np.concatenate([*held, np.zeros(0, np.uint64)])
            held.clear()
            whole.sort()
            # Of a shingle found c times, c - more equal the one that many places on; only the frequent ones are counted.
            more = HEAVY_IN_TASK - 1
            keys, counts = np.unique(whole[more:][whole[more:] == whole[: max(len(whole) - more, 0)]], return_counts=True)
            return {"token": keys.astype(np.int64), "n": counts + more, "size": np.full(len(keys), -1)}

        for part in parts:
            for shingles in sets_of(part.column("text").to_pylist(), size):
                key = set_id(shingles)
                if key in seen:
                    continue
                seen.add(key)
                held.append(shingles)
                total += len(shingles)
                if len(shingles) <= MAX_SMALL:
                    sizes[len(shingles)] += 1
            if total > HELD:
                yield drain()
                seen, total = set(), 0
        yield drain()
        yield {"token": np.zeros(MAX_SMALL + 1, np.int64), "n": sizes, "size": np.arange(MAX_SMALL + 1)}

    return run


def small_boundary(sizes: dict[int, int], rule: Threshold) -> int:
    """Largest size that is enumerated: where lists and subsets together cost least."""

    def cost(largest):
        subsets = sum(c * rule.subsets(n, largest) for n, c in sizes.items() if 0 < n <= largest)
        lists = sum(c * rule.prefix(n) for n, c in sizes.items() if n >= max(1, rule.least_partner(largest + 1)))
        return subsets + LIST_COST * lists

    return min(range(MAX_SMALL + 1), key=cost)


def subset_keys(shingles: np.ndarray, overlap: int) -> list[int]:
    """A key for each subset of ``overlap`` shingles: its size and the sum of its mixed hashes."""
    parts = [int(x) for x in mixed(shingles * _MIX[2])]
    whole = sum(parts)
    return [
        int.from_bytes(((whole - sum(out)) % 2**64).to_bytes(8, "little"), "little", signed=True)
        for out in combinations(parts, len(parts) - overlap)
    ]


def _signatures(shared, size: int, rule: Threshold, largest_small: int):
    """Per document: class, size, bitmap, first shingles in the global order, subsets if it is small."""

    def run(parts):
        heavy, rank = shared.value
        from_list = max(1, rule.least_partner(largest_small + 1))
        for part in parts:
            sets = sets_of(part.column("text").to_pylist(), size)
            firsts, subsets = [], []
            whole = np.concatenate([*sets, np.zeros(0, np.uint64)])
            at = np.minimum(np.searchsorted(heavy, whole), max(len(heavy) - 1, 0))
            ranks = np.where(heavy[at] == whole, rank[at], 0) if len(heavy) else np.zeros(len(whole), np.int64)
            first = 0
            for shingles in sets:
                n = len(shingles)
                own = ranks[first : first + n]
                first += n
                if n < from_list:
                    firsts.append([])
                else:
                    order = np.argsort(own, kind="stable")[: rule.prefix(n)] if own.any() else slice(0, rule.prefix(n))
                    firsts.append(shingles[order].astype(np.int64))
                small = 0 < n <= largest_small
                subsets.append(
                    [{"o": o, "key": k} for o in rule.overlaps(n, largest_small) for k in subset_keys(shingles, o)] if small else []
                )
            yield {
                "doc_id": part.column("doc_id").to_pylist(),
                "class": [set_id(s) for s in sets],
                "n": [len(s) for s in sets],
                "bitmap": [parity_bitmap(s) if len(s) else None for s in sets],
                "firsts": firsts,
                "subsets": subsets,
            }

    return run


def _class_sets(size: int):
    """Shingles of each class, from the document that stands for it."""

    def run(parts):
        for part in parts:
            sets = sets_of(part.column("text").to_pylist(), size)
            kept = [(k, s) for k, s in zip(part.column("class").to_pylist(), sets, strict=True) if set_id(s) == k]
            yield {"class": [k for k, _ in kept], "shingles": [s.tobytes() for _, s in kept]}

    return run


def _bitmap_check(rule: Threshold):
    def run(parts):
        for part in parts:
            c = {k: part.column(k).to_pylist() for k in ("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b")}
            ok = [
                k
                for k, (n, m, x, y) in enumerate(zip(c["n_a"], c["n_b"], c["bitmap_a"], c["bitmap_b"], strict=True))
                if differing_bits(x, y) <= n + m - 2 * rule.overlap(n, m) and rule.overlap(n, m) <= min(n, m)
            ]
            yield {"a": [c["a"][k] for k in ok], "b": [c["b"][k] for k in ok]}

    return run


def _exact_check(rule: Threshold):
    def run(parts):
        for part in parts:
            c = {k: part.column(k).to_pylist() for k in ("a", "b", "shingles_a", "shingles_b")}
            ok = []
            for k, (x, y) in enumerate(zip(c["shingles_a"], c["shingles_b"], strict=True)):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(np.intersect1d(x, y, assume_unique=True)) >= rule.overlap(len(x), len(y)):
                    ok.append(k)
            yield {"a": [c["a"][k] for k in ok], "b": [c["b"][k] for k in ok]}

    return run


def _order(ids: np.ndarray) -> np.ndarray:
    """A fixed order of partners that has nothing to do with ids or lists."""
    return mixed(ids.astype(np.uint64) * _MIX[2])


def first_partners(own: np.ndarray, partner: np.ndarray, limit: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs by ``own``, of each at most ``limit`` partners, the first in the fixed order."""
    rank = _order(partner)
    by = np.lexsort((rank, own))
    own, partner = own[by], partner[by]
    fresh = np.r_[True, (own[1:] != own[:-1]) | (partner[1:] != partner[:-1])][: len(own)]
    own, partner = own[fresh], partner[fresh]
    if limit is not None and len(own):
        starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        place = np.arange(len(own)) - np.repeat(starts, np.diff(np.r_[starts, len(own)]))
        own, partner = own[place < limit], partner[place < limit]
    return own, partner


def _scan_lists(rule: Threshold, limit: int | None):
    """Partners of each scanning set in each block of its lists."""

    def run(parts):
        for part in parts:
            members = part.column("members").combine_chunks()
            members = pa.concat_arrays(members.chunks) if isinstance(members, pa.ChunkedArray) else members
            rows = np.repeat(np.arange(part.num_rows), np.diff(members.offsets.to_numpy()))
            flat = members.flatten()
            y, m, y_at, y_label = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            x, n, x_at, x_label, top = (part.column(c).to_numpy()[rows] for c in ("class", "n", "at", "label", "top"))
            # At the first shingle in common all before it differ, so neither side may stand too late.
            overlap = rule.overlap(n, m)
            ok = (y_label != x_label) & (x_at <= n - overlap) & (y_at <= m - overlap)
            if limit is None:
                ok &= (y_label == top) | (y < x)  # of two sets that both scan the list, one has the pair
            own, partner = first_partners(x[ok], y[ok], limit)
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else np.zeros(0, np.int64)
            partners = pa.ListArray.from_arrays(pa.array(np.r_[starts, len(own)].astype(np.int32)), pa.array(partner))
            yield {"class": own[starts], "partners": partners}

    return run


def _merge_partners(limit: int | None):
    """The pairs to check, from partners that come by set."""

    def pairs(own, partner):
        own, partner = first_partners(own, partner, limit)
        return {"a": np.minimum(own, partner), "b": np.maximum(own, partner)}

    def run(parts):
        held_own, held = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for part in parts:
            partners = part.column("partners").combine_chunks()
            partners = pa.concat_arrays(partners.chunks) if isinstance(partners, pa.ChunkedArray) else partners
            own = np.repeat(part.column("class").to_numpy(), np.diff(partners.offsets.to_numpy()))
            own, partner = np.r_[held_own, own], np.r_[held, partners.flatten().to_numpy()]
            # The last set may go on in the next block.
            done = own != own[-1] if len(own) else np.zeros(0, dtype=bool)
            yield pairs(own[done], partner[done])
            held_own, held = first_partners(own[~done], partner[~done], limit)
        yield pairs(held_own, held)

    return run


class ClassJoin:
    """The join of the classes; tables between steps are written below ``folder``."""

    def __init__(self, docs: DataFrame, folder: str, shingle: int, rule: Threshold):
        self.spark, self.docs, self.folder, self.shingle, self.rule, self.made = docs.sparkSession, docs, folder, shingle, rule, 0

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        self.made += 1
        path = f"{self.folder}/{self.made:02d}-{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def few(self, ids: DataFrame) -> DataFrame:
        """Broadcast if counted to be few, else joined by shuffling."""
        return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def stand_for(self, signed: DataFrame, lists: DataFrame, small: DataFrame) -> None:
        """Note size, bitmap and one document of each class that may be in a pair."""
        wanted = lists.select("class").union(small.select("a")).union(small.select("b")).distinct()
        wanted = self.stored(wanted, "wanted")
        rows = signed.select("class", "doc_id", "n", "bitmap").join(self.few(wanted), "class", "left_semi")
        self.marks = self.stored(rows.groupBy("class").agg(F.min("doc_id").alias("id"), F.max("n").alias("n"), F.max("bitmap").alias("bitmap")), "marks")

    def shingles(self, pairs: DataFrame) -> DataFrame:
        """The sets of the classes in ``pairs``, made from their documents' texts."""
        classes = self.stored(pairs.select(F.col("a").alias("class")).union(pairs.select("b")).distinct(), "in-pairs")
        stands = self.stored(self.marks.select("class", "id").join(self.few(classes), "class", "left_semi"), "stands")
        texts = self.docs.join(self.few(stands), F.col("doc_id").eqNullSafe(F.col("id"))).select("class", "text")
        sets = self.stored(task_rows(texts, "class bigint, shingles binary", _class_sets(self.shingle), TEXT_BLOCK), "sets")
        # Only documents that repeat an id give a class twice.
        return sets if sets.count() == stands.count() else sets.dropDuplicates(["class"])

    def checked(self, pairs: DataFrame) -> DataFrame:
        """The pairs that link."""

        def beside(pairs, sets, *columns):
            for end in ("a", "b"):
                pairs = pairs.join(sets.select(F.col("class").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in columns]), end)
            return pairs

        passed = self.stored(task_rows(beside(pairs.distinct(), self.marks, "n", "bitmap"), LINKS, _bitmap_check(self.rule)), "passed")
        if passed.isEmpty():
            return passed
        return self.stored(task_rows(beside(passed, self.shingles(passed), "shingles"), LINKS, _exact_check(self.rule)), "links")

    def small_pairs(self, signed: DataFrame) -> DataFrame:
        """Each set with the smallest set that has the same subset, if they link."""
        rows = signed.select("class", "n", F.explode("subsets").alias("s")).select("class", "n", "s.o", "s.key")
        heads = rows.groupBy("o", "key").agg(F.min(F.struct("n", "class")).alias("head"), F.min("class").alias("lo"), F.max("class").alias("hi"))
        heads = heads.where("lo != hi").drop("lo", "hi")
        rule = self.rule
        most = F.floor(F.col("o") * (rule.num + rule.den) / rule.num)
        met = rows.join(heads, ["o", "key"]).where((F.col("class") != F.col("head.class")) & (F.col("n") + F.col("head.n") <= most))
        return met.select(F.least("class", "head.class").alias("a"), F.greatest("class", "head.class").alias("b"))

    def lists(self, signed: DataFrame) -> DataFrame:
        """Entries of the inverted lists that have members of different classes."""
        rows = signed.select("class", "n", F.posexplode("firsts").alias("at", "token"))
        shared = rows.groupBy("token").agg(F.min("class").alias("lo"), F.max("class").alias("hi")).where("lo != hi").select("token")
        shared = self.stored(shared, "shared-shingles")
        return self.stored(rows.join(self.few(shared), "token", "left_semi").select("token", "class", "n", "at").distinct(), "lists")

    def labelled(self, lists: DataFrame, labels: DataFrame | None) -> DataFrame:
        """Entries with labels, of lists that still have several labels."""
        label = F.col("class") if labels is None else F.coalesce("label", "class")
        rows = (lists if labels is None else lists.join(labels, "class", "left")).select("token", "class", "n", "at", label.alias("label"))
        open_ = rows.groupBy("token").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo != hi").select("token")
        return rows.join(open_, "token", "left_semi")

    def long_lists(self, rows: DataFrame) -> DataFrame:
        """The lists that make many pairs of different labels per entry."""
        by_label = rows.groupBy("token", "label").agg(F.count("*").cast("double").alias("c"))
        by_list = by_label.groupBy("token").agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("c")).alias("same"))
        return by_list.where((F.col("n") - F.col("same") / F.col("n")) / 2 > MEAN_PARTNERS).select("token")

    def scans(self, rows: DataFrame, limit: int | None) -> DataFrame:
        """Pairs of different labels that share a list; of each set ``limit`` or all of them."""
        counts = rows.groupBy("token", "label").agg(F.count("*").alias("c"))
        tops = counts.groupBy("token").agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("length"))
        tops = tops.select("token", F.col("top.label").alias("top"), F.ceil(F.col("length") / SCAN_BLOCK).alias("blocks"))
        marked = self.stored(rows.join(tops, "token"), "marked")
        block = F.pmod(F.xxhash64("class"), F.col("blocks"))
        members = marked.groupBy("token", block.alias("block")).agg(F.collect_list(F.struct("class", "n", "at", "label")).alias("members"))
        scanning = marked.where("label != top").select("token", "class", "n", "at", "label", "top")
        met = scanning.join(members, "token").select("class", "n", "at", "label", "top", "members")
        partners = task_rows(met, "class bigint, partners array<bigint>", _scan_lists(self.rule, limit), 4 << 20)
        by_class = partners.repartition("class").sortWithinPartitions("class")
        return self.stored(task_rows(by_class, LINKS, _merge_partners(limit), 4 << 20), "scanned")

    def follow(self, labels: DataFrame | None, links: DataFrame) -> DataFrame | None:
        """Labels after joining what ``links`` link; classes without a row are their own label.

        The links are seen as links of labels, so earlier ones need not be kept.
        """
        if labels is not None:
            known = self.few(labels)
            for end in ("a", "b"):
                links = links.join(known.select(F.col("class").alias(end), F.col("label").alias("to")), end, "left")
                links = links.withColumn(end, F.coalesce("to", end)).drop("to")
        edges = self.stored(links.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
        n = edges.count()
        if not n:
            return labels
        # As many classes as ends at most; beyond the bound Spark joins them by shuffling.
        share = F.broadcast if 2 * n <= BROADCAST_IDS else lambda ids: ids
        moved = self.spread(edges, share)
        if labels is None:
            return moved
        to = share(moved.select(F.col("class").alias("label"), F.col("label").alias("to")))
        old = labels.join(to, "label", "left").select("class", F.coalesce("to", "label").alias("label"))
        return self.stored(old.union(moved.join(labels, "class", "left_anti")), "followed")

    def spread(self, links: DataFrame, share) -> DataFrame:
        """Labels of the linked classes: the least class that can be reached.

        Labels go to rows through ``share``, by broadcast where they are counted to be few, as a label
        may have a large share of all rows.
        """
        both = links.union(links.select("b", "a"))
        labels = both.select(F.col("a").alias("class")).distinct().withColumn("label", F.col("class"))
        while True:
            far = share(labels.withColumnsRenamed({"class": "b", "label": "far"}))
            near = share(both.join(far, "b").groupBy("a").agg(F.min("far").alias("far")).withColumnRenamed("a", "class"))
            hooked = self.stored(labels.join(near, "class").select("class", "label", F.least("label", "far").alias("new")), "hooked")
            # A class whose own label's class moved on follows it; all of one label move together.
            moved = share(hooked.groupBy("label").agg(F.min("new").alias("to")))
            merged = hooked.join(moved, "label").select("class", "label", F.least("new", "to").alias("new"))
            after = share(merged.select(F.col("class").alias("new"), F.col("new").alias("last")))
            last = F.least("new", "last")
            jumped = self.stored(merged.join(after, "new", "left").select("class", last.alias("label"), (last != F.col("label")).alias("changed")), "labels")
            labels = jumped.select("class", "label")
            if jumped.where("changed").isEmpty():
                return labels


def components(
    docs: DataFrame,
    folder: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    rule: Threshold | None = None,
) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles`` (size of its set), ``component_id`` (smallest
    id that is reachable by links, its own included).

    Null texts and texts without words have an empty set and link with nothing. A null id is kept and
    never a component's smallest unless all ids there are null. Repeated rows are documents with
    equal sets; an empty table gives no rows; other columns are not read.
    """
    spark, rule = docs.sparkSession, rule or Threshold()
    slim = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    id_type = slim.schema["doc_id"].dataType.simpleString()
    join = ClassJoin(slim, folder, shingle, rule)

    found = task_rows(slim.select("text"), "token bigint, n bigint, size int", _frequent(shingle), TEXT_BLOCK)
    counted = join.stored(found.groupBy("token", "size").agg(F.sum("n").alias("n")), "frequent")
    heavy = counted.where(f"size = -1 and n >= {HEAVY_DOCS}").orderBy(F.desc("n"), "token").limit(HEAVY_MAX).select("token", "n").toArrow()
    tokens = heavy.column("token").to_numpy().astype(np.uint64)
    order = np.argsort(tokens)
    ranks = np.log2(np.maximum(heavy.column("n").to_numpy(), 1)).astype(np.int64)
    sizes = {r["size"]: r["n"] for r in counted.where("size >= 0").select("size", "n").collect()}
    shared = spark.sparkContext.broadcast((tokens[order], ranks[order]))
    schema = f"doc_id {id_type}, class bigint, n bigint, bitmap binary, firsts array<bigint>, subsets array<struct<o:int,key:bigint>>"
    signed = join.stored(task_rows(slim, schema, _signatures(shared, shingle, rule, small_boundary(sizes, rule)), TEXT_BLOCK), "signatures")

    lists = join.lists(signed)
    small = join.stored(join.small_pairs(signed).distinct(), "small-pairs")
    join.stand_for(signed, lists, small)

    labels = join.follow(None, join.checked(small))
    for limit in ROUNDS:
        rows = join.stored(join.labelled(lists, labels), "open")
        if rows.isEmpty():
            break
        if limit == 1:
            scanned, long = join.scans(rows, 1), None
        elif limit is None:
            scanned, long = join.scans(rows, None), None
        else:
            long = join.stored(join.long_lists(rows), "long-lists")
            scanned = join.scans(rows.join(join.few(long), "token", "left_anti"), None)
            if not long.isEmpty():
                scanned = scanned.union(join.scans(rows.join(join.few(long), "token", "left_semi"), limit))
        labels = join.follow(labels, join.checked(scanned))
        if long is not None:
            if long.isEmpty():
                break
            # Of all others every pair has been seen.
            lists = join.stored(lists.join(join.few(long), "token", "left_semi"), "lists")

    result = signed.select("doc_id", "n", "class")
    if labels is None:
        result = result.withColumn("label", F.col("class"))
    else:
        result = result.join(join.few(labels), "class", "left").withColumn("label", F.coalesce("label", "class"))
    # The empty set's class holds unrelated documents; they keep their own ids.
    least = result.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("least"))
    return result.join(least, "label", "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
    )
