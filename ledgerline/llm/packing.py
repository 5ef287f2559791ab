"""Hierarchical packing of documents into windows of several context sizes.

Each task works through its rows in pools of bounded size. A document is routed to the smallest
tier that holds it (longer ones give whole windows of the longest tier first). From the longest
tier down, every window starts with the largest open document of its tier; the gap behind it is
filled with the largest shorter documents that fit, and at last with the head of one that does not,
whose rest stays open. So windows are exactly full. What does not fill a window waits for the next
pool; the end of a task is cut into windows of powers of two. Nothing is shuffled: ids are made,
packed and written by the task that reads the text.

Windows of one length are dealt to step groups of ``step_tokens`` tokens by attention cost, in
serpentine order, so that the steps of a group set cost about the same.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import deque

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import quoted, task_rows
from ledgerline.llm.tokens import HeldTokenizer

TIERS = (512, 1024, 2048, 4096)
POOL_TOKENS = 1 << 20
STEP_TOKENS = 1 << 16
END = 2

PIECES = (
    "doc_id {id}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, sequence_tokens bigint, step_group bigint"
)

# A piece is (length, number of the document in the pool's order, start).


class TierPools:
    """Open pieces by tier, shortest first within a tier."""

    def __init__(self, tiers: tuple[int, ...]):
        self.tiers = tiers
        self.open: list[list[tuple[int, int, int]]] = [[] for _ in tiers]

    def add(self, piece: tuple[int, int, int]) -> None:
        tier = next(k for k, size in enumerate(self.tiers) if piece[0] <= size)
        insort(self.open[tier], piece)

    def take_fitting(self, gap: int, below: int) -> tuple[int, int, int] | None:
        """The largest piece of at most ``gap`` from the tiers up to ``below``."""
        for tier in range(below, -1, -1):
            at = bisect_right(self.open[tier], (gap + 1,)) - 1
            if at >= 0:
                return self.open[tier].pop(at)
        return None

    def take_any(self, below: int) -> tuple[int, int, int] | None:
        """The shortest piece; where none fits, it is the one to be cut."""
        for tier in range(below + 1):
            if self.open[tier]:
                return self.open[tier].pop(0)
        return None

    def rest(self) -> list[tuple[int, int, int]]:
        return [piece for tier in self.open for piece in tier]


def fill_windows(pieces: list, tiers: tuple[int, ...]) -> tuple[list, list]:
    """Full windows (size, pieces) and the pieces left over."""
    longest, windows, pools = tiers[-1], [], TierPools(tiers)
    for length, doc, start in pieces:
        while length > longest:
            windows.append((longest, [(longest, doc, start)]))
            start, length = start + longest, length - longest
        pools.add((length, doc, start))
    left = []
    for tier in range(len(tiers) - 1, -1, -1):
        while pools.open[tier]:
            window, gap = [pools.open[tier].pop()], tiers[tier]
            gap -= window[0][0]
            while gap:
                piece = pools.take_fitting(gap, tier)
                if piece is None:
                    piece = pools.take_any(tier)
                    if piece is None:
                        break
                    length, doc, start = piece
                    pools.add((length - gap, doc, start + gap))
                    piece = (gap, doc, start)
                window.append(piece)
                gap -= piece[0]
            if gap:
                left += window
            else:
                windows.append((tiers[tier], window))
    return windows, left


def cut_powers(pieces: list, longest: int) -> list:
    """Windows of powers of two that hold the pieces one after the other."""
    windows, todo = [], deque(sorted(pieces, key=lambda p: (p[1], p[2])))
    total = sum(p[0] for p in pieces)
    while total:
        size = min(longest, 1 << (total.bit_length() - 1))
        window, gap = [], size
        while gap:
            length, doc, start = todo.popleft()
            if length > gap:
                todo.appendleft((length - gap, doc, start + gap))
                length = gap
            window.append((length, doc, start))
            gap -= length
        windows.append((size, window))
        total -= size
    return windows


def step_groups(windows: list, step_tokens: int) -> list[int]:
    """Number of the step group of each window: equal lengths, balanced attention cost."""
    group, first = [0] * len(windows), 0
    by_size: dict[int, list[int]] = {}
    for k, (size, _) in enumerate(windows):
        by_size.setdefault(size, []).append(k)
    for size, members in sorted(by_size.items()):
        members.sort(key=lambda k: (-sum(p[0] * p[0] for p in windows[k][1]), k))
        n = -(-len(members) * size // step_tokens)
        for rank, k in enumerate(members):
            turn, at = divmod(rank, n)
            group[k] = first + (n - 1 - at if turn % 2 else at)
        first += n
    return group


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    tiers: tuple[int, ...] = TIERS,
    end: int = END,
    pool_tokens: int = POOL_TOKENS,
    step_tokens: int = STEP_TOKENS,
) -> DataFrame:
    """One row per piece of a document in a window.

    A document is its token ids and the id ``end``; every id lies in one piece. ``ids`` holds the
    piece's ids (little-endian, 32 bits), ``sequence_tokens`` the window's length, always a power of
    two or a tier, so nothing is padded. Null and empty texts are documents of the one id ``end``.
    Null ids and repeated rows are packed like others; an empty table gives no rows. Only the two
    named columns are read.
    """
    tiers = tuple(sorted(tiers))
    shared = docs.sparkSession.sparkContext.broadcast(HeldTokenizer(tokenizer_path))

    def run(parts):
        tokenizer = shared.value.made
        tail, base = np.array([end], dtype="<u4").tobytes(), TaskContext.get().partitionId() << 33
        held: dict[int, tuple] = {}  # number -> (id, ids as bytes)
        pieces, pooled, number, sequence, group = [], 0, 0, base, base

        def rows(windows):
            nonlocal sequence, group
            out = {k: [] for k in ("doc_id start length ids doc_tokens sequence_id offset sequence_tokens step_group").split()}
            groups = step_groups(windows, step_tokens)
            for (size, window), g in zip(windows, groups, strict=True):
                offset = 0
                for length, doc, start in window:
                    doc_id, data = held[doc]
                    for k, v in zip(
                        out,
                        (doc_id, start, length, data[4 * start : 4 * (start + length)], len(data) // 4, sequence, offset, size, group + g),
                        strict=True,
                    ):
                        out[k].append(v)
                    offset += length
                sequence += 1
            group += max(groups, default=-1) + 1
            return out

        for part in parts:
            encoded = tokenizer.encode_all(part.column("text").to_pylist())
            for doc_id, data in zip(part.column("doc_id").to_pylist(), encoded, strict=True):
                held[number] = (doc_id, data + tail)
                pieces.append((len(data) // 4 + 1, number, 0))
                pooled += len(data) // 4 + 1
                number += 1
                if pooled >= pool_tokens:
                    windows, pieces = fill_windows(pieces, tiers)
                    yield rows(windows)
                    held = {k: held[k] for k in {p[1] for p in pieces}}
                    pooled = sum(p[0] for p in pieces)
        windows, pieces = fill_windows(pieces, tiers)
        yield rows(windows + cut_powers(pieces, tiers[-1]))

    slim = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).cast("string").alias("text"))
    return task_rows(slim, PIECES.format(id=slim.schema["doc_id"].dataType.simpleString()), run, block_bytes=4 << 20)
