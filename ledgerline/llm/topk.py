"""Exact top-k search by inner product, score at a time.

Vectors are indexed in blocks. A block's postings are kept in segments of one quantised impact, dimension
and sign, a list of vectors each. A group of queries adds the segments up by descending impact, for all
vectors of the block side by side. At fixed shares of the postings the open part of a score is bounded: by
Cauchy-Schwarz over short runs of dimensions, between the query and what the segments so far leave of
the vector. The best vectors so far are scored exactly, and their least score is what a vector must still be
able to reach. A query stops only when this leaves few vectors possible; those are rescored exactly. A
query without such a proof goes through all segments.

Queries are a stated set. They are blocks too; a task holds some index blocks while all query blocks
stream past, and only the k best of a pair of blocks go on.
"""

from __future__ import annotations

import pickle

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.blocks import quoted, task_rows

INDEX_ROWS = 8192
QUERY_ROWS = 1024
SLOT_BLOCKS = 2  # index blocks that a task holds, on average
LEVELS = 64  # quantised impacts, at most
CHECKS = 8  # bounds of a block, at equal shares of its postings
RUN = 8  # dimensions that share a norm in the bound
GROUP = 64  # queries that add up segments together
DENSE = 32  # segments that fill at least one cell in so many are added by a matrix product, not list by list
OPEN_SHARE = 0.02  # of a block's vectors may be rescored


def _narrow(values: np.ndarray) -> np.ndarray:
    """In the smallest integer type that holds all values."""
    for kind in (np.int8, np.int16, np.int32):
        if not values.size or (values.min() >= np.iinfo(kind).min and values.max() <= np.iinfo(kind).max):
            return values.astype(kind)
    return values


def _run_norms(rows: np.ndarray) -> np.ndarray:
    """Norm of each row over each run of dimensions."""
    return np.sqrt(np.add.reduceat(rows * rows, np.arange(0, rows.shape[1], RUN), axis=1))


def build_block(ids: np.ndarray, vectors: np.ndarray, k: int) -> dict:
    """Segments by descending impact, and at ``CHECKS`` of them the norms that they leave open.

    Equal vectors have equal scores, so they are one entry with its k + 1 smallest ids (one of them
    may be the query itself). Components of 0 have no posting.
    """
    order = np.lexsort((*vectors.T, ids))
    ids, vectors = ids[order], vectors[order]
    fresh = np.r_[True, (ids[1:] != ids[:-1]) | (vectors[1:] != vectors[:-1]).any(axis=1)]
    ids, vectors = ids[fresh], vectors[fresh]
    same_id = int(np.unique(ids, return_counts=True)[1].max())
    distinct, inverse = np.unique(vectors, axis=0, return_inverse=True)
    inverse = inverse.ravel()
    by = np.argsort(inverse, kind="stable")
    starts = np.searchsorted(inverse[by], np.arange(len(distinct)))
    place = np.arange(len(by)) - starts[inverse[by]]
    kept = by[place <= k]
    members = np.full((len(distinct), k + 1), -1, dtype=np.int64)
    has = np.zeros((len(distinct), k + 1), dtype=bool)
    members[inverse[kept], place[place <= k]] = ids[kept]
    has[inverse[kept], place[place <= k]] = True

    step = max(1, -(-int(np.abs(distinct).max()) // LEVELS))
    vector, dimension = np.nonzero(distinct)
    signed = distinct[vector, dimension]
    impact = np.abs(signed) // step
    order = np.lexsort((vector, signed < 0, dimension, -impact))
    vector, dimension, signed, impact = vector[order], dimension[order], signed[order], impact[order]
    value = np.sign(signed) * (impact * step + (step - 1) / 2)
    first = np.flatnonzero(np.r_[True, (dimension[1:] != dimension[:-1]) | (value[1:] != value[:-1])][: len(value)])
    ends = np.r_[first[1:], len(value)][: len(first)]
    checks, open_ = [], []
    rest, done = distinct.astype(np.float64), 0
    rounding = _run_norms(rest) * 1e-12 + 1e-6
    for share in range(1, CHECKS + 1):
        last = int(np.searchsorted(ends, -(-len(value) * share // CHECKS)))
        if last >= len(ends) or (checks and last == checks[-1]):
            continue
        rest[vector[done : ends[last]], dimension[done : ends[last]]] -= value[done : ends[last]]
        done = int(ends[last])
        checks.append(last)
        # A trifle above the norm, so that rounding of sums never makes a bound too small.
        open_.append(_run_norms(rest) * (1 + 1e-9) + rounding)
    return {
        "vectors": _narrow(distinct), "members": members, "has": has, "same_id": same_id,
        "posting": _narrow(vector), "ends": ends, "dimension": dimension[first], "value": value[first],
        "checks": checks, "open": open_,
    }


def _exact(vectors: np.ndarray, rows: np.ndarray, queries: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Inner products of pairs of a vector and a query, in integers."""
    return np.einsum("ij,ij->i", vectors[rows].astype(np.int64), queries[of])


def _possible(block: dict, queries: np.ndarray, k: int):
    """Query, entries that may be among its k best, and the postings processed until that was proved."""
    vectors, ends = block["vectors"], block["ends"]
    n = len(vectors)
    enough = min(n, (k + 1) * block["same_id"])  # entries that surely hold k ids besides the query's own
    few = max(4 * (k + 1), OPEN_SHARE * n)
    left, weights = np.arange(len(queries)), queries.T.astype(np.float64)
    norms = _run_norms(queries.astype(np.float64)).T
    score = np.zeros((n, len(queries)))
    least = np.full(len(queries), -np.inf)
    starts = np.r_[0, ends[:-1]][: len(ends)]
    at = 0
    for last, open_ in zip(block["checks"], block["open"], strict=True):
        first, at = at, last + 1
        postings = slice(starts[first], ends[last])
        if (ends[last] - starts[first]) * DENSE >= vectors.size:
            sizes = (ends - starts)[first:at]
            some = np.zeros(vectors.shape)
            some[block["posting"][postings], np.repeat(block["dimension"][first:at], sizes)] = np.repeat(block["value"][first:at], sizes)
            score += some @ weights
        else:
            for segment in range(first, at):
                score[block["posting"][starts[segment] : ends[segment]]] += block["value"][segment] * weights[block["dimension"][segment]]
        slack = open_ @ norms
        best = np.argpartition(score, n - enough, axis=0)[n - enough :]
        known = _exact(vectors, best.ravel(), queries, np.tile(left, enough)).reshape(best.shape)
        least = np.maximum(least, known.min(axis=0))
        possible = score + slack >= least
        settled = possible.sum(axis=0) <= few
        if at == len(ends):
            settled[:] = True
        for q in np.flatnonzero(settled):
            yield left[q], np.flatnonzero(possible[:, q]), int(ends[last])
        go = ~settled
        if not go.any():
            return
        if settled.any():
            left, weights, norms, score, least = left[go], weights[:, go], norms[:, go], score[:, go], least[go]
    for q in left:  # no postings at all: every score is 0
        yield q, np.arange(n), len(block["posting"])


def search_block(block: dict, query_ids: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Query row, vector id and score of each query's k best in the block (ties: smaller ids); and
    for each query the share of the block's postings that was processed."""
    vectors, dims = block["vectors"], block["vectors"].shape[1]
    # Dimensions that only the queries or only the block have add nothing.
    asked = np.zeros((len(queries), dims), dtype=np.int64)
    asked[:, : min(queries.shape[1], dims)] = queries[:, :dims]
    enough = (k + 1) * block["same_id"]
    share = np.zeros(len(queries))
    out_q, out_id, out_score = [], [], []
    for at in range(0, len(queries), GROUP):
        group = asked[at : at + GROUP]
        for which, rows, processed in _possible(block, group, k):
            q = at + which
            share[q] = processed / max(1, len(block["posting"]))
            got = _exact(vectors, rows, group, np.full(len(rows), which))
            if len(got) > enough:
                best = np.flatnonzero(got >= np.partition(got, len(got) - enough)[len(got) - enough])
                rows, got = rows[best], got[best]
            entry, slot = np.nonzero(block["has"][rows] & (block["members"][rows] != query_ids[q]))
            ids, scores = block["members"][rows[entry], slot], got[entry]
            by = np.lexsort((-scores, ids))
            ids, scores = ids[by], scores[by]
            best = np.r_[True, ids[1:] != ids[:-1]][: len(ids)]
            ids, scores = ids[best], scores[best]
            top = np.lexsort((ids, -scores))[:k]
            out_q.append(np.full(len(top), q))
            out_id.append(ids[top])
            out_score.append(scores[top])
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_score), share


def _matrix(rows: list[list[int]]) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros, which add nothing to an inner product."""
    dims = max(map(len, rows))
    if all(len(r) == dims for r in rows):
        return np.array(rows, dtype=np.int64).reshape(len(rows), dims)
    made = np.zeros((len(rows), dims), dtype=np.int64)
    for k, r in enumerate(rows):
        made[k, : len(r)] = r
    return made


def _to_blocks(size: int, make):
    def run(parts):
        base, number, ids, rows = TaskContext.get().partitionId() << 32, 0, [], []
        for part in parts:
            ids += part.column("id").to_pylist()
            rows += part.column("vector").to_pylist()
            while len(ids) >= size:
                yield {"block": [base + number], "data": [pickle.dumps(make(np.array(ids[:size], dtype=np.int64), _matrix(rows[:size])))]}
                ids, rows, number = ids[size:], rows[size:], number + 1
        if ids:
            yield {"block": [base + number], "data": [pickle.dumps(make(np.array(ids, dtype=np.int64), _matrix(rows)))]}

    return run


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id`` and ``vector`` of floor(scale * x); rows without an id or with null, NaN or infinite parts go."""
    vector = F.col(quoted(vector_col))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        rows.where(F.col(quoted(id_col)).isNotNull() & vector.isNotNull() & ~bad)
        .select(F.col(quoted(id_col)).cast("bigint").alias("id"), F.transform(vector, lambda x: F.floor(x.cast("double") * scale)).alias("vector"))
        .where(F.size("vector") > 0)
    )


def top_k(
    rows: DataFrame,
    is_query,
    folder: str,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    scale: int = 256,
) -> DataFrame:
    """The k rows with the largest integer inner product for each query row, its own id left out.

    Columns ``query_id``, ``rank`` (from 1), ``vec_id``, ``score``; ties go to the smaller id, fewer
    rows than k give all. ``is_query`` is a condition on ``id``. Rows without an id or with a vector
    that is null, empty or holds null or non-finite parts take no part. Rows that repeat an id are one
    query and one candidate, with the best score of their vectors. The index is written below
    ``folder``.
    """
    spark = rows.sparkSession
    vectors = integer_vectors(rows, id_col, vector_col, scale)
    task_rows(vectors, "block bigint, data binary", _to_blocks(INDEX_ROWS, lambda i, v: build_block(i, v, k))).write.mode("overwrite").parquet(f"{folder}/index")
    index = spark.read.schema("block bigint, data binary").parquet(f"{folder}/index")
    slots = max(1, -(-index.count() // SLOT_BLOCKS))
    asked = vectors.where(is_query).distinct()
    asked = asked.repartition(max(1, -(-asked.count() // QUERY_ROWS)))
    queries = task_rows(asked, "block bigint, data binary", _to_blocks(QUERY_ROWS, lambda i, v: (i, _narrow(v))))
    # Each query block goes once to every slot of index blocks; rows don't meet, blocks do.
    every = F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot")
    sent = queries.select(every, F.lit(True).alias("is_query"), "data")
    held = index.select(F.pmod(F.xxhash64("block"), F.lit(slots)).cast("int").alias("slot"), F.lit(False).alias("is_query"), "data")

    def run(parts):
        slot, index_blocks = None, []
        for part in parts:
            for at, is_asked, data in zip(*(part.column(c).to_pylist() for c in ("slot", "is_query", "data")), strict=True):
                if at != slot:
                    slot, index_blocks = at, []
                if not is_asked:
                    index_blocks.append(pickle.loads(data))
                    continue
                ids, asked = pickle.loads(data)
                for block in index_blocks:
                    q, found, score, _ = search_block(block, ids, asked, k)
                    yield {"query_id": ids[q], "vec_id": found, "score": score}

    met = held.unionByName(sent).repartition(slots, "slot").sortWithinPartitions("slot", "is_query")
    best = task_rows(met, "query_id bigint, vec_id bigint, score bigint", run, 1)
    best = best.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
