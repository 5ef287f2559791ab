"""Embedding whitening on the leading components of the covariance, found by spectrum slicing.

Spark adds up exact sums of the vectors in whole numbers, then the covariance of the centred vectors;
only these dims x dims sums reach the driver. There the inertia of V - shift (the signs of the pivots of
its LDL^T factors, Sylvester's law) counts the eigenvalues above a shift. Bisection on that count isolates
each leading eigenvalue, Rayleigh quotient iteration converges in its interval, and the counts just
below and above the result certify its number. Eigenvalues too close to separate are taken as one group,
whose space is found by inverse iteration.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.blocks import quoted, task_rows

SCALE = 1024
SHIFT = 100_000
COMPONENTS = 8
# Entries from here on do not become exact whole numbers; such a vector counts as one with a non-finite entry.
LIMIT = 2.0**53 / SCALE / 2
BLOCK_BYTES = 4 << 20

_PIVOT = (1 + math.sqrt(17)) / 8  # of Bunch and Kaufman: bounds the growth of 1x1 and 2x2 pivots alike
_EPS = np.finfo(float).eps


def count_above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix above ``shift``: the positive pivots of LDL^T of matrix - shift."""
    a = matrix - shift * np.eye(len(matrix))
    above, k, n = 0, 0, len(a)
    while k < n:
        column = np.abs(a[k + 1 :, k])
        largest = column.max(initial=0.0)
        step, pivot = 1, k
        if max(abs(a[k, k]), largest) == 0:
            k += 1
            continue
        if abs(a[k, k]) < _PIVOT * largest:
            r = k + 1 + int(column.argmax())
            across = np.abs(a[r, k:]).copy()
            across[r - k] = 0
            widest = across.max()
            if abs(a[k, k]) * widest < _PIVOT * largest**2:
                pivot = r
                step = 1 if abs(a[r, r]) >= _PIVOT * widest else 2
        at = k + step - 1
        if pivot != at:
            a[[at, pivot]] = a[[pivot, at]]
            a[:, [at, pivot]] = a[:, [pivot, at]]
        block, rest = a[k : k + step, k : k + step], a[k + step :, k : k + step]
        if step == 1:
            above += int(block[0, 0] > 0)
            a[k + 1 :, k + 1 :] -= np.outer(rest[:, 0], rest[:, 0] / block[0, 0])
        else:
            # Such a block has one eigenvalue of either sign.
            above += 1
            a[k + 2 :, k + 2 :] -= rest @ np.linalg.solve(block, rest.T)
        k += step
    return above


def _solve(matrix: np.ndarray, shift: float, right: np.ndarray) -> np.ndarray:
    """(matrix - shift)^-1 right; a shift that is an eigenvalue is moved by a rounding error."""
    size = max(np.abs(matrix).max(), np.finfo(float).tiny)
    for nudge in (0.0, 4 * _EPS, 64 * _EPS, 1024 * _EPS):
        try:
            out = np.linalg.solve(matrix - (shift + nudge * size) * np.eye(len(matrix)), right)
        except np.linalg.LinAlgError:
            continue
        if np.isfinite(out).all():
            return out
    return right


def _rayleigh(matrix, low, high, within, random) -> tuple[float, np.ndarray] | None:
    """The eigenpair of the only eigenvalue in (low, high); None if the iteration leaves the interval."""
    x = _solve(matrix, (low + high) / 2, random.standard_normal(len(matrix)))
    x = _solve(matrix, (low + high) / 2, x / np.linalg.norm(x))
    x /= np.linalg.norm(x)
    best = None
    for _ in range(30):
        rate = float(x @ matrix @ x)
        error = float(np.linalg.norm(matrix @ x - rate * x))
        if best is not None and error >= best[0]:
            break
        best = (error, rate, x)
        if error <= within * _EPS:
            break
        x = _solve(matrix, rate, x)
        x /= np.linalg.norm(x)
    error, rate, x = best
    return (rate, x) if low <= rate <= high and error <= 1e3 * within else None


def _isolated(matrix: np.ndarray, wanted: int, finest: float) -> list[tuple[float, float, int, int]]:
    """Intervals (low, high, first, last): they hold the eigenvalues numbered first to last from 1.

    They cover the ``wanted`` largest; each holds one, or several within ``finest``.
    """
    reach = float(np.abs(matrix).sum(axis=1).max(initial=0.0)) * (1 + 1e-12) + finest
    todo, done = [(-reach, reach, 0, len(matrix))], []
    while todo:
        low, high, above_high, above_low = todo.pop()
        if above_high >= wanted or above_low == above_high:
            continue
        if above_low - above_high == 1 or high - low <= finest:
            done.append((low, high, above_high + 1, above_low))
            continue
        middle = (low + high) / 2
        above = min(max(count_above(matrix, middle), above_high), above_low)
        todo += [(low, middle, above, above_low), (middle, high, above_high, above)]
    return sorted(done, key=lambda i: i[2])


def _numbered(matrix: np.ndarray, value: float, number: int, finest: float) -> bool:
    """Whether the counts beside ``value`` prove it to be the eigenvalue of that number."""
    return count_above(matrix, value - finest) >= number > count_above(matrix, value + finest)


@dataclass
class Spectrum:
    values: np.ndarray  # falling
    vectors: np.ndarray  # one column each
    certified: list[bool]  # whether the counts below and above the value prove its number


def leading_spectrum(matrix: np.ndarray, wanted: int) -> Spectrum:
    """The ``wanted`` largest eigenvalues of a covariance with unit eigenvectors.

    Eigenvalues that rounding cannot tell from 0 are left out, so there may be fewer.
    """
    n = len(matrix)
    norm = float(np.linalg.norm(matrix))
    if n == 0 or norm == 0:
        return Spectrum(np.zeros(0), np.zeros((n, 0)), [])
    random = np.random.default_rng(7)
    finest = 64 * _EPS * norm
    values, vectors = [], []
    for low, high, first, last in _isolated(matrix, wanted, finest):
        found = None
        while last == first and found is None and high - low > finest:
            found = _rayleigh(matrix, low, high, norm * 1e-14, random)
            if found and not _numbered(matrix, found[0], first, finest):
                found = None  # a neighbour's, from just outside the interval
            if found is None:
                middle = (low + high) / 2
                low, high = (middle, high) if count_above(matrix, middle) >= first else (low, middle)
        if found:
            values.append(found[0])
            vectors.append(found[1])
            continue
        # The space of the whole group, then its own axes.
        space = np.linalg.qr(random.standard_normal((n, last - first + 1)))[0]
        for _ in range(3):
            space = np.linalg.qr(_solve(matrix, (low + high) / 2, space))[0]
        inner, axes = np.linalg.eigh(space.T @ matrix @ space)
        values += list(inner[::-1])
        vectors += list((space @ axes[:, ::-1]).T)
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    basis, kept, certified = [], [], []
    for number, k in enumerate(order, 1):
        value, x = values[k], vectors[k]
        if value <= 16 * n * _EPS * norm:
            break
        for other in basis:  # neighbours that are close may lean on one another by rounding
            x = x - (other @ x) * other
        basis.append(x / np.linalg.norm(x))
        kept.append(value)
        certified.append(_numbered(matrix, value, number, finest))
    return Spectrum(np.array(kept), np.array(basis).reshape(len(kept), n).T, certified)


@dataclass
class Whitening:
    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    certified: list[bool]
    identity_error: float = 0.0


def usable(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``id`` and ``vector`` (doubles) of rows whose vectors take part."""
    vector = F.col(quoted(vector_col))
    slim = rows.select(F.col(quoted(id_col)).alias("id"), vector.cast("array<double>").alias("vector"))
    fits = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < LIMIT))
    return slim.where(F.col("vector").isNotNull() & (F.size("vector") > 0) & F.coalesce(fits, F.lit(False)))


def _whole(table: pa.Table) -> np.ndarray:
    """The block's vectors as whole numbers, a row each."""
    column = table.column("vector").combine_chunks()
    column = column if isinstance(column, pa.Array) else pa.concat_arrays(column.chunks)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return np.floor(SCALE * flat).astype(np.int64).reshape(len(column), -1) + SHIFT


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exact: in 64 bits where these are known to be enough, else in Python's integers."""
    largest = max(int(np.abs(x).max(initial=0)) * n, max(map(abs, sums), default=0))
    kind = np.int64 if largest < 1 << 61 else object
    return x.astype(kind) * n - np.array(sums, dtype=kind)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_deviations(x, n, sums) / n).astype(np.float64)


def _dims(vectors: DataFrame) -> int:
    """The commonest length of a vector; the longer one of two."""
    most = vectors.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).first()
    return most["dims"] if most else 0


def _sum_matrix(vectors: DataFrame, size: int, make) -> np.ndarray:
    """The sum over all blocks of the symmetric matrix that ``make`` returns for one."""
    upper = np.triu_indices(size)

    def run(parts):
        total = np.zeros((size, size))
        for part in parts:
            total += make(_whole(part))
        yield {"i": upper[0].tolist(), "j": upper[1].tolist(), "value": total[upper].tolist()}

    cells = task_rows(vectors.select("vector"), "i int, j int, value double", run, BLOCK_BYTES)
    out = np.zeros((size, size))
    for r in cells.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["value"]
    return out


def fit(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The leading components of all usable vectors of the commonest length.

    Four passes over the table; per task one row for each dimension or pair of dimensions leaves it.
    """
    vectors = usable(rows, id_col, vector_col)
    dims = _dims(vectors)
    vectors = vectors.where(F.size("vector") == dims)

    def add(parts):
        n, sums = 0, [0] * dims
        for part in parts:
            x = _whole(part)
            n += len(x)
            fits = int(np.abs(x).max(initial=0)) * len(x) < 1 << 62
            sums = [s + int(t) for s, t in zip(sums, x.sum(axis=0) if fits else x.astype(object).sum(axis=0), strict=True)]
        yield {"dim": list(range(dims)), "n": [n] * dims, "total": [str(s) for s in sums]}

    added = task_rows(vectors.select("vector"), "dim int, n long, total string", add, BLOCK_BYTES)
    added = added.groupBy("dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = sorted(added.collect())
    n = found[0]["n"] if found else 0
    if not n:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0, [])
    sums = [int(r["total"]) for r in found]

    def products(x):
        centred = _centred(x, n, sums)
        return centred.T @ centred

    covariance = _sum_matrix(vectors, dims, products) / n
    spectrum = leading_spectrum(covariance, min(components, dims))
    model = Whitening(n, sums, spectrum.values, spectrum.vectors, float(np.trace(covariance)), spectrum.certified)
    if len(model.values):
        # The covariance of the result as it is, from centred vectors like any other.
        factors = model.vectors / np.sqrt(model.values)

        def whitened_products(x):
            white = _centred(x, n, sums) @ factors
            return white.T @ white

        got = _sum_matrix(vectors, len(model.values), whitened_products) / n
        model.identity_error = float(np.abs(got - np.eye(len(got))).max())
    return model


def whiten(rows: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """One row per usable vector of the model's length and component: ``id``, ``component`` (from 1, by
    falling variance), ``n``, ``deviation`` (decimal(38,0): sum of squares of n * x - S, exact), ``whitened``,
    ``explained`` and ``identity_error``.

    x is floor(1024 * entry) + 100000. Vectors that are null, empty or hold null, non-finite or (beyond
    2^42) not exactly representable entries take no part, and none that is not of the commonest length. Repeated
    rows count each and are returned each; null ids stay null. Components whose variance rounding cannot tell
    from 0 do not exist, so equal vectors, a single one and an empty table give no rows.
    """
    vectors = usable(rows, id_col, vector_col).where(F.size("vector") == len(model.sums))
    k, n, sums = len(model.values), model.n, model.sums
    factors = model.vectors / np.sqrt(model.values)
    explained = [float(v) / model.trace for v in model.values]
    id_type = vectors.schema["id"].dataType.simpleString()

    def run(parts):
        for part in parts:
            x = _whole(part)
            away = _deviations(x, n, sums)
            if away.dtype == np.int64 and int(np.abs(away).max(initial=0)) ** 2 * x.shape[1] >= 1 << 63:
                away = away.astype(object)
            squares = (away * away).sum(axis=1)
            white = (away / n).astype(np.float64) @ factors
            yield {
                "id": part.column("id").combine_chunks().take(pa.array(np.repeat(np.arange(len(x)), k))),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), len(x)).tolist(),
                "deviation": [str(s) for s in squares for _ in range(k)],
                "whitened": white.ravel().tolist(),
            }

    out = task_rows(vectors, f"id {id_type}, component int, deviation string, whitened double", run, BLOCK_BYTES)
    if not k:
        out = out.limit(0)
    part = F.element_at(F.array(*[F.lit(e) for e in explained or [0.0]]), F.col("component"))
    return out.select(
        F.col("id").alias(id_col),
        "component",
        F.lit(n).cast("long").alias("n"),
        F.expr("try_cast(deviation as decimal(38,0))").alias("deviation"),
        "whitened",
        part.alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
