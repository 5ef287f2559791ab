"""Whitening against dense eigenvalues and exact integers."""

import math
import random

import numpy as np
import pytest
from conftest import SF

from ledgerline.llm import queries, whitening


def covariances():
    rng = np.random.default_rng(5)
    for n in (1, 2, 7, 40):
        wide = rng.standard_normal((n + 4, n))
        yield wide.T @ wide
        yield np.diag(np.full(n, 3.0))
        yield np.outer(wide[0], wide[0])
        yield (wide * np.geomspace(1e4, 1e-5, n)).T @ (wide * np.geomspace(1e4, 1e-5, n))
        yield np.zeros((n, n))


@pytest.mark.parametrize("matrix", list(covariances()), ids=lambda m: str(len(m)))
def test_spectrum(matrix):
    values = np.linalg.eigvalsh(matrix)[::-1]
    size = max(abs(values).max(), 1e-300)
    for shift in np.r_[np.random.default_rng(1).uniform(values[-1] - 1, values[0] + 1, 20), (values[:-1] + values[1:]) / 2]:
        if np.abs(values - shift).min() > 1e-10 * size:
            assert whitening.count_above(matrix, shift) == (values > shift).sum()
    found = whitening.leading_spectrum(matrix, 8)
    k = len(found.values)
    assert k == min(8, (values > 1e-12 * size).sum())
    assert np.allclose(found.values, values[:k], rtol=0, atol=1e-12 * size)
    assert np.allclose(found.vectors.T @ found.vectors, np.eye(k), atol=1e-10)
    assert np.allclose(matrix @ found.vectors, found.vectors * found.values, atol=1e-11 * size)
    assert all(found.certified)


def brute(vectors):
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for v in vectors], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    away = x * n - sums
    centred = (away / n).astype(float)
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    return n, (away * away).sum(axis=1), centred, values[::-1], axes[:, ::-1], np.trace(covariance)


def check(rows, got, dims):
    usable = [r for r in rows if r[1] is not None and len(r[1]) == dims and all(c is not None and math.isfinite(c) and abs(c) < whitening.LIMIT for c in r[1])]
    n, deviations, centred, values, axes, trace = brute([r[1] for r in usable])
    k = min(8, (values > 1e-11 * values[0]).sum())
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    assert len(got) == len(usable) * k
    signs = {}
    for place, (vec_id, *_) in enumerate(usable):
        for c in range(1, k + 1):
            found = by[vec_id][c]
            assert {int(r.deviation) for r in found} == {int(deviations[j]) for j, u in enumerate(usable) if u[0] == vec_id}
            assert all(r.n == n and abs(r.explained - values[c - 1] / trace) <= 1e-9 for r in found)
            assert all(r.identity_error <= 1e-4 for r in found)
            want = centred[place] @ axes[:, c - 1] / math.sqrt(values[c - 1])
            if len(found) == 1 and abs(want) > 1e-3:
                signs.setdefault(c, set()).add(np.sign(found[0].whitened * want))
                assert abs(abs(found[0].whitened) - abs(want)) < 1e-6
    assert all(len(s) == 1 for s in signs.values())


def test_whitening(spark):
    rng = random.Random(2)
    rows = [(k, [rng.gauss(k % 3, 1 + j) for j in range(10)], "x", 7) for k in range(120)]
    rows += [(200, None, "x", 1), (201, [], "x", 1), (202, [1.0] * 9, "x", 1), (203, [None] + [1.0] * 9, "x", 1), (None, [2.0] * 10, "x", 1)]
    rows += [(204, [float("nan")] + [1.0] * 9, "x", 1), (205, [float("-inf")] + [1.0] * 9, "x", 1), (206, [3e38] + [1.0] * 9, "x", 1)]
    rows += [rows[5], rows[5], (7, [1.5] * 10, "x", 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, vector string, component int").repartition(3)
    check(rows, whitening.whiten(frame, whitening.fit(frame)).collect(), 10)


def test_large_values_are_exact(spark):
    rng = random.Random(3)
    rows = [(k, [float(np.float32(rng.uniform(-1e11, 1e11))) for _ in range(3)]) for k in range(40)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    check(rows, whitening.whiten(frame, whitening.fit(frame)).collect(), 3)


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_nothing_varies(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    out = whitening.whiten(frame, whitening.fit(frame))
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert out.count() == 0


def test_registered_query(spark):
    table = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = queries.QUERIES["op13_whitening"](spark, SF)
    assert dict(got.dtypes)["deviation"] == "bigint"
    check([tuple(r) for r in table], got.collect(), len(table[0].embedding))
