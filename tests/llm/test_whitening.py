"""Whitening against a dense eigenvalue decomposition."""

import numpy as np
import pytest

from fathomline.llm import whitening


def dense(ids, m, k):
    """For each id and component: n, deviation, whitened without sign, explained."""
    x = [[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in m]
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    c = np.array([[(n * a - b) / n for a, b in zip(v, s, strict=True)] for v in x])
    e, q = np.linalg.eigh(c.T @ c / n)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    return {(i, j + 1): (n, sum((n * a - b) ** 2 for a, b in zip(v, s, strict=True)), abs(y @ q[:, j]) / np.sqrt(e[j]), e[j] * n / (c * c).sum()) for i, v, y in zip(ids, x, c, strict=True) for j in range(len(e))}


def check(got, want):
    assert len(got) == len(want)
    for r in got:
        n, deviation, white, explained = want[r["vec_id"], r["component"]]
        assert (r["n"], r["deviation"]) == (n, deviation)
        assert abs(r["whitened"]) == pytest.approx(white, rel=1e-8, abs=1e-8) and r["explained"] == pytest.approx(explained, rel=1e-9)
        assert r["identity_error"] < 1e-9


@pytest.mark.parametrize(("dims", "k", "decay"), [(64, 32, 1.0), (300, 12, 3.0), (200, 32, 0.3), (5, 32, 1.0), (1, 3, 1.0)])
def test_eigenvectors(dims, k, decay):
    a = np.random.default_rng(dims).standard_normal((900, dims)) * np.exp(-decay * np.arange(dims) / dims)
    e, q, residual = whitening.largest(lambda u: a.T @ (a @ u), dims, k)
    value, vector = np.linalg.eigh(a.T @ a)
    k = min(k, dims)
    assert np.allclose(e, value[::-1][:k], rtol=1e-12)
    assert np.allclose(np.abs((q * vector[:, ::-1][:, :k]).sum(0)), 1, atol=1e-9)
    assert residual.max() < 1e-13 * e[0]


def test_equal_eigenvalues():
    a = np.diag([4.0] * 9 + [1.0] * 60 + [0.0] * 31)
    e, q, _ = whitening.largest(lambda u: a @ u, 100, 20)
    assert np.allclose(e, [4] * 9 + [1] * 11) and np.allclose(q.T @ q, np.eye(20))


def test_minres_solves_small_systems():
    r = np.random.default_rng(3)
    a = r.standard_normal((8, 8))
    a, b = a + a.T, r.standard_normal((8, 3))
    assert np.allclose(a @ whitening.minres(lambda u: a @ u, b, 8), b)
    one = whitening.minres(lambda u: a @ u, b, 1)
    assert np.allclose(one, b * ((b * (a @ b)).sum(0) / ((a @ b) ** 2).sum(0)))


def test_rows(spark):
    r = np.random.default_rng(7)
    m = (r.standard_normal((400, 40)) @ r.standard_normal((40, 40)) * 0.3).astype(np.float32)
    m[300:] = m[0]
    ids = list(range(400))
    bad = [(-1, None), (-2, []), (-3, [None] * 40), (-4, [float("nan")] * 40), (-5, [float("inf")] * 40), (-6, [1e30] * 40)]
    df = spark.createDataFrame([(i, v.tolist(), 0.0) for i, v in zip(ids, m, strict=True)] + [(*b, 0.0) for b in bad], "vec_id long, embedding array<float>, whitened double").repartition(5)
    check(whitening.whiten(df).collect(), dense(ids, m.astype(float).tolist(), 32))
    check(whitening.whiten(df, k=3).collect(), dense(ids, m.astype(float).tolist(), 3))
    assert whitening.whiten(df.limit(0)).count() == 0


def test_edges(spark):
    two = [(0, [1.0, 2.0]), (1, [2.0, 2.5]), (1, [0.0, 7.0]), (None, [3.0, 3.0])]
    others = [(10, [5.0, 5.0, 5.0]), (11, [5.0, 5.0, 6.0]), (20, [1.0] * 4)]
    got = whitening.whiten(spark.createDataFrame(two + others, "vec_id long, embedding array<double>")).collect()
    by = {}
    for x in got:
        by.setdefault((x["vec_id"], x["component"]), []).append(x)
    assert len(by[1, 1]) == 2 and len(by[None, 2]) == 1  # repeated and null ids count each for itself
    assert [x["n"] for x in by[10, 1]] == [2] and [x["n"] for x in by[0, 1]] == [4]
    assert abs(by[10, 1][0]["whitened"]) == pytest.approx(1) and by[10, 2][0]["whitened"] is None and by[10, 2][0]["explained"] == 0
    alone = by[20, 1][0]
    assert (alone["n"], alone["deviation"], alone["whitened"], alone["explained"], alone["identity_error"]) == (1, 0, None, None, None)
    large = whitening.whiten(spark.createDataFrame([(0, [1e8]), (1, [-1e8]), (2, [4e9])], "vec_id long, embedding array<double>")).collect()
    exact = [64 * 10**8 + 10**6, -64 * 10**8 + 10**6, 256 * 10**9 + 10**6]
    want = [(3 * v - sum(exact)) ** 2 for v in exact]
    assert [x["deviation"] for x in sorted(large, key=lambda x: x["vec_id"])] == [w if w < 2**63 else None for w in want]
