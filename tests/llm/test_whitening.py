"""Whitening against numpy's eigenvectors and exact integers."""

import math

import numpy as np
import pytest

pytest.importorskip("skyflux.llm")

from skyflux.llm import whitening as W  # noqa: E402

ROWS = "vec_id long, embedding array<float>, v int, id string, n long"


def test_leading_components_of_many_matrices():
    rnd = np.random.default_rng(1)
    split = np.zeros((30, 30))
    split[:10, :10], split[10:, 10:] = 2, np.eye(20) * 3
    cases = [np.cov(rnd.standard_normal((500, 64)).T), np.eye(40), np.diag(np.arange(40.)), split, np.cov(rnd.standard_normal((10, 64)).T),
             np.cov((rnd.standard_normal((900, 90)) * np.repeat([1e6, 1, 1e-3], 30)).T), np.ones((5, 5)), np.array([[2.]]),
             np.kron(np.eye(8), np.cov(rnd.standard_normal((100, 5)).T)), np.cov(rnd.standard_normal((300, 20)).T) * 1e-200]
    for v in cases:
        e, q = W.leading_components(v)
        want = np.linalg.eigvalsh(v)[::-1][:len(e)]
        assert len(e) == min(32, np.linalg.matrix_rank(v, tol=16 * len(v) * np.finfo(float).eps * want[0], hermitian=True))
        assert np.abs(e - want).max() <= 1e-13 * want[0] and np.all(np.diff(e) <= 1e-13 * want[0])
        assert np.abs(q @ q.T - np.eye(len(e))).max() < 1e-13
        assert np.abs(v @ q.T - q.T * e).max() < 1e-13 * want[0]
    assert len(W.leading_components(np.zeros((3, 3)))[0]) == 0


def test_sturm_counts_are_numbers_of_smaller_eigenvalues():
    rnd = np.random.default_rng(2)
    diag, off = rnd.standard_normal(20), rnd.standard_normal(19)
    off[7] = 0
    e = np.linalg.eigvalsh(np.diag(diag) + np.diag(off, 1) + np.diag(off, -1))
    at = np.linspace(-5, 5, 60)
    assert W.sturm_counts(diag, off, at).tolist() == [(e < x).sum() for x in at]


def table(spark, vectors):
    return spark.createDataFrame([(i, v, 1, "clash", 2) for i, v in vectors], ROWS)


def check(spark, vectors, components=32):
    ok = [(i, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for i, v in vectors
          if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    size = max({len(v) for _, v in ok}, key=lambda n: (sum(len(v) == n for _, v in ok), n))
    ok = [(i, v) for i, v in ok if len(v) == size]
    x = np.array([v for _, v in ok], dtype=object)
    n, s = len(x), x.sum(0)
    dev = [int(((n * r - s) ** 2).sum()) for r in x]
    y = np.array(x - x.sum(0) / n, dtype=float)
    cov = y.T @ y / n
    e = np.sort(np.linalg.eigvalsh(cov))[::-1]
    k = min(components, np.linalg.matrix_rank(cov, tol=16 * size * np.finfo(float).eps * e[0], hermitian=True))
    got = W.whiten(table(spark, vectors), components=components).toPandas()
    assert len(got) == n * k and set(got["n"]) == {n} and (got["identity_error"] <= 1e-4).all() and got["identity_error"].nunique() == 1
    assert sorted(zip(got["vec_id"].fillna(-1), got["deviation"])) == sorted((-1 if i is None else i, d) for (i, _), d in zip(ok, dev) for _ in range(k))
    for c, part in got.groupby("component"):
        assert np.allclose(part["explained"], e[c - 1] / np.trace(cov), rtol=1e-9)
    return got, y, cov, ok


def test_whiten_against_numpy(spark):
    rnd = np.random.default_rng(3)
    base = rnd.standard_normal((12, 40))
    rows = [(i, list(map(float, r))) for i, r in enumerate(rnd.standard_normal((300, 12)) @ base)]
    rows += [(300, None), (301, [None] * 40), (302, [math.nan] + [0.0] * 39), (303, [math.inf] + [0.0] * 39), (304, []), (305, [1.0, 2.0]),
             (306, [0.0] * 40), (None, [2.0] * 40), rows[4], rows[4]]
    got, y, cov, ok = check(spark, rows)
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    z = y @ q[:, :8] / np.sqrt(e[:8])
    for c in range(8):                                       # well apart: same numbers up to the sign
        mine = got[got["component"] == c + 1]
        want = {i: abs(v) for (i, _), v in zip(ok, z[:, c]) if i is not None}
        for i, w in zip(mine["vec_id"], mine["whitened"]):
            if not np.isnan(i):
                assert abs(abs(w) - want[int(i)]) < 1e-8
    check(spark, rows[:5])


def test_whiten_edges(spark):
    none = W.whiten(table(spark, []))
    assert none.count() == 0 and none.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert W.whiten(table(spark, [(1, [1.0, 2.0])])).count() == 0                       # one vector has no spread
    assert W.whiten(table(spark, [(1, [1.0, 2.0])] * 5)).count() == 0
    assert W.whiten(table(spark, [(1, []), (2, None)])).count() == 0
    big = W.whiten(table(spark, [(i, [float(2 ** 55) * (-1) ** i, float(i)]) for i in range(8)])).toPandas()
    assert big["deviation"].isna().all() and set(big["component"]) >= {1}               # exact, but beyond a long
    check(spark, [(i, [1e4 * (i % 3), float(i), 0.25 * i * i]) for i in range(50)], components=2)
