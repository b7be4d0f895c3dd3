"""Whitening against numpy on whole matrices, exact integers against Python's."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from formspark.llm import whiten


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def vectors(seed, n=300, d=6, offset=0.0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, d)) * np.arange(1, d + 1) + offset


def plain(v, scale=256):
    """(n, S, integer rows, covariance) over distinct rows, as Python integers and extended floats."""
    x = np.floor(scale * v).astype(np.int64).astype(object)
    fit = sorted({tuple(r) for r in x})
    n, s = len(fit), [sum(c) for c in zip(*fit, strict=True)]
    y = np.array(fit, object) * n - np.array(s, object)
    return n, s, x, (y.T @ y).astype(np.longdouble) / np.longdouble(n) ** 3


def check(got, v, w, tol=1e-9):
    n, s, x, cov = plain(v)
    values, vecs = np.linalg.eigh(cov.astype(np.float64))
    values, vecs = values[::-1], vecs[:, ::-1]
    assert w.n == n and w.sums == s
    k = len(w.values)
    assert np.allclose(w.values.astype(float), values[:k], rtol=1e-10)
    centred = (x - np.array([[a / n for a in s]], object)).astype(np.float64)
    for r in got:
        i = r["vec_id"]
        assert int(r["deviation"]) == sum(int(n * a - b) ** 2 for a, b in zip(x[i], s, strict=True))
        for j in range(k):
            e = vecs[:, j] * np.sign(vecs[:, j] @ w.vectors[:, j].astype(float))
            assert r["whitened"][j] == pytest.approx(centred[i] @ e / np.sqrt(values[j]), rel=tol, abs=tol)


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_same_as_numpy(spark, offset):
    v = vectors(1, offset=offset)
    v[200:] = v[7]  # a vector that a third of the rows share
    df = frame(spark, [(i, r.tolist()) for i, r in enumerate(v)]).repartition(5)
    w = whiten.fit(df)
    assert len(w.values) == 6 and w.error < 1e-10
    check(whiten.whiten(df, w).collect(), v, w)


def test_defined_cases(spark):
    v = vectors(2, 40, 3)
    rows = [(i, r.tolist()) for i, r in enumerate(v)]
    odd = [(90, None), (91, []), (92, [1.0, None, 2.0]), (93, [1.0, float("nan"), 2.0]), (94, [float("inf"), 0.0, 0.0]), (95, [1.0]), (95, [1.0, 2.0, 3.0, 4.0])]
    df = frame(spark, rows + odd).withColumn("x", F.lit(1)).withColumn("whitened", F.lit(2))
    w = whiten.fit(df, components=2)
    got = whiten.whiten(df, w)
    assert got.columns == ["vec_id", "whitened", "deviation"] and len(w.values) == 2
    assert sorted(r["vec_id"] for r in got.collect()) == list(range(40))
    twice = df.unionAll(df).unionAll(df.select(F.lit(None).cast("long").alias("vec_id"), "embedding", "x", "whitened"))
    again = whiten.fit(twice, components=2)
    assert again.n == w.n and again.sums == w.sums and np.allclose(again.values.astype(float), w.values.astype(float))
    assert whiten.whiten(twice, again).count() == 120


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        df = frame(spark, rows)
        assert whiten.fit(df) is None and whiten.whiten(df, None).count() == 0


def test_flat_directions_are_left_out(spark):
    v = vectors(3, 50, 2)
    df = frame(spark, [(i, [a, b, a, 5.0]) for i, (a, b) in enumerate(v.tolist())])
    w = whiten.fit(df)
    assert len(w.values) == 2 and w.error < 1e-10


def test_entries_too_large(spark):
    with pytest.raises(Exception, match="does not fit 64 bits"):
        whiten.fit(frame(spark, [(1, [1e30, 1.0]), (2, [0.0, 0.0])]))


def test_large_integers_stay_exact(spark):
    v = np.array([[1e9, -3.0], [-1e9, 5.0], [2e9, 8.0], [7.0, -1e12]])
    df = frame(spark, [(i, r.tolist()) for i, r in enumerate(v)])
    check(whiten.whiten(df, w := whiten.fit(df)).collect(), v, w, 1e-7)


def rotated(values, seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))
    q = q.astype(np.longdouble)
    for _ in range(3):  # orthonormal to extended precision
        q = q + q @ ((np.eye(len(q)) - q.T @ q) / 2)
    return (q * np.array(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize("values", [
    [9.0, 5.0, 2.0, 1.0],
    [3.0 + 1e-9, 3.0, 3.0 - 2e-9, 1.0, 0.5],           # closer than single precision tells apart
    [1.0, 1.0 - 1e-12, 1e-3, 1e-3 - 1e-13, 1e-6],
    [1e6, 1.0, 1.0 + 1e-7, 1e-4],
    list(np.linspace(1, 2, 40)) + [2 + 1e-8, 2 + 2e-8],
])
def test_refined_to_double_precision(values):
    a, q = rotated(values, 4)
    got, vecs = whiten.eigen(a)
    order = np.argsort(-np.array(values), kind="stable")
    assert np.allclose(got.astype(float), np.array(values)[order], rtol=1e-13, atol=1e-17 * max(values))
    gram = vecs.T @ vecs - np.eye(len(values))
    assert np.abs(gram).max() < 1e-16
    residual = np.abs(a @ vecs - vecs * got).max()
    assert residual < 1e-17 * max(values) * len(values)
    for j, o in enumerate(order):
        gap = min(abs(values[o] - v) for i, v in enumerate(values) if i != o)
        if gap > 1e-7 * max(values):
            assert abs(abs(float(vecs[:, j] @ q[:, o])) - 1) < 1e-12


def test_equal_eigenvalues():
    a, _ = rotated([2.0, 2.0, 2.0, 1.0, 1.0], 5)
    values, vecs = whiten.eigen(a)
    assert np.allclose(values.astype(float), [2, 2, 2, 1, 1])
    assert np.abs(vecs.T @ vecs - np.eye(5)).max() < 1e-16 and np.abs(a @ vecs - vecs * values).max() < 1e-16
    assert np.allclose(whiten.eigen(np.eye(3))[0].astype(float), 1)
