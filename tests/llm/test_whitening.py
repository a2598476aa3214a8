"""Operator 12: exact integers, refined eigenvectors of clustered matrices, whitening against numpy, odd rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ridemart.llm import whitening as W


def matrix(values, seed=1):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    q = q.astype(np.longdouble)
    for _ in range(4):  # orthogonal to extended precision
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    return (q * np.array(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize("values", [
    np.linspace(1, 9, 12), [5, 5, 5, 2, 2, 1, 0, 0], [3, 3 + 1e-7, 3 + 2e-7, 3 + 3e-7, 1, 0.5], [1, 1 - 1e-11, 1 - 2e-11, 0.1],
    [1e6, 1, 1e-6, 1e-6 + 1e-13], [7.0], np.r_[np.ones(40) + np.arange(40) * 1e-9, np.linspace(2, 3, 10)]])
def test_eigenvectors_to_double_precision(values):
    a, q = matrix(values)
    a = (a + a.T) / 2
    found, x = W.eigen(a)
    scale = max(values)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 1e-16 * scale * len(values)
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-16
    assert np.abs(a @ x - x * found).max() <= 1e-17 * scale * len(values)
    # separated eigenvalues have the planted vectors; how near depends on the gap only
    want = q[:, np.argsort(-np.array(values), kind="stable")]
    order = np.sort(values)[::-1]
    for i in range(len(values)):
        gap = min([abs(order[i] - order[j]) for j in range(len(values)) if j != i], default=scale) / scale
        if gap > 1e-12:
            assert 1 - abs(x[:, i] @ want[:, i]) <= (1e-18 * len(values) / gap) ** 2 + 1e-17, (i, gap)


def test_float32_vectors_alone_are_not_enough():
    a, _ = matrix([3, 3 + 1e-7, 3 + 2e-7, 1, 0.5])
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    values, x = W.eigen(a)
    assert np.abs(a @ rough - rough * np.diag(rough.T @ a @ rough)).max() > 1e-8
    assert np.abs(a @ x - x * values).max() < 1e-17


@pytest.mark.parametrize("bits", [3, 19, 25, 40, 46])
def test_gram_is_exact(bits):
    x = np.random.default_rng(bits).integers(-(1 << bits), 1 << bits, (9000 if bits < 20 else 50, 4))
    big = x.astype(object)
    assert (W.exact_gram(x) == big.T @ big).all()


def plain(vectors, k):
    x = np.floor(np.array(vectors, float) * 64) + 1_000_000
    y = x - x.mean(0)
    values, axes = np.linalg.eigh(y.T @ y / len(x))
    values, axes = values[::-1], axes[:, ::-1]
    ints = [[int(v) for v in r] for r in x]
    sums = [sum(c) for c in zip(*ints)]
    return y @ axes[:, :k] / np.sqrt(values[:k]), values / values.sum(), [sum((len(ints) * v - s) ** 2 for v, s in zip(r, sums)) for r in ints]


def test_whole_table(spark):
    rows = W.op12_embedding_whitening(spark, "/root/testdata/sf0.001").orderBy("vec_id", "component").collect()
    given = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    want, explained, deviation = plain([r.embedding for r in given], 32)
    got = np.array([r.whitened for r in rows]).reshape(len(given), 32)
    sign = np.sign((got * want).sum(0))
    assert np.abs(got - want * sign).max() < 1e-9
    assert np.allclose([r.explained for r in rows[:32]], explained[:32], rtol=1e-10)
    assert [r.deviation for r in rows[::32]] == deviation
    assert {r.component for r in rows} == set(range(1, 33)) and rows[0].n == len(given)
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-12
    again = W.op12_embedding_whitening(spark, "/root/testdata/sf0.001").orderBy("vec_id", "component").collect()
    assert rows == again


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    good = [(i, [float(v) for v in rng.standard_normal(3)]) for i in range(30)]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [math.nan, 0.0, 0.0]), (104, [math.inf, 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0])]
    rows = good + bad + [good[3], (None, [0.5, 0.5, 0.5]), (200, [0.0, 0.0, 0.0]), (201, [1e-300, -1e-300, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for c in ("x", "v", "d", "n", "whitened", "component"):
        df = df.withColumn(c, F.lit("clash"))
    done, model = W.whiten(df)
    got = {(r.vec_id, r.deviation): r.whitened for r in done.collect()}
    kept = [r for r in rows if r[0] not in range(100, 107)]
    assert model["n"] == done.count() == len(kept)
    want, _, deviation = plain([v for _, v in kept], 3)
    sign = np.sign(sum(np.array(got[i, s]) * w for (i, _), s, w in zip(kept, deviation, want)))
    for (i, _), s, w in zip(kept, deviation, want):
        assert np.abs(np.array(got[i, s]) - w * sign).max() < 1e-9


def test_no_variance_empty_and_huge(spark):
    schema = "vec_id long, embedding array<float>"
    done, model = W.whiten(spark.createDataFrame([], schema))
    assert done.count() == 0 and model["n"] == 0
    done, model = W.whiten(spark.createDataFrame([(1, [0.5, 1.5]), (2, [0.5, 1.5])], schema))
    assert [(r.deviation, r.whitened) for r in done.collect()] == [(0, [0.0, 0.0])] * 2
    assert model["identity_error"] == 0.0 and model["explained"] == [0.0, 0.0]
    # one dimension varies: the second component has no variance
    done, model = W.whiten(spark.createDataFrame([(i, [float(i), 1.0]) for i in range(9)], schema))
    assert model["identity_error"] < 1e-12 and {r.whitened[1] for r in done.collect()} == {0.0}
    far = spark.createDataFrame([(i, [2.0 ** 39 * (-1) ** i, float(i)]) for i in range(8)], "vec_id long, embedding array<double>")
    done, model = W.whiten(far)
    assert model["identity_error"] < 1e-6 and {r.deviation for r in done.collect()} == {None}
