"""Whitening against a direct covariance and a library eigenvalue solver."""
import math
import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from estuary.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, label int, x string, n string, component string, i string"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "e", "e", "e", "e") for i, v in rows], SCHEMA)


def gaussian(n, d, seed):
    rng = np.random.default_rng(seed)
    mix = rng.normal(size=(d, d)) * np.linspace(0.1, 2.0, d)
    return (rng.normal(size=(n, d)) @ mix).astype(np.float32).tolist()


def plain(rows, k=16):
    """Fit by definition: exact rational mean and covariance, numpy's solver."""
    kept = [(i, [math.floor(float(c) * 64) + 1_000_000 for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    s = [sum(x[j] for x in fit) for j in range(d)]
    y = np.array([[float(Fraction(n * x[j] - s[j], n)) for j in range(d)] for x in fit])
    v = y.T @ y / n
    e, q = np.linalg.eigh(v)
    e, q = e[::-1][:k], q[:, ::-1][:, :k]
    dev = {i: sum((n * a - b) ** 2 for a, b in zip(x, s)) for i, x in kept}
    white = {i: np.array([float(Fraction(n * a - b, n)) for a, b in zip(x, s)]) @ q / np.sqrt(e) for i, x in kept}
    return n, dev, white, e / np.trace(v)


def by_row(out):
    got = defaultdict(dict)
    for r in out:
        got[r.vec_id][r.component] = r
    return got


def test_whitening_matches_the_definition(spark):
    vectors = gaussian(300, 24, 3)
    rows = list(enumerate(vectors)) + [(900 + i, vectors[7]) for i in range(120)]  # a hot vector
    odd = [(1, None), (2, []), (3, [1.0] * 23 + [None]), (4, [1.0] * 23 + [float("nan")]), (5, [float("inf")] * 24),
           (6, [1.0] * 5), (8, [1e30] * 24)]
    out = whitening.whiten(table_of(spark, rows + [(10_000 + i, v) for i, v in odd])).collect()
    n, dev, white, explained = plain(rows)
    got = by_row(out)
    assert set(got) == {i for i, _ in rows} and all(len(v) == 16 for v in got.values())
    signs = np.array([np.sign(got[0][c + 1].whitened * white[0][c]) for c in range(16)])
    for i, parts in got.items():
        w = np.array([parts[c + 1].whitened for c in range(16)])
        assert np.allclose(w * signs, white[i], atol=1e-9)
        assert {p.deviation for p in parts.values()} == {dev[i]}
        assert np.allclose([parts[c + 1].explained for c in range(16)], explained, rtol=1e-9)
    assert {r.n for r in out} == {n}
    assert max(r.identity_error for r in out) < 1e-9


def test_repeated_and_null_ids_and_doubles(spark):
    rng = random.Random(2)
    rows = [(None if i % 5 == 0 else 7, [rng.gauss(0, 1) for _ in range(3)]) for i in range(40)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    out = whitening.whiten(df, components=2).collect()
    assert len(out) == 80 and sum(r.vec_id is None for r in out) == 16
    assert {r.component for r in out} == {1, 2}


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_no_variance_gives_no_rows(spark, rows):
    assert whitening.whiten(table_of(spark, rows)).collect() == []


def test_constant_dimension_and_deviation_beyond_a_long(spark):
    rows = [(i, [float(i), 5.0, -2.0 * i]) for i in range(10)]
    out = whitening.whiten(table_of(spark, rows)).collect()
    assert {r.component for r in out} == {1}  # two dimensions follow one another, one is constant
    assert all(abs(r.explained - 1) < 1e-12 for r in out)
    far = [(i, [float(i << 30), 1.0]) for i in range(9)]
    assert {r.deviation is None for r in whitening.whiten(table_of(spark, far)).collect()} == {True, False}


@pytest.mark.parametrize("values", [
    [3.0, 1.0, 0.2, 0.1], [1.0] * 5, [2.0, 2.0, 2.0, 1.0, 1.0], [1e8, 1.0, 1e-6], [1.0, 1.0 - 1e-9, 1e-3, 0.0], [0.0, 0.0],
    list(np.geomspace(1e4, 1e-4, 50)), [5.0] + [1.0] * 30 + [0.0] * 9])
def test_divide_and_conquer(values):
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(d).normal(size=(d, d)))[0]
    v = (q * np.array(values)) @ q.T
    v = (v + v.T) / 2
    e, u = whitening.eigenvectors(v)
    size = max(max(values), 1e-300)
    assert np.allclose(e, np.linalg.eigvalsh(v)[::-1], atol=4e-15 * d * size)
    assert np.abs(u.T @ u - np.eye(d)).max() < 1e-13
    assert np.abs(v @ u - u * e).max() < 2e-14 * d * size


def test_polar_factor():
    a = np.random.default_rng(4).normal(size=(30, 30))
    a = a + a.T
    w, q = np.linalg.eigh(a)
    assert np.abs(whitening.polar(a) - (q * np.sign(w)) @ q.T).max() < 1e-12
