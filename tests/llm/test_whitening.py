import math

import numpy as np
import pytest

from folioscope.llm import whitening

SCHEMA = "vec_id bigint, embedding array<float>, n string, vector string"


def fitted(vectors):
    """Covariance, eigenvalues and exact deviations by numpy."""
    x = np.floor(1024 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 100000
    n, sums = len(x), x.sum(axis=0)
    y = x - sums / n
    v = y.T @ y / n
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return v, np.sort(np.linalg.eigvalsh(v))[::-1], y, deviation


def check(spark, vectors, others=(), components=8):
    rows = [(i, list(map(float, v)), "clash", None) for i, v in enumerate(vectors)]
    rows += [(1000 + i, v, None, None) for i, v in enumerate(others)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = whitening.whiten(docs, components=components)
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    found = {(r.vec_id, r.component): r for r in got.collect()}
    v, values, y, deviation = fitted(vectors)
    k = min(components, int((values > values[0] * 1e-9).sum()))
    assert set(found) == {(i, c) for i in range(len(vectors)) for c in range(1, k + 1)}
    white = np.array([[found[i, c].whitened for c in range(1, k + 1)] for i in range(len(vectors))])
    for (i, c), r in found.items():
        assert r.n == len(vectors) and r.deviation == deviation[i]
        assert r.explained == pytest.approx(values[c - 1] / np.trace(v), rel=1e-9)
        assert r.identity_error < 1e-6
    # the rows of a component are the projections on one unit eigenvector
    direction = np.linalg.lstsq(y, white * np.sqrt(values[:k]), rcond=None)[0] if len(y) > len(v) else None
    if direction is not None:
        assert np.allclose(np.linalg.norm(direction, axis=0), 1, atol=1e-8)
        assert np.abs(v @ direction - direction * values[:k]).max() < 1e-9 * values[0]
    assert np.allclose(white.T @ white / len(white), np.eye(k), atol=1e-6)


def test_equals_numpy(spark):
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(300, 24)) @ rng.normal(size=(24, 24)) / 5
    odd = [None, [], [None] * 24, [1.0] * 23 + [math.nan], [1.0] * 23 + [math.inf], [1e30] * 24]
    check(spark, vectors.tolist() + vectors[:3].tolist(), odd)


def test_close_and_equal_eigenvalues(spark):
    """An orthogonal design has equal eigenvalues; two of them are moved by a hair."""
    base = np.vstack([np.eye(12), -np.eye(12)]) * 3
    base[[0, 12], 0] *= 1.002
    check(spark, np.tile(base, (4, 1)))


def test_small_and_flat(spark):
    rng = np.random.default_rng(1)
    check(spark, rng.normal(size=(40, 1)))
    check(spark, rng.normal(size=(40, 3)))
    flat = np.hstack([rng.normal(size=(50, 2)), np.ones((50, 5))])
    check(spark, flat)
    check(spark, rng.normal(size=(4, 10)))


def test_nothing_to_whiten(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).collect() == []
    same = spark.createDataFrame([(1, [1.0, 2.0], None, None)] * 3, SCHEMA)
    assert whitening.whiten(same).collect() == []


def test_lengths_are_whitened_by_themselves(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=2 + i % 2).tolist(), None, None) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == 20 * 2 + 20 * 3 and {r.n for r in got} == {20}


def test_inertia_counts():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 30):
        a = rng.normal(size=(n, n))
        a = a + a.T
        np.fill_diagonal(a, 0)  # pivots of two rows
        values = np.linalg.eigvalsh(a)
        for shift in (-1.0, 0.0, 0.3, 2.0):
            assert whitening.count_above(a, shift) == (values > shift).sum()


def test_deviation_beyond_64_bits():
    x = np.array([[0], [1 << 40]])
    centre = whitening._Centre(2, [1 << 40])
    assert whitening._deviation(x, centre) == [None, None]
    assert whitening._deviation(np.array([[1], [3]]), whitening._Centre(2, [4])) == [4, 4]
