"""Whitening against NumPy, exact integers and hand-made spectra."""

import math
from fractions import Fraction

import numpy as np
import pytest

from newsgraph.llm import spectrum, whitening


def symmetric(values, seed=3):
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((len(values), len(values))))
    m = q @ np.diag(values) @ q.T
    return (m + m.T) / 2


@pytest.mark.parametrize("values", [
    [9, 7, 5, 3, 1], [5, 5, 5, 1, 0.5], [4, 4 - 1e-13, 4 - 2e-13, 1], [3, 0, 0, 0], [1e6, 1e3, 1, 1e-3], [2.0], [1] * 6, [100 - i for i in range(40)],
])
def test_spectrum(values):
    m = symmetric(np.array(values, dtype=float))
    truth = np.linalg.eigvalsh(m)[::-1]
    found, axes = spectrum.leading(m, 8)
    wanted = [v for v in truth[:8] if v > 1e-12 * truth.sum()]
    assert np.allclose(found, wanted, rtol=1e-9, atol=1e-12 * truth[0])
    assert np.abs(axes @ axes.T - np.eye(len(axes))).max() < 1e-9
    assert np.abs(m @ axes.T - axes.T * found).max() < 1e-10 * truth[0]


def test_counts():
    m = symmetric([5.0, 3.0, 0.0, -2.0, -7.0])
    assert [spectrum.count_above(m, s) for s in (6, 4, 1, -1, -3, -8)] == [0, 1, 2, 3, 4, 5]
    swapped = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert spectrum.count_above(swapped, 0.0) == 1
    assert spectrum.count_above(np.zeros((3, 3)), 0.0) == 0


def test_nothing_to_find():
    assert spectrum.leading(np.zeros((4, 4)), 8)[0].size == 0
    assert spectrum.leading(np.zeros((0, 0)), 8)[0].size == 0


def rows_of(count, size, seed=1):
    rnd = np.random.default_rng(seed)
    base = rnd.standard_normal((count, size)) * np.linspace(1, 0.05, size)
    return [[float(np.float32(v)) for v in r] for r in base]


def brute(vectors, components):
    x = [[math.floor(1024 * c) + 100_000 for c in v] for v in vectors]
    n, size = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(size)]
    deviations = [sum((n * r[j] - sums[j]) ** 2 for j in range(size)) for r in x]
    centred = np.array([[float(Fraction(n * r[j] - sums[j], n)) for j in range(size)] for r in x])
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    return deviations, centred @ axes[:, :components] / np.sqrt(values[:components]), values


def test_whitening_equals_brute_force(spark):
    vectors = rows_of(300, 12)
    vectors += vectors[:3]  # repeated rows
    bad = [None, [None] * 12, [1.0, float("nan")] + [0.0] * 10, [float("inf")] + [0.0] * 11]
    data = [(i, v, 1, "x") for i, v in enumerate(vectors)] + [(1000 + i, v, 1, "x") for i, v in enumerate(bad)]
    frame = spark.createDataFrame(data, "vec_id long, embedding array<float>, n int, whitened string").repartition(4)
    found = whitening.whiten(frame).collect()
    deviations, projected, values = brute(vectors, 8)
    assert len(found) == len(vectors) * 8
    signs = {}
    for r in found:
        truth = projected[r["vec_id"], r["component"] - 1]
        sign = signs.setdefault(r["component"], math.copysign(1, truth * r["whitened"]))
        assert r["n"] == len(vectors) and r["deviation"] == deviations[r["vec_id"]]
        assert abs(r["whitened"] * sign - truth) < 1e-8
        assert abs(r["explained"] - values[r["component"] - 1] / values.sum()) < 1e-10
        assert r["identity_error"] < 1e-10


def test_odd_tables(spark):
    schema = "vec_id long, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])], schema).limit(2)).collect() == []
    assert whitening.whiten(spark.createDataFrame([(1, []), (2, None)], schema)).collect() == []
    # a shorter vector is followed by zeros; a null key stays; one direction of variance gives one component
    found = whitening.whiten(spark.createDataFrame([(None, [1.0, 2.0]), (2, [1.0])], schema)).collect()
    assert sorted((r["vec_id"] or 0, r["component"], r["n"], r["deviation"]) for r in found) == [(0, 1, 2, 2048**2), (2, 1, 2, 2048**2)]
    assert sorted(round(r["whitened"], 9) for r in found) == [-1.0, 1.0] and found[0]["explained"] == pytest.approx(1)


def test_deviation_beyond_a_long(spark):
    found = whitening.whiten(spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")).collect()
    assert {r["vec_id"]: r["deviation"] for r in found}[1] is None and len(found) == 3
    x = np.array([[3_000_000_000, 5], [0, 1]], dtype=np.int64)
    assert whitening._deviations(x, np.zeros(2, dtype=np.int64), np.zeros(2, dtype=np.int64), 1) == [9 * 10**18 + 25, 1]
    assert whitening._deviations(x, np.zeros(2, dtype=np.int64), np.zeros(2, dtype=np.int64), 2) == [None, 4]
