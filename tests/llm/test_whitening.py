"""Whitening against a plain eigendecomposition of the covariance."""

import math
import random

import numpy as np
import pytest

from spanframe.llm.whitening import _factor, as_integers, jacobi, whiten


@pytest.mark.parametrize("rows, dims", [(3, 1), (5, 2), (40, 7), (90, 64), (6, 9)])
def test_rotations(rows, dims):
    rng = np.random.default_rng(dims)
    a = rng.normal(size=(rows, dims)) * 10.0 ** rng.integers(-6, 6, dims)
    sigma, v = jacobi(a)
    assert np.allclose(v.T @ v, np.eye(dims), atol=1e-13) and (np.diff(sigma) <= 0).all()
    assert np.allclose(np.linalg.norm(a @ v, axis=0), sigma, rtol=1e-9, atol=1e-9 * sigma[0])
    assert np.allclose(sigma[: min(rows, dims)], np.linalg.svd(a, compute_uv=False), rtol=1e-10, atol=1e-12 * sigma[0])


def test_small_singular_values_are_accurate():
    """Columns of very different size keep their relative accuracy."""
    q = np.linalg.qr(np.random.default_rng(0).normal(size=(60, 5)))[0]
    want = np.array([1e8, 1e3, 1.0, 1e-5, 1e-9])
    assert np.allclose(jacobi(q * want)[0], want, rtol=1e-12)


def plain(data, components=16):
    kept = [(i, v) for i, v in data if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    x = {i: tuple(math.floor(64 * c) + 1_000_000 for c in v) for i, v in kept}
    fit = np.array(sorted(set(x.values())), np.int64)
    n, s = len(fit), fit.sum(0)
    centred = (fit * n - s) / n
    e, axes = np.linalg.eigh(centred.T @ centred / n)
    e, axes = e[::-1], axes[:, ::-1]
    k = min(components, int((e > 1e-18 * e[0]).sum()), n - 1)
    out = {}
    for i, v in x.items():
        away = [int(n * a - b) for a, b in zip(v, s)]
        for c in range(k):
            out[i, c + 1] = (n, sum(y * y for y in away), np.array(away) / n @ axes[:, c] / math.sqrt(e[c]), e[c] / e.sum())
    return out


def vectors(rng, n, dims):
    return [(k, [rng.gauss(3, 1 + j) for j in range(dims)]) for k in range(n)]


@pytest.mark.parametrize("n, dims, parts", [(300, 20, 40), (50, 3, 2), (5, 8, 3)])
def test_equals_plain(spark, n, dims, parts):
    rng = random.Random(n)
    data = vectors(rng, n, dims)
    data += [(n + k, data[0][1]) for k in range(n // 3)] + [(-1, None), (-2, [1.0] * (dims - 1) + [None]), (-3, [float("nan")] + [0.0] * (dims - 1)), (-4, [float("inf")] * dims)]
    df = spark.createDataFrame([(i, v, 1) for i, v in data], "vec_id long, embedding array<double>, component int").repartition(parts)
    got = {(r.vec_id, r.component): r for r in whiten(df).collect()}
    want = plain(data)
    assert got.keys() == want.keys() and got
    sign = {}
    for key, (count, deviation, white, explained) in want.items():
        r = got[key]
        assert (r.n, int(r.deviation)) == (count, deviation) and abs(r.explained - explained) < 1e-9 * explained + 1e-15
        if abs(white) > 0.1:
            assert sign.setdefault(key[1], np.sign(white * r.whitened)) == np.sign(white * r.whitened)
        assert abs(abs(white) - abs(r.whitened)) < 1e-7
    assert {r.identity_error for r in got.values()} == {next(iter(got.values())).identity_error} and next(iter(got.values())).identity_error < 1e-10


def test_tree_of_factors(spark):
    rng = random.Random(1)
    data = vectors(rng, 200, 6)
    fit = as_integers(spark.createDataFrame(data, "vec_id long, embedding array<double>").repartition(30), "embedding").select("_x")
    x = np.array([r[0] for r in fit.collect()])
    s = x.sum(0)
    r = _factor(fit, len(x), s, fan_in=2)
    centred = (x * len(x) - s) / len(x)
    assert r.shape == (6, 6) and np.allclose(r.T @ r, centred.T @ centred, rtol=1e-9)


def test_odd_tables(spark):
    schema = "vec_id string, embedding array<float>"
    assert whiten(spark.createDataFrame([], schema)).count() == 0
    assert whiten(spark.createDataFrame([("a", [1.0, 2.0]), (None, [1.0, 2.0]), ("b", None)], schema)).count() == 0  # one distinct vector
    assert whiten(spark.createDataFrame([("a", [])], schema)).count() == 0
    flat = whiten(spark.createDataFrame([("a", [1.0, 2.0]), (None, [2.0, 4.0]), (None, [2.0, 4.0]), ("c", [3.0, 6.0])], schema)).collect()
    assert [r.component for r in flat] == [1] * 4 and all(r.n == 3 and abs(r.explained - 1) < 1e-12 for r in flat)
    with pytest.raises(ValueError, match="dimensions"):
        whiten(spark.createDataFrame([("a", [1.0]), ("b", [1.0, 2.0])], schema))
    far = whiten(spark.createDataFrame([("a", [4e15]), ("b", [-4e15]), ("c", [0.0])], schema))  # more than a long holds
    assert max(int(r.deviation) for r in far.collect()) > 2**63
