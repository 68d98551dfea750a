"""Whitening against plain numpy on the same rows, and eigenvectors on hard matrices."""

import math

import numpy as np
import pytest

from starfold.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, "extra", 1) for i, v in rows], SCHEMA)


def rotation(rng, d):
    return np.linalg.qr(rng.normal(size=(d, d)))[0]


@pytest.mark.parametrize(
    "values",
    [
        [5.0, 3.0, 2.0, 1.0, 0.5],
        [1.0, 1.0 - 1e-9, 1.0 - 2e-9, 0.5, 0.1],  # float32 cannot tell the first three apart
        [1.0, 1e-8, 2e-8, 3e-8, 0.0],
        [2.0, 2.0 - 1e-8, 1.0, 1.0 - 1e-10, 1e-3],
        [3.0 + 1e-9, 3.0, 3.0 - 1e-9, 3.0 + 2e-9, 3.0 - 3e-9],
    ],
)
def test_eigenvectors_are_right_to_double_precision(values):
    q = rotation(np.random.default_rng(1), len(values)).astype(np.longdouble)
    for _ in range(3):
        q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    a = q @ np.diag(np.array(values, np.longdouble)) @ q.T
    found, vector = whitening.eigenvectors(a)
    order = np.argsort(-np.array(values))
    assert np.allclose(found, np.array(values)[order], rtol=0, atol=1e-15 * max(values) * 8)
    assert np.abs(vector.T @ vector - np.eye(len(values))).max() < 1e-14
    for k, place in enumerate(order):
        gap = min(abs(values[place] - v) for j, v in enumerate(values) if j != place)
        off = 1 - abs(float(q[:, place] @ vector[:, k]))
        assert off < 1e-14 + (1e-17 * max(values) / gap) ** 2 * 100


def test_equal_eigenvalues_and_tiny_matrices():
    value, vector = whitening.eigenvectors(np.eye(6) * 7)
    assert np.allclose(value, 7) and np.allclose(vector.T @ vector, np.eye(6), atol=1e-14)
    assert whitening.eigenvectors(np.zeros((3, 3)))[0].tolist() == [0, 0, 0]
    assert whitening.eigenvectors(np.array([[4.0]]))[0].tolist() == [4]


def brute_force(rows, components=4):
    good = [(i, [math.floor(256 * c) for c in v]) for i, v in rows if v and None not in v and np.isfinite(v).all()]
    fit = np.array(sorted({tuple(x) for _, x in good}), np.int64)
    n, total = len(fit), fit.sum(0)
    value, vector = np.linalg.eigh(np.cov(fit.T, bias=True))
    value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
    trace = np.trace(np.cov(fit.T, bias=True))
    out = []
    for i, x in good:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, total))
        w = (np.array(x) - total / n) @ vector / np.sqrt(value)
        out += [(i, k + 1, n, deviation, abs(w[k]), value[k] / trace) for k in range(components)]
    return sorted(out)


def test_whitening_equals_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 8)) * np.array([5, 3, 2, 1, 0.5, 0.5, 0.2, 0.1])
    base = base.astype(np.float32).astype(float).tolist()
    rows = list(enumerate(base + base[:40] + base[:1] * 30))  # repeats count once in the fit
    bad = [(900, None), (901, [None] + [1.0] * 7), (902, [math.nan] * 8), (903, [math.inf] * 8), (904, []), (905, [1.0])]
    found = whitening.whiten(frame(spark, rows + bad + [(7, base[7]), (None, base[8])]).repartition(5)).collect()
    expected = brute_force(rows + [(7, base[7]), (-1, base[8])])
    got = sorted((-1 if r.vec_id is None else r.vec_id, r.component, r.n, int(r.deviation), abs(r.whitened), r.explained) for r in found)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert np.allclose([g[4:] for g in got], [e[4:] for e in expected], rtol=1e-9, atol=1e-9)
    errors = {r.identity_error for r in found}
    assert len(errors) == 1 and errors.pop() < 1e-9
    signs = {}
    for r in found:
        if abs(r.whitened) > 1e-6:
            signs.setdefault((r.vec_id, r.component), set()).add(r.whitened > 0)
    assert all(len(s) == 1 for s in signs.values())


def test_deviations_beyond_64_bits_are_exact():
    x, n, total = np.array([[3_000_000_000, -5], [0, 7]]), 10**9, [10**15, -4]
    expected = [sum((n * a - s) ** 2 for a, s in zip(row, total)) for row in x.tolist()]
    assert [int(d) for d in whitening._exact_deviation(x, n, total).to_pylist()] == expected


def test_few_vectors(spark):
    assert whitening.whiten(frame(spark, [])).collect() == []
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).collect() == []
    one = whitening.whiten(frame(spark, [(1, [0.5, 2.0])])).collect()
    assert [(r.component, r.n, int(r.deviation), r.whitened, r.explained) for r in one] == [
        (1, 1, 0, None, 0.0),
        (2, 1, 0, None, 0.0),
    ]
    two = whitening.whiten(frame(spark, [(1, [0.0, 2.0]), (2, [1.0, 2.0])])).collect()
    first = [r for r in two if r.component == 1]
    assert sorted(abs(r.whitened) for r in first) == pytest.approx([1.0, 1.0])
    assert [r.whitened for r in two if r.component == 2] == [None, None]
