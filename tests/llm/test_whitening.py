"""Whitened vectors against plain arithmetic on whole numbers and fractions."""

import math
from fractions import Fraction

import numpy as np
import pytest

from barloom.llm.whitening import components, moments, op12_whitening, principal, whiten


def fixed(vectors):
    width = max(map(len, vectors))
    return [[math.floor(1024 * float(c)) + 100_000 for c in [*v, *[0.0] * (width - len(v))]] for v in vectors]


def exact_covariance(xs):
    n, width = len(xs), len(xs[0])
    mean = [Fraction(sum(x[d] for x in xs), n) for d in range(width)]
    return [[sum((x[a] - mean[a]) * (x[b] - mean[b]) for x in xs) / n for b in range(width)] for a in range(width)]


def check(rows, xs_by_id, width):
    """Every column of the answer against a second computation."""
    xs = [x for x in xs_by_id.values()]
    n, total = len(xs), [sum(c) for c in zip(*xs)]
    matrix = np.array(xs, float)
    centred = matrix - matrix.mean(axis=0)
    covariance = centred.T @ centred / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    found = {}
    for r in rows:
        assert r.n == n and r.identity_error <= 1e-4
        assert r.deviation == r.deviation_exact == sum((n * x - s) ** 2 for x, s in zip(xs_by_id[r.vec_id], total))
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-4)
        found.setdefault(r.component, {})[r.vec_id] = r.whitened
    assert sorted(found) == list(range(1, min(8, width) + 1))
    ids = list(xs_by_id)
    for k, by_id in found.items():
        got = np.array([by_id[i] for i in ids])
        want = centred @ vectors[:, k - 1] / np.sqrt(values[k - 1])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6
    white = np.array([[found[k][i] for k in sorted(found)] for i in ids])
    assert np.abs(np.cov(white.T, bias=True) - np.eye(white.shape[1])).max() < 1e-8


def test_registered_query(spark, sf):
    good = {r.vec_id: list(r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()
            if r.embedding and all(x is not None and math.isfinite(x) for x in r.embedding)}
    xs = dict(zip(good, fixed(list(good.values())), strict=True))
    check(op12_whitening(spark, sf).collect(), xs, 64)


def test_moments_are_exact(spark):
    rng = np.random.default_rng(3)
    vectors = [(rng.normal(size=5) * 10.0 ** rng.integers(-3, 4)).tolist() for _ in range(200)]
    frame = spark.createDataFrame([(v,) for v in vectors], "embedding array<double>").repartition(7)
    known = moments(frame)
    want = exact_covariance(fixed(vectors))
    assert [[Fraction(v, 2 * known.n**2) for v in row] for row in known.scaled] == want


@pytest.mark.parametrize("size", [1e6, 1e12, 1e300])
def test_large_entries_stay_exact(spark, size):
    """Beyond 64 bits sums are taken in Python's whole numbers; entries beyond 2^52 count as that."""
    rng = np.random.default_rng(4)
    vectors = [(rng.normal(size=3) * size).tolist() for _ in range(40)]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    clipped = [[min(max(c, -(2.0**52)), 2.0**52) for c in v] for v in vectors]
    xs = fixed(clipped)
    known = moments(frame)
    assert [[Fraction(v, 2 * known.n**2) for v in row] for row in known.scaled] == exact_covariance(xs)
    total = [sum(c) for c in zip(*xs)]
    for r in whiten(frame, known).collect():
        exact = sum((40 * x - s) ** 2 for x, s in zip(xs[r.vec_id], total))
        assert r.deviation == (exact if exact < 1 << 63 else None)
        assert r.deviation_exact == (exact if exact < 10**38 else None)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0]), (None, [1.0, 1.0]), (8, [2.0, 0.0]), (9, [2.0, 0.0]), (9, [2.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "vec_id long, embedding array<double>, n string, whitened double")
    got = components(frame).collect()
    kept = [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])]
    assert sorted((str(r.vec_id), r.component) for r in got) == sorted((str(i), k) for i, _ in kept for k in (1, 2))
    xs = fixed([v for _, v in kept])
    assert {r.n for r in got} == {len(kept)}
    total = [sum(c) for c in zip(*xs)]
    for (i, _), x in zip(kept, xs, strict=True):
        for r in got:
            if r.vec_id == i:
                assert r.deviation == sum((len(kept) * a - s) ** 2 for a, s in zip(x, total))
    clash = whiten(frame, moments(frame)).columns
    assert clash == ["vec_id", "embedding", "n", "whitened", "deviation", "deviation_exact"]
    assert components(frame.limit(0)).count() == components(frame.where("vec_id = 2")).count() == 0


def test_directions_without_spread(spark):
    """Where an eigenvalue is 0 there is nothing to divide by: the rows stay, their number is null."""
    frame = spark.createDataFrame([(i, [float(i), 2.0 * i, 0.0]) for i in range(6)], "vec_id long, embedding array<float>")
    known = moments(frame)
    assert principal(known).told.tolist() == [True, False, False]
    got = components(frame).collect()
    assert len(got) == 18 and all((r.whitened is None) == (r.component > 1) and r.identity_error < 1e-9 for r in got)
    alone = components(frame.where("vec_id = 1")).collect()
    assert [(r.component, r.whitened, r.explained, r.identity_error, r.deviation) for r in alone] == [(k, None, None, None, 0) for k in (1, 2, 3)]
