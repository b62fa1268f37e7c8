"""Nearest neighbours against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm.neighbours import VantageTree, nearest, op3_nearest


def brute_force(rows, asks, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(float)
    out = {}
    for i, v in zip(ids, vectors, strict=True):
        if asks(i):
            score = (vectors * v).sum(axis=1)
            order = [j for j in np.lexsort((ids, -score)) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def got_of(frame):
    out = {}
    for r in sorted(frame.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


@pytest.mark.parametrize("copies", [0, 60])
def test_factor_one_is_exact(spark, copies):
    rng = np.random.default_rng(copies)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.5, 3)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(copies)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = got_of(nearest(frame, F.col("vec_id") % 20 == 0, 20, factor=1.0))
    expected = brute_force(rows, lambda i: i % 20 == 0, 20)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in expected.items()}
    for q in got:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in expected[q]], rel=1e-12)


def test_recall_of_the_registered_query(spark, sf):
    good = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()
            if r.embedding and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)]
    expected = brute_force(good, lambda i: i % 20 == 0, 20)
    got = got_of(op3_nearest(spark, sf))
    assert set(got) == set(expected)
    shared = sum(len({i for i, _ in got[q]} & {i for i, _ in expected[q]}) for q in got)
    assert shared >= 0.9 * sum(map(len, expected.values()))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]),
            (7, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (8, [2.0, 0.0]), (9, [2.0, 0.0]), (9, [3.0, 0.0])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, score string")
    got = got_of(nearest(frame, F.col("vec_id") % 20 == 0, 20))
    assert got == {0: [(8, 2.0), (9, 2.0), (20, 0.0)], 20: [(0, 0.0), (8, 0.0), (9, 0.0)]}
    assert nearest(frame.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0
    assert nearest(frame.where("vec_id = 0"), F.col("vec_id") % 20 == 0, 20).count() == 0


def test_a_larger_factor_visits_less():
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.05, (300, 4)) for c in range(8)])
    visited = []
    for factor in (1.0, 3.0):
        tree = VantageTree(points)
        tree.search(points[::50], 5, factor)
        visited.append(tree.visited)
    assert visited[1] <= visited[0] < len(points) * len(points[::50])


@pytest.mark.parametrize("outlier", [5.0, 1e6])
def test_widely_differing_norms_lose_nothing(spark, outlier):
    rng = np.random.default_rng(5)
    units = rng.normal(size=(2000, 16))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    units[1::2] *= rng.uniform(0.2, 1, (1000, 1))
    units[7] *= outlier
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(units)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = got_of(nearest(frame, F.col("vec_id") % 20 == 0, 20))
    expected = brute_force(rows, lambda i: i % 20 == 0, 20)
    assert {q: [i for i, _ in r] for q, r in got.items()} == {q: [i for i, _ in r] for q, r in expected.items()}
