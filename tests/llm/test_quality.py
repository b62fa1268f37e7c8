"""Statistics and trees against plain computations, and held-out accuracy."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm.quality import STATISTICS, boost, constant, good_texts, op13_quality, score_texts, statistics, train

TEXTS = [
    "The cat sat. The cat sat.\nTHE DOG!! Ran | away $$$ 42\nThe cat sat. The cat sat.", "", None, " \n\t ", "a", "no no no no yes no",
    "Ünï 中文 🙂 ok-ok (so) ###", "aa bb aa bb aa bb\naa bb", "x " * 500 + "end",
]


def plain(text):
    """Some of the statistics, by counting."""
    raw = (text or "").encode()
    words = [w.lower() for w in raw.replace(b"\x0b", b" ").replace(b"\x0c", b" ").split()]
    n, size = max(len(words), 1), max(len(raw), 1)
    counts, pairs = Counter(words), Counter(zip(words, words[1:]))
    run = best = 0
    for i, w in enumerate(words):
        run = run + 1 if i and words[i - 1] == w else 1
        best = max(best, run)
    lines = [tuple(x.lower().split()) for x in raw.split(b"\n") if x.split()]
    repeated = Counter(lines)
    return {
        "bytes": math.log1p(len(raw)), "words": math.log1p(len(words)), "lines": math.log1p(len(lines)),
        "word_bytes": sum(map(len, words)) / n, "longest_word": math.log1p(max(map(len, words), default=0)),
        "upper": sum(65 <= b <= 90 for b in raw) / size, "digits": sum(48 <= b <= 57 for b in raw) / size,
        "non_ascii": sum(b > 127 for b in raw) / size,
        "entropy": -sum(c / size * math.log2(c / size) for c in Counter(raw).values()),
        "distinct_words": len(counts) / n, "commonest_word": max(counts.values(), default=0) / n,
        "single_words": sum(c == 1 for c in counts.values()) / n,
        "word_again": sum(a == b for a, b in zip(words, words[1:])) / n, "longest_run": best / n,
        "distinct_pairs": len(pairs) / max(len(words) - 1, 1),
        "pair_again": sum(c for c in pairs.values() if c > 1) / max(len(words) - 1, 1),
        "distinct_lines": len(repeated) / max(len(lines), 1),
        "repeated_line_words": sum(len(x) for x in lines if repeated[x] > 1) / n,
        "sentence_ends": sum(w[-1:] in b".!?" for w in words) / n,
    }


def test_statistics_by_counting():
    found = statistics(pa.array(TEXTS))
    alone = np.concatenate([statistics(pa.array([t], pa.string())) for t in TEXTS])
    assert np.array_equal(found, alone) and np.isfinite(found).all()
    for row, text in zip(found, TEXTS, strict=True):
        got = dict(zip(STATISTICS, row.tolist(), strict=True))
        for name, value in plain(text).items():
            assert got[name] == pytest.approx(value, abs=1e-12), (name, text)


def walk(model, row):
    """One row through one tree after the other, by the arrays but node by node."""
    logit = model.base
    for node in model.root.tolist():
        while model.left[node] != node:
            node = int(model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node])
        logit += model.value[node]
    return 1 / (1 + math.exp(-logit))


def test_flat_arrays_give_what_each_tree_says():
    rng = np.random.default_rng(2)
    rows = rng.normal(size=(5_000, 5)).round(1)  # many ties
    good = ((rows[:, 0] * rows[:, 1] > 0) ^ (rng.random(5_000) < 0.05)).astype(float)
    model = boost(rows, good, np.ones(5_000), trees=40)
    scores = model.scores(rows)
    assert scores[:300].tolist() == pytest.approx([walk(model, r) for r in rows[:300]], rel=1e-12)
    assert (scores[good == 1][:, None] > scores[good == 0]).mean() > 0.9  # a product of two statistics is learnt
    # leaves' sums make the model fit the labels' share
    assert scores.mean() == pytest.approx(good.mean(), abs=0.02)


def test_the_first_split_is_the_best_one():
    rng = np.random.default_rng(3)
    rows = rng.integers(0, 8, (400, 3)).astype(float)
    good = (rows[:, 2] > 4).astype(float)
    weight = rng.uniform(0.5, 2, 400)
    model = boost(rows, good, weight, trees=1, depth=1)
    p, w = (weight * good).sum() / weight.sum(), weight * 400 / weight.sum()
    slope, bend = w * (p - good), w * p * (1 - p)

    def gain(f, cut):
        side = rows[:, f] <= cut
        return sum(slope[s].sum() ** 2 / (bend[s].sum() + 1) for s in (side, ~side))

    best = max(((f, c) for f in range(3) for c in range(7)), key=lambda x: gain(*x))
    assert best == (2, 4) == (model.feature[0], model.threshold[0])
    for child, side in ((model.left[0], rows[:, 2] <= 4), (model.right[0], rows[:, 2] > 4)):
        assert model.value[child] == pytest.approx(-0.1 * slope[side].sum() / (bend[side].sum() + 1))


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op13_quality(spark, sf).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    kept = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    good, bad = np.array([s for s, y in kept if y]), np.array([s for s, y in kept if not y])
    assert (good[:, None] > bad).mean() > 0.99  # area under the curve
    assert (good >= 0.3).mean() > 0.99 and (bad < 0.3).mean() > 0.95


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_small_samples_leave_good_texts_alone(spark, scale):
    sf = f"/root/testdata/sf{scale}"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    told = [(r.predicted, labels[r.doc_id]) for r in op13_quality(spark, sf).collect() if r.doc_id in labels]
    assert np.mean([p for p, y in told if y]) > 0.97


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, f"The weather number{i % 50} is fine here." if i % 3 else "BUY!! NOW!! $$$ " * (1 + i % 7)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(900)], "doc_id long, quality int")
    return docs, labels, train(docs, labels)


def test_odd_rows(spark, odd, none, small):
    docs, labels, model = small
    assert all((r.score >= 0.3) == (r.doc_id % 3 > 0) for r in score_texts(docs, model).collect())
    assert good_texts(docs, model).count() == 600
    scored = score_texts(odd, model)
    assert scored.columns == ["doc_id", "text", "n_tokens", "score"] and scored.count() == odd.count()
    by_id = {r.doc_id: r.score for r in scored.collect()}
    assert by_id[2] == by_id[3] and by_id[5] == by_id[6] and all(0 <= s <= 1 for s in by_id.values())
    assert good_texts(odd, model).columns == odd.columns
    assert score_texts(none, model).count() == good_texts(none, model).count() == 0


def test_labels_without_two_kinds(spark, small):
    docs, labels, _ = small
    only = train(docs, labels.where("quality = 1"))
    assert {round(r.score, 12) for r in score_texts(docs, only).collect()} == {only.scores(np.zeros((1, len(STATISTICS))))[0].round(12)}
    assert only.scores(np.zeros((1, 1)))[0] > 0.99
    nothing = train(docs.limit(0), labels.limit(0))
    assert nothing.base == constant(0.5).base and nothing.scores(np.zeros((1, 1)))[0] == 0.5


def test_conflicting_and_odd_labels(spark, small):
    docs, labels, model = small
    more = labels.union(spark.createDataFrame([(3, 1), (3, None), (None, 0), (4, 7)], "doc_id long, quality int"))
    twice = docs.union(docs).withColumn("quality", docs.doc_id)
    again = train(twice, more)
    assert np.array_equal(again.threshold, model.threshold) and np.array_equal(again.value, model.value)
