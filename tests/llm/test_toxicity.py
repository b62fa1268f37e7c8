"""Held-out accuracy, and sentences found."""

import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from barloom.llm.toxicity import LEAK, Sentences, chance, clean_texts, fit, op5_toxicity, score_texts, telling, train


def test_held_out_rows_are_told_apart(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op5_toxicity(spark, sf).collect()
    assert len({r.doc_id for r in rows}) == len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    kept = [(r.score, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic = np.array([s for s, y in kept if y]), np.array([s for s, y in kept if not y])
    assert np.mean([(t > toxic[1]).mean() for t in toxic[0]]) > 0.97  # area under the curve
    assert (toxic[1] < 0.5).mean() > 0.98


@pytest.fixture(scope="module")
def small(spark):
    rows = [(i, f"The weather number{i % 50} is fine. " + ("You are rotten scum, go away. " if i % 3 == 0 else "See you soon. ") + "Bye now.") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(900)], "doc_id long, toxic int")
    return docs, labels, train(docs, labels)


def test_the_offending_sentence_is_found(spark, small):
    docs, _, model = small
    for r in score_texts(docs, model).collect():
        assert (r.score >= 0.5) == (r.doc_id % 3 == 0)
        if r.score >= 0.5:
            assert r.worst_sentence == "You are rotten scum, go away"
    assert clean_texts(docs, model).count() == 600


def test_odd_rows(spark, odd, none, small):
    model = small[2]
    scored = score_texts(odd, model)
    assert scored.columns == ["doc_id", "text", "n_tokens", "score", "worst_score", "worst_sentence"]
    by_id = {r.doc_id: r for r in scored.collect()}
    assert scored.count() == odd.count()
    for i in (2, 3, 4):
        assert (by_id[i].score, by_id[i].worst_sentence) == (0.0, None)
    assert clean_texts(odd, model).columns == odd.columns
    assert score_texts(none, model).count() == clean_texts(none, model).count() == 0


def test_without_labels_nothing_is_toxic(spark, small):
    docs, labels, _ = small
    model = train(docs, labels.where("toxic = 0"))
    assert score_texts(docs, model).where("score >= 0.5").count() == 0
    assert score_texts(docs, train(docs.limit(0), labels.limit(0))).where("score >= 0.5").count() == 0


def test_noisy_or_by_hand(spark, small):
    """A text's score from its sentences, each taken as a text of its own."""
    model = small[2]
    texts = ["You are rotten scum, go away. Fine! You scum? See you soon", "See you soon. Bye now.", "scum", "Rotten weather.\nrotten scum " * 40]
    got = [r.score for r in score_texts(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), model).collect()]
    for text, score in zip(texts, got, strict=True):
        silent = 1.0
        leans = []
        for part in filter(str.split, re.split("[.!?\n]", text)):
            alone = Sentences(pa.array([part]))
            weights = [float(model.weights[f]) for f in alone.feature if model.weights[f]]
            leans += [float(model.lean[f]) for f in alone.feature if f]
            if weights:
                silent *= 1 - 1 / (1 + math.exp(-(sum(weights) + model.bias)))
        leak = LEAK / (1 + math.exp(-10 * sum(leans) / len(leans)))
        assert score == pytest.approx(1 - (1 - leak) * silent, abs=1e-6)


def test_telling_features_by_counting():
    assert chance(20, 6, 5, 3) == pytest.approx(sum(math.comb(6, k) * math.comb(14, 5 - k) for k in range(3, 6)) / math.comb(20, 5))
    assert chance(20, 6, 18, 0) == pytest.approx(1) and chance(9, 9, 4, 4) == pytest.approx(1)
    # one word in ten of ten toxic rows among thousands that are spread by chance
    seen = [(10, 10, 1), (10, 1, 900), (10, 2, 300), (3, 1, 2000), (1, 1, 5000)]
    assert telling(100, 10, seen) == [(10, 10)]
    assert telling(100, 10, seen[1:]) == []
    assert telling(8, 2, [(2, 2, 5), (2, 1, 100)]) == []


def test_weights_fall_on_what_explains_the_labels():
    # feature 7 in every toxic text, 8 in half of all texts
    feature, first, doc, toxic = [], [0], [], []
    for n in range(40):
        toxic.append(n % 4 == 0)
        for f in ([7] if toxic[-1] else []) + ([8] if n % 2 else []):
            feature.append(f)
            doc.append(n)
            first.append(len(feature))
    weights, bias = fit(np.array(feature), np.array(first), np.array(doc), np.array(toxic))
    assert weights[7] + bias > 2 and weights[8] + bias < -2 and not weights[[0, 6, 9]].any()


@pytest.mark.parametrize("scale", ["0.001", "0.01"])
def test_small_samples_leave_clean_texts_alone(spark, scale):
    sf = f"/root/testdata/sf{scale}"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = op5_toxicity(spark, sf).collect()
    clean = [r.predicted for r in rows if labels.get(r.doc_id) == 0]
    found = [r.predicted for r in rows if labels.get(r.doc_id) == 1]
    assert 1 - np.mean(clean) >= 0.97 and sum(found) > 0
    lengths = {r.doc_id: len(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert abs(np.corrcoef([r.score for r in rows], np.log([1 + lengths[r.doc_id] for r in rows]))[0, 1]) < 0.2


def test_long_texts_without_telling_words_stay_clean(spark, small):
    docs, labels, model = small
    long = spark.createDataFrame([(1, "See you soon. The weather number3 is fine. " * 20_000)], "doc_id long, text string")
    assert score_texts(long, model).first().score < LEAK
    unlearnable = labels.selectExpr("doc_id", "cast(doc_id % 2 = 0 as int) toxic")
    shuffled = train(docs.selectExpr("doc_id", "'The weather is fine. See you soon.' as text"), unlearnable)
    assert score_texts(docs, shuffled).where(f"score >= {LEAK}").count() == 0
