"""Counts and base scores against brute force; the automaton sums to one and beats the base."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import lm
from barloom.llm.lm import Automaton, lm_scores, op6_lm_scores, pack, steps, summed, unpack

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), None]


def base_scores(docs, training):
    counts = Counter(t for d, text in docs if training(d) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    return {str((d, text)): (
        len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), n,
        sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(text)),
    ) for d, text in docs}


def test_registered_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    held = {d: zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs}
    expected = base_scores(docs, lambda d: not held[d])
    text = dict(docs)
    rows = op6_lm_scores(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == held[r.doc_id]
        n, known, train, base = expected[str((r.doc_id, text[r.doc_id]))]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, train)
        assert r.base_score == pytest.approx(base, rel=1e-9) and r.score <= 0
    away = [r for r in rows if r.held_out]
    assert sum(r.score for r in away) > sum(r.base_score for r in away)


def test_odd_rows(spark, odd, none):
    got = lm_scores(odd, F.lit(True)).collect()
    texts = [(r.doc_id, r.text) for r in odd.collect()]
    expected = base_scores(texts, lambda d: True)
    assert sorted((str(r.doc_id), r.n_tokens, r.n_known) for r in got) == sorted(
        (str(d), *expected[str((d, t))][:2]) for d, t in texts)
    assert lm_scores(none, F.lit(True)).count() == 0
    untrained = lm_scores(odd, F.lit(False)).collect()
    assert len(untrained) == len(texts) and all(r.base_score == 0 and r.train_tokens == 0 for r in untrained)


def machine_of(sequences, words):
    """The automaton of whole sequences of word numbers; the start is 0, the end 1."""
    word_n, behind, pair_n, gram_n = Counter(), {}, Counter(), Counter()
    for sequence in sequences:
        whole = [0, *sequence, 1, 1]
        word_n.update(whole[:-1])
        for a, b, c in zip(whole, whole[1:], whole[2:]):
            pair_n[a, b] += 1
            gram_n[a, b, c] += 1
            behind.setdefault((a,), set()).add(b)
            behind.setdefault((a, b), set()).add(c)
    pairs = sorted({*pair_n, *((a, b) for a in range(words) for b in range(words))})
    at = {p: i for i, p in enumerate(pairs)}
    grams = sorted(gram_n)
    kinds = lambda h: len(behind.get(h, ()))
    return pairs, grams, Automaton(
        np.array([word_n[w] for w in range(words)]), np.array([kinds((w,)) for w in range(words)]),
        sum(n for w, n in word_n.items() if w), sum(w > 0 for w in word_n), 0, 1,
        np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]), np.array([pair_n[p] for p in pairs]), np.array([kinds(p) for p in pairs]),
        np.array([at[g[:2]] for g in grams]), np.array([g[2] for g in grams]), np.array([at[g[1:]] for g in grams]), np.array([gram_n[g] for g in grams]),
    )


def test_every_state_gives_out_one():
    rng = np.random.default_rng(3)
    words = 8  # the last one is unknown to training, which is what the floor's share is for
    _, _, machine = machine_of([(rng.choice(5, rng.integers(0, 12), p=[0.4, 0.3, 0.1, 0.1, 0.1]) + 2).tolist() for _ in range(60)], words)
    states = sorted({0, *machine.word_state.tolist(), *machine.pair_state.tolist()})
    assert len(states) > 20
    for state in states:
        word = np.arange(1, words)
        weight, _ = machine.step(np.full(words - 1, state), word, machine.search(word))
        assert (10**weight).sum() == pytest.approx(1, rel=1e-12)


def test_texts_walk_by_number_as_by_search(monkeypatch):
    """Also in pieces; and some texts that the training texts lack."""
    rng = np.random.default_rng(4)
    sequences = [(rng.choice(5, n) + 2).tolist() for n in (0, 3, 400, 41)]
    pairs, grams, machine = machine_of(sequences[1:], 8)
    at, gram = ({p: i for i, p in enumerate(x)} for x in (pairs, grams))
    walked = [*sequences, [4, 5, 7, 7, 2, 3], [7]]
    whole = [[*s, 1] for s in walked]
    word, first = np.concatenate(whole), np.cumsum([0, *map(len, whole)])
    pair_at = np.array([at[p] for s in whole for p in zip([0, *s], s)])
    none = len(grams)  # n-grams that training lacks have no arc
    machine.gram_arc = np.append(machine.gram_arc, -1)
    gram_at = np.array([gram.get(g, none) for s in whole for g in zip([0, *s], s, [*s[1:], 1])])
    expected = []
    for s in whole:
        state = np.array([machine.word_state[0]])
        for w in s:
            one = np.array([w])
            weight, state = machine.step(state, one, machine.search(one))
            expected.append(weight[0])
    assert machine.walk(word, first, pair_at, gram_at).tolist() == expected
    monkeypatch.setattr(lm, "WALK", 7)
    assert machine.walk(word, first, pair_at, gram_at).tolist() == expected


@pytest.mark.parametrize("values", [[], [0], [1, 255, 256], [0, 2**40, 2**62]])
def test_numbers_pack(values):
    assert unpack(pack(np.array(values, np.int64))).tolist() == values


def test_steps_sum_up_again():
    values, begins = np.array([5, 9, 2, 2, 7]), np.array([0, 2, 4])
    assert steps(values, begins).tolist() == [5, 4, 2, 0, 7]
    assert summed(steps(values, begins), begins).tolist() == values.tolist()


def test_small_blocks_and_many_buckets_score_alike(spark, monkeypatch):
    docs = spark.createDataFrame([(i, " ".join(f"w{(i * j) % 13}" for j in range(i % 9))) for i in range(60)] + [(100, None)], "doc_id long, text string").coalesce(2)
    rows = lambda: sorted(lm_scores(docs, F.col("doc_id") % 4 != 0).collect())
    expected = rows()
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 20)
    monkeypatch.setattr(lm, "BUCKET_GRAMS", 5)
    monkeypatch.setattr(lm, "BUCKET_WORDS", 3)
    monkeypatch.setattr("barloom.llm.texts.CHUNK_BYTES", 50)
    got = rows()
    assert [r[:4] for r in got] == [r[:4] for r in expected]
    assert [x for r in got for x in r[4:]] == pytest.approx([x for r in expected for x in r[4:]], rel=1e-12)


def test_rare_words_and_ngrams_count(spark):
    """Interpolated weights by brute force, over a corpus so large that single n-grams have a tiny share of it."""
    filler = [(i, " ".join(f"w{(i * 7 + j) % 50}" for j in range(2000))) for i in range(600)]
    rare = [(10_000, "zyx uvw rst opq"), (10_001, "zyx uvw lmn opq")]
    docs = spark.createDataFrame(filler + rare + [(20_000, "zyx uvw rst w1 never")], "doc_id long, text string")
    n, behind = Counter(), {}
    for _, text in filler + rare:
        words = tokens(text)
        for i, w in enumerate(words):
            for history in ((), (words[i - 1] if i else "<s>",), *([(words[i - 2] if i > 1 else "<s>", words[i - 1])] if i else [])):
                n[(*history, w)] += 1
                behind.setdefault(history, Counter())[w] += 1
    total, kinds = sum(behind[()].values()), len(behind[()])

    def weight(history, w):
        if not history:
            return (n[(w,)] + 0.1) / (total + 0.1 * (kinds + 1))
        lower, seen = weight(history[1:], w), behind.get(history)
        return (max(n[(*history, w)] - 0.7, 0) + 0.7 * len(seen) * lower) / sum(seen.values()) if seen else lower

    got = {r.doc_id: r.score for r in lm_scores(docs, F.col("doc_id") < 20_000).collect()}
    for i, text in [*rare, (20_000, "zyx uvw rst w1 never"), filler[0]]:
        words = tokens(text)
        expected = sum(math.log10(weight((words[k - 2] if k > 1 else "<s>", words[k - 1]) if k else ("<s>",), w)) for k, w in enumerate(words))
        assert got[i] == pytest.approx(expected, rel=1e-9), i
