"""The similarity join against all pairs, and the segment keys alone."""

import random
import re

import numpy as np
import pytest

from barloom.llm.graph import components
from barloom.llm.jaccard import Tiles, _perhaps, _verified, bitmap, jaccard_components, one_of_each_component, op4_ngram_jaccard, shingle_sets
from barloom.llm.scratch import Scratch

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, n):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_force(docs, n, num, den):
    """Set size and smallest id reachable; ``docs``: (id, text) pairs."""
    sets = [(i, shingles(t, n)) for i, t in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            a, b = sets[x][1], sets[y][1]
            if a and b and min(len(a), len(b)) * den >= max(len(a), len(b)) * num and len(a & b) * den >= len(a | b) * num:
                parent[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        least[find(x)] = min(least.get(find(x), i), i)
    return sorted((i, len(s), least[find(x)]) for x, (i, s) in enumerate(sets))


def edited(rnd, words, share):
    return [w if rnd.random() > share else f"e{rnd.randrange(10**6)}" for w in words]


@pytest.mark.parametrize(("n", "num", "den"), [(4, 85, 100), (5, 4, 5), (1, 4, 5)])
def test_components_equal_all_pairs(spark, n, num, den):
    rnd = random.Random(n)
    docs, number = [], 0
    passage = [f"p{i}" for i in range(60)]
    for group in range(25):
        size = rnd.choice([2, 5, 8, 9, 12, 30, 60, 150])
        words = [f"w{rnd.randrange(10**5)}" for _ in range(size)] + (passage if group % 3 == 0 else [])
        for _ in range(rnd.choice([1, 2, 6, 15])):
            docs.append((number, " ".join(edited(rnd, words, rnd.choice([0, 0.005, 0.02, 0.04])))))
            number += 1
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame, n, num, den).collect())
    assert got == brute_force(docs, n, num, den)


@pytest.mark.parametrize(("num", "den"), [(85, 100), (4, 5)])
def test_linked_sets_always_share_a_key(num, den):
    rnd = np.random.default_rng(5)
    tiles = Tiles(num, den)
    for _ in range(1500):
        size = int(rnd.choice([1, 2, 5, 6, 7, 8, 10, 13, 20, 40, 200]))
        a = np.unique(rnd.integers(0, 1 << 63, size, dtype=np.uint64))
        drop = int(rnd.integers(0, max(1, size // 5) + 1))
        b = np.unique(np.append(rnd.permutation(a)[drop:], rnd.integers(0, 1 << 63, int(rnd.integers(0, drop + 1)), dtype=np.uint64)))
        both = len(np.intersect1d(a, b))
        if len(b) and both * den >= (len(a) + len(b) - both) * num:
            assert np.intersect1d(tiles.keys(a), tiles.keys(b)).size


def test_odd_rows(spark, odd, none):
    got = sorted((str(r.doc_id), r.n_shingles, r.component_id) for r in jaccard_components(odd).collect())
    assert got == sorted([
        ("1", 6, 1), ("1", 6, 1), ("2", 0, 2), ("3", 0, 3), ("4", 0, 4), ("None", 1, None),
        ("5", 977, 5), ("6", 977, 5), ("7", 1, 7), ("8", 2, 8),
    ])
    assert jaccard_components(none).count() == 0


def test_registered_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in op4_ngram_jaccard(spark, sf).collect())
    assert got == brute_force(docs, 4, 85, 100)


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 60)] + [(100, 101)], "a long, b long")
    labels = {r.node: r.label for r in components(links, Scratch(spark)).collect()}
    assert labels == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100}


def test_helper_columns_give_way(spark):
    frame = spark.createDataFrame([(1, "a b c d e f", "x", 5), (2, "a b c d e f", "y", 6)], "doc_id long, text string, __text string, __place int")
    assert [tuple(r) for r in one_of_each_component(frame).collect()] == [(1, "a b c d e f", "x", 5)]


def test_large_groups_that_do_not_link(spark):
    """Texts with a common passage that stay just under the fraction meet under many keys; blocks of them are whole."""
    rnd = random.Random(11)
    passage = [f"p{i}" for i in range(55)]
    docs = [(i, " ".join([*passage, *(f"x{rnd.randrange(10**6)}" for _ in range(7 if i % 4 else 3))])) for i in range(160)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = sorted((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(frame, 1, 4, 5).collect())
    assert got == brute_force(docs, 1, 4, 5)


def test_sets_stay_where_they_are(spark):
    """Pairs are sent to the sets: the table of sets is read in its buckets, and nothing of it is left behind."""
    scratch = Scratch(spark)
    docs = spark.createDataFrame([(i, f"a b c d e f{i}") for i in range(20)], "set_id long, text string")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = scratch.keep_in_buckets(shingle_sets(docs, 1, "text"), "sets", "set_id")
        pairs = scratch.keep(spark.createDataFrame([(1, 2), (1, 3)], "a long, b long"), "pairs")
        linked = _verified(pairs, sets, 5, 7)
        plan = linked._jdf.queryExecution().executedPlan().toString()
        assert len(re.findall("Exchange hashpartitioning", plan)) == 2
        assert linked.count() == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        scratch.drop("sets", "pairs")
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("sets_")]


def test_texts_not_wanted_go_before_they_move(spark):
    ids = spark.range(20_000).selectExpr("xxhash64(id) as set_id", "id as text")
    wanted = ids.where("text % 50 = 0").select("set_id")
    kept = {r.text for r in _perhaps(ids, wanted).collect()}
    assert kept >= set(range(0, 20_000, 50)) and len(kept) < 500


def test_bitmaps_of_large_sets_tell_them_apart():
    rnd = np.random.default_rng(3)
    a, b = (np.unique(rnd.integers(0, 1 << 63, 4000, dtype=np.uint64)) for _ in range(2))
    differ = lambda x, y: int(np.bitwise_count(bitmap(x) ^ bitmap(y)).sum())
    assert differ(a, b) > 400
    assert differ(a, a[20:]) <= 20
