"""The trie's nodes against a plain count of all prefixes."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from barloom.llm.prefix_trie import (
    ROOT, WIDTH, ZFastTrie, end_digests, op11_prefix_trie, paths, rebuilt, trie_nodes, turn_sequences, two_fattest,
)

ROW = "conv_id long, turn long, role string, text string"


def sequences_of(rows):
    """Each conversation's (role, text) pairs in order, by id."""
    made = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            made.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns, key=lambda t: t[:2])] for c, turns in made.items()}


def rebuilt_of(made):
    out = {}
    for c, own in made.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = made.get(c - int(c - 100 * int(c / 100)), [])
        out[c] = base[:h] + own[h:]
    return out


def brute_force(made):
    """Every prefix with its members, then each column by its definition."""
    members = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    rows = []
    for node, of in members.items():
        below = [p for p in members if p[: len(node)] == node]
        children = [p for p in below if len(p) == len(node) + 1]
        parent = min(members[node[:-1]]) if node else None
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below) for p in below)
        ends = ",".join(map(str, sorted(c for c in of if len(made[c]) == len(node))))
        rows.append((min(of), len(node), parent, len(of), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def got_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_registered_query(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got_of(op11_prefix_trie(spark, sf)) == brute_force(rebuilt_of(sequences_of(rows)))


@pytest.mark.parametrize(("entries", "seed"), [(1, 0), (7, 1), (1 << 18, 2)])
def test_random_conversations(spark, entries, seed):
    """Many shared prefixes; tries that are handed out early merge to the same nodes."""
    import random

    draw = random.Random(seed)
    rows = [(c, t, draw.choice("ua"), draw.choice(["x", "yy", "é🙂"])) for c in draw.sample(range(-150, 400), 120) for t in range(draw.randint(1, 9))]
    frame = spark.createDataFrame(rows, ROW).repartition(5)
    made = sequences_of(rows)
    assert got_of(trie_nodes(turn_sequences(frame), entries=entries)) == brute_force(made)
    assert got_of(trie_nodes(rebuilt(turn_sequences(frame)))) == brute_force(rebuilt_of(made))


def test_odd_rows(spark):
    """Nulls, empty texts, a null turn first, rows without id, a conversation without turns, a long text, clashing names."""
    long = "w " * 50_000
    rows = [
        (0, 1, "user", "hi"), (0, None, None, "first"), (0, 2, "user", None), (7, None, None, "first"), (7, 1, "user", "hi"), (7, 2, "user", ""),
        (None, 0, "user", "nobody"), (100, 0, "user", long), (101, 0, "user", long), (102, 5, "a", "own"), (250, 0, "user", "alone"), (-5, 0, "x", ""),
    ]
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], f"{ROW}, depth int, path string")
    made = sequences_of(rows)
    assert got_of(trie_nodes(turn_sequences(frame))) == brute_force(made)
    again = rebuilt_of(made)
    assert any(not turns for turns in again.values())  # 250 takes over turns that nobody has
    assert got_of(trie_nodes(rebuilt(turn_sequences(frame)))) == brute_force(again)
    assert trie_nodes(rebuilt(turn_sequences(frame.limit(0)))).count() == 0


def test_repeated_rows_and_ties_have_one_order(spark):
    rows = [(1, 0, "a", "x"), (1, 0, "a", "x"), (1, 0, "b", "y"), (2, 0, "b", "y"), (2, 0, "a", "x"), (2, 0, "a", "x")]
    for part in (rows, rows[::-1]):
        nodes = got_of(trie_nodes(turn_sequences(spark.createDataFrame(part, ROW).repartition(3))))
        assert sorted((r[1], r[3]) for r in nodes) == [(0, 2), (1, 2), (2, 2), (3, 2)]


@pytest.mark.parametrize("piece", [1, 50, 1 << 18])
def test_a_hot_end_in_pieces(spark, piece):
    """Most conversations are the same; their ids meet as joined pieces, in rising order of numbers."""
    frame = spark.range(3000).selectExpr("id - 700 as conv_id", "0L as turn", "'user' as role", "if(id % 3 = 0, 'other', 'same') as text")
    found = paths(turn_sequences(frame.repartition(7)))
    got = sorted(r.ends_sha256 for r in end_digests(found, piece=piece).collect())
    ids = [[i - 700 for i in range(3000) if (i % 3 == 0) == other] for other in (False, True)]
    assert got == sorted(hashlib.sha256(",".join(map(str, some)).encode()).hexdigest() for some in ids)


def test_two_fattest():
    for high in range(1, 70):
        for low in range(high):
            assert two_fattest(low, high) == max(range(low + 1, high + 1), key=lambda n: n & -n)


def path_of(word):
    made, last = [ROOT], ROOT
    for c in word:
        last = hashlib.blake2b(last + bytes([c]), digest_size=WIDTH).digest()
        made.append(last)
    return b"".join(made)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1), max_size=20), max_size=25), st.lists(st.integers(0, 1), max_size=22))
def test_exit_nodes(words, asked):
    """The trie holds root, branching nodes and ends; fat search finds the deepest one on any path and where the path goes on."""
    trie = ZFastTrie()
    for i, word in enumerate(words):
        trie.insert(path_of(word), [1] * len(word), 1, i)
    prefixes = {tuple(w[:d]) for w in words for d in range(len(w) + 1)} | {()}
    ends = {tuple(w) for w in words}
    explicit = {p for p in prefixes if p in ends or not p or sum((*p, c) in prefixes for c in (0, 1)) == 2}
    assert {path_of(p)[-WIDTH:] for p in explicit} == {n.prefix(n.end) for n in (trie.root, *trie.handles.values())}
    at, below = trie.locate(path_of(asked), len(asked))
    deepest = max((p for p in explicit if list(p) == asked[: len(p)]), key=len)
    assert at.prefix(at.end) == path_of(deepest)[-WIDTH:] and at.end == len(deepest)
    goes_on = len(asked) > len(deepest) and tuple(asked[: len(deepest) + 1]) in prefixes
    assert (below is not None) == goes_on
    for node in trie.handles.values():
        assert trie.handles[node.handle()] is node and node.above.end < node.end


def test_a_long_conversation(spark):
    rows = [(c, t, "u", f"t{t}" if c == 0 or t < 1500 else "z") for c in (0, 1) for t in range(2000)]
    nodes = trie_nodes(turn_sequences(spark.createDataFrame(rows, ROW)))
    found = {(r.conv_id, r.depth): r for r in nodes.collect()}
    assert len(found) == 2501 and found[0, 0].saved_tokens == sum(len(f"t{t}") for t in range(1500)) and found[0, 0].n_leaves == 2
    assert found[1, 1501].parent_conv_id == 0 and found[0, 1500].n_children == 2
