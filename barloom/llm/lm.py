"""Operator 6: n-gram language model as a weighted backoff automaton.

Every word, pair and triple of the training texts counts, whatever the corpus: nothing is dropped
by its frequency. States are histories of up to two words. A state ``h`` has an arc for each n-gram
that begins with it, with the interpolated weight ``((n - D) + D * T * lower) / N``, and a failure
arc to the shorter history with the weight ``D * T / N``: ``n`` counts the n-gram, ``N`` and ``T``
the tokens and the distinct words seen behind ``h``, ``lower`` is the word's weight from the shorter
history. A state gives out one by construction. The last history is empty; its arcs are unigrams with
a floor, which are the base score as well.

The model grows with the corpus, so it is never sent whole. Texts are encoded into blocks of about
``BLOCK_TOKENS`` tokens. Words get whole numbers, small ones for frequent words of their bucket. Each
block then posts its distinct pairs with the words behind them, in order, to buckets by a hash of the
pair: its training counts, which are also its question. As a pair is whole in its bucket, the answer
is complete, and it comes back in the order of the post, without keys. A block builds its part of the
automaton from that, and its texts are walked from left to right, the state carried along.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barloom.llm.scratch import Scratch
from barloom.llm.texts import U64, Words, all_chunks, buffers, free_names, mix, table

DISCOUNT, FLOOR = 0.7, 0.1
BLOCK_TOKENS = 1_500_000
#: About as many n-grams, before they are added up, lie in a bucket; words of a bucket; the fewest bits of a bucket's number.
BUCKET_GRAMS, BUCKET_WORDS, LEAST_BITS = 1_000_000, 500_000, 4
#: Tokens that are walked in turn; longer texts are cut, and a piece starts in the state its two words before lead to.
WALK = 512
END, START = U64(0x5EED0E4D), U64(0x9C0FFEE123456789)
_LEFT, _RIGHT = U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F)


def held_out(key: str = "doc_id") -> Column:
    """Rows kept from training: the remainder of the id's checksum by 10 is 0; a null id trains."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(10)) == 0, F.lit(False))


def tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes with an end after each text, and each text's first token."""
    words = Words(*buffers(column))
    first = words.first + np.arange(len(words.first))
    out = np.full(first[-1], END, U64)
    out[np.arange(len(words.hash)) + np.searchsorted(words.first[1:], np.arange(len(words.hash)), "right")] = words.hash
    return out, first


def pack(values: np.ndarray) -> bytes:
    """Whole numbers by planes of their bytes, compressed; the first byte is their width."""
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    raw = np.ascontiguousarray(planes).tobytes()
    return bytes([width]) + len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True) if raw else b""


def unpack(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.int64)
    width, n = data[0], int.from_bytes(data[1:9], "little")
    raw = pa.decompress(data[9:], width * n, codec="zstd", asbytes=True)
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T
    return out.reshape(-1).view(np.int64)


def packs(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """One binary for each run between cuts."""
    return pa.array([pack(values[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())


def unpacks(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The runs in one, and where each begins, with one more at the end."""
    parts = [unpack(x.as_py()) for x in column]
    return np.concatenate([np.zeros(0, np.int64), *parts]), np.concatenate(([0], np.cumsum([len(p) for p in parts], dtype=np.int64)))


def steps(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Differences to the value before; the value itself where a run begins."""
    out = np.diff(values, prepend=0)
    out[begins] = values[begins]
    return out


def summed(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """What ``steps`` was made from."""
    total = np.cumsum(values)
    base = total[begins] - values[begins]
    return total - np.repeat(base, np.diff(np.append(begins, len(values))))


def joint(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs in order, as places where each occurs, and each pair's number."""
    wide = int(y.max()) + 1 if len(y) else 1
    if len(x) and (int(x.max()) + 1) * wide >= 1 << 63:
        x, y = np.unique(x, return_inverse=True)[1], np.unique(y, return_inverse=True)[1]
        wide = int(y.max()) + 1
    both = x * wide + y
    order = np.argsort(both)
    both = both[order]
    new = np.diff(both, prepend=-1) != 0
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def added(number: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    """Counts by number, exact up to 2^53."""
    return np.bincount(number, n, size).astype(np.int64)


def ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``first[i] ... first[i] + size[i] - 1`` of all ``i`` in turn."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def _blocks(key: str, text: str, train: str, word_bits: int):
    """Texts in blocks: tokens as ranks in the block's own list of words, the start of a text being 0."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple[pa.Array, pa.Array, np.ndarray, np.ndarray]] = []

        def block() -> pa.RecordBatch:
            ids, trains = (pa.concat_arrays([h[i] for h in held]) for i in (0, 1))
            size = np.concatenate([h[3] for h in held])
            words, code, many = np.unique(np.concatenate([h[2] for h in held]), return_inverse=True, return_counts=True)
            held.clear()
            used = trains.to_numpy(zero_copy_only=False).astype(bool)
            n = added(code, np.repeat(used, size), len(words))
            order = np.argsort(-many, kind="stable")
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(1, len(order) + 1)
            words, n = np.append(START, words[order]), np.append(used.sum(), n[order])
            bucket = (words >> U64(64 - word_bits)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([f"{task}-{number}"]), pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                    *(pa.array([pack(x)], pa.binary()) for x in (size, used, rank[code], bucket)),
                    pa.array([words.tobytes()], pa.binary()), pa.array([pack(n)], pa.binary()),
                ],
                ["block", "ids", "sizes", "trains", "codes", "places", "words", "n"],
            )

        for batch in all_chunks(batches, text):
            words, first = tokens(batch.column(text))
            held.append((batch.column(key), batch.column(train), words, np.diff(first)))
            if sum(len(h[2]) for h in held) >= BLOCK_TOKENS:
                yield block()
                number += 1
        if held:
            yield block()

    return run


def _by_place(place: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by bucket, the buckets that occur, and where each begins, with one more at the end."""
    order = np.argsort(place, kind="stable")
    cuts = np.searchsorted(place[order], np.arange((1 << bits) + 1))
    some = np.flatnonzero(np.diff(cuts))
    return order, some, np.append(cuts[some], len(place))


def _word_posts(bits: int):
    """Words of a block with their training counts, by bucket, in the order of their ranks."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, n = np.frombuffer(row["words"], U64), unpack(row["n"])
                order, some, cuts = _by_place(unpack(row["places"]), bits)
                words = words[order]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["block"]] * len(some), pa.string()), pa.array(some.astype(np.int32)),
                     pa.array([words[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary()), packs(n[order], cuts)],
                    ["block", "bucket", "words", "n"],
                )

    return run


def _numbered(bits: int):
    """Numbers and counts of a bucket's words for each block that has them; tokens and distinct words of the bucket."""
    def run(rows: pa.Table) -> pa.Table:
        size = [len(x.as_py()) // 8 for x in rows["words"]]
        words = np.concatenate([np.frombuffer(x.as_py(), U64) for x in rows["words"]])
        words, at = np.unique(words, return_inverse=True)
        n = added(at, unpacks(rows["n"])[0], len(words))
        order = np.lexsort((words, -n))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        number = (rank << bits) + rows["bucket"][0].as_py()
        cuts = np.concatenate(([0], np.cumsum(size)))
        own = words != START
        totals = [pa.array(np.full(rows.num_rows, x), pa.int64()) for x in (n[own].sum(), (n[own] > 0).sum())]
        return pa.table([rows["block"], rows["bucket"], packs(number[at], cuts), packs(n[at], cuts), *totals], ["block", "bucket", "numbers", "n", "tokens", "distinct"])

    return run


class Block:
    """Tokens of a block, its distinct pairs and the words behind each, all in the order of the words' numbers."""

    def __init__(self, row: dict, numbers: np.ndarray, word_bits: int, bits: int) -> None:
        order, _, _ = _by_place(unpack(row["places"]), word_bits)
        number = np.empty(len(order), np.int64)
        number[order] = numbers  # by rank
        by_number = np.argsort(number)
        local = np.empty(len(order), np.int64)
        local[by_number] = np.arange(len(order))
        self.numbers, self.posted = number[by_number], local[order]
        self.size = unpack(row["sizes"])
        self.first = np.concatenate(([0], np.cumsum(self.size)))
        self.start = int(local[0])
        self.word = local[unpack(row["codes"])]
        begins, ends = self.first[:-1], self.first[1:] - 1
        before = np.roll(self.word, 1)
        before[begins] = self.start
        behind = np.roll(self.word, -1)
        self.end = int(self.word[ends[0]])
        behind[ends] = self.end  # nothing is behind an end: a second one stands there
        at, self.pair_at = joint(before, self.word)
        self.left, self.right = before[at], self.word[at]
        at, self.gram_at = joint(self.pair_at, behind)
        self.head, self.tail = self.pair_at[at], behind[at]
        self.follows = np.roll(self.pair_at, -1)[at]  # the pair that an n-gram ends with, unless an end closes its first
        self.used = np.repeat(unpack(row["trains"]), self.size)
        place = mix(self.numbers[self.left].astype(U64) * _LEFT + self.numbers[self.right].astype(U64) * _RIGHT) >> U64(64 - bits)
        self.pair_order, self.buckets, self.pair_cuts = _by_place(place.astype(np.int64), bits)
        width = np.bincount(self.head, minlength=len(self.left))
        self.width = width[self.pair_order]
        self.gram_order = ranges((np.cumsum(width) - width)[self.pair_order], self.width)
        self.gram_cuts = np.concatenate(([0], np.cumsum(self.width)))[self.pair_cuts]

    def posts(self, block: str) -> pa.Table:
        left, right = self.numbers[self.left[self.pair_order]], self.numbers[self.right[self.pair_order]]
        new = np.zeros(len(left), bool)
        new[self.pair_cuts[:-1]] = True
        a = steps(left, np.flatnonzero(new))
        b = steps(right, np.flatnonzero(new | (np.diff(left, prepend=-1) != 0)))
        c = steps(self.numbers[self.tail[self.gram_order]], np.cumsum(self.width) - self.width)
        n = added(self.gram_at, self.used, len(self.head))[self.gram_order]
        columns = [packs(x, self.pair_cuts) for x in (a, b, self.width)] + [packs(x, self.gram_cuts) for x in (c, n)]
        return pa.table([pa.array([block] * len(self.buckets), pa.string()), pa.array(self.buckets.astype(np.int32)), *columns], ["block", "bucket", *"abkcn"])


def _counted(word_bits: int):
    """A bucket's posts added up and answered in their order; and the distinct words behind each left word."""
    def run(rows: pa.Table) -> pa.Table:
        (a, cuts), (b, _), (k, _), (c, gram_cuts), (n, _) = (unpacks(rows[x]) for x in "abkcn")
        new = np.zeros(len(a), bool)
        new[cuts[:-1]] = True
        left = summed(a, np.flatnonzero(new))
        right = summed(b, np.flatnonzero(new | (np.diff(left, prepend=-1) != 0)))
        tail = summed(c, np.cumsum(k) - k)
        at, pair = joint(left, right)
        first, gram = joint(np.repeat(pair, k), tail)
        count = added(gram, n, len(first))
        head = np.repeat(pair, k)[first]
        total, kinds = added(head, count, len(at)), np.bincount(head, count > 0, len(at)).astype(np.int64)
        words, which = np.unique(left[at], return_inverse=True)
        followers = np.bincount(which, total > 0, len(words)).astype(np.int64)
        order, some, word_cuts = _by_place(words & ((1 << word_bits) - 1), word_bits)
        return pa.table(
            [
                pa.array(rows["block"].to_pylist() + [None] * len(some), pa.string()), pa.array(rows["bucket"].to_pylist() + some.tolist(), pa.int32()),
                pa.concat_arrays([packs(count[gram], gram_cuts), packs(words[order], word_cuts)]),
                pa.concat_arrays([packs(total[pair], cuts), packs(followers[order], word_cuts)]),
                pa.concat_arrays([packs(kinds[pair], cuts), pa.nulls(len(some), pa.binary())]),
            ],
            ["block", "bucket", "x", "y", "z"],
        )

    return run


def _followed(words: pa.Table, partial: pa.Table) -> pa.Table:
    """To the words of blocks the distinct words behind each, added up over the buckets of pairs."""
    number, at = np.unique(unpacks(partial["x"])[0], return_inverse=True)
    kinds = added(at, unpacks(partial["y"])[0], len(number))
    asked, cuts = unpacks(words["numbers"])
    at = np.minimum(np.searchsorted(number, asked), max(len(number) - 1, 0))
    found = np.where(number[at] == asked, kinds[at], 0) if len(number) else np.zeros(len(asked), np.int64)
    return pa.table([words["block"], words["bucket"], words["numbers"], words["n"], packs(found, cuts)], ["block", "bucket", "x", "y", "z"])


class Automaton:
    """The part of the automaton that a block's n-grams touch.

    States: the root 0, words from 1 on, then pairs. Arcs lie sorted by (state, word); each state
    but the root has a failure arc. The root has an arc for every word.
    """

    def __init__(
        self, word_n: np.ndarray, word_kinds: np.ndarray, tokens: int, distinct: int, start: int, end: int,
        left: np.ndarray, right: np.ndarray, pair_n: np.ndarray, pair_kinds: np.ndarray,
        head: np.ndarray, tail: np.ndarray, follows: np.ndarray, gram_n: np.ndarray,
    ) -> None:
        words, pairs = len(word_n), len(left)
        self.words, self.start = words, start
        base = (word_n + FLOOR) / (tokens + FLOOR * (distinct + 1))
        self.base = np.log10(base)
        behind = np.where(np.arange(words) == end, 0, word_n)  # tokens behind a word, and behind the start of texts
        fail_one = np.where(behind > 0, DISCOUNT * word_kinds / np.maximum(behind, 1), 1)
        two = np.where(behind[left] > 0, np.maximum(pair_n - DISCOUNT, 0) / np.maximum(behind[left], 1) + fail_one[left] * base[right], base[right])
        fail_two = np.where(pair_n > 0, DISCOUNT * pair_kinds / np.maximum(pair_n, 1), 1)
        own = (gram_n > 0) & (right[head] != end)
        three = (gram_n[own] - DISCOUNT) / pair_n[head[own]] + fail_two[head[own]] * two[follows[own]]
        seen = np.flatnonzero(pair_n > 0)
        word_state = np.where(behind > 0, np.arange(words) + 1, 0)
        # a pair that an end closes is no state: a text is over there
        self.pair_state = np.where((pair_n > 0) & (right != end), np.arange(pairs) + words + 1, word_state[right])
        self.word_state = word_state
        self.arcs = np.concatenate((left[seen] + 1, head[own] + words + 1)) * words + np.concatenate((right[seen], tail[own]))
        self.arc_weight = np.log10(np.concatenate((two[seen], three)))
        self.arc_to = np.concatenate((self.pair_state[seen], self.pair_state[follows[own]]))
        self.pair_arc, self.gram_arc = np.full(pairs, -1), np.full(len(head), -1)
        self.pair_arc[seen] = np.arange(len(seen))
        self.gram_arc[own] = len(seen) + np.arange(len(three))
        self.fail_weight = np.log10(np.concatenate(([1], fail_one, fail_two)))
        self.fail_to = np.concatenate(([0], np.zeros(words, np.int64), word_state[right]))

    def search(self, word: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
        """Arcs of walks for their next words, from any states; -1 for none."""
        def arc(walk: np.ndarray, state: np.ndarray) -> np.ndarray:
            wanted = state * self.words + word[walk]
            at = np.minimum(np.searchsorted(self.arcs, wanted), max(len(self.arcs) - 1, 0))
            return np.where(self.arcs[at] == wanted, at, -1) if len(self.arcs) else np.full(len(walk), -1)

        return arc

    def step(self, state: np.ndarray, word: np.ndarray, arc: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """The log10 weight of each walk's next word and the state it leads to, by failure arcs where needed."""
        weight, to = np.zeros(len(state)), np.zeros(len(state), np.int64)
        walk = np.arange(len(state))
        while len(walk):
            root = state == 0
            found = arc(walk, state)
            found[root] = -1
            weight[walk[root]] += self.base[word[root]]
            to[walk[root]] = self.word_state[word[root]]
            has = found >= 0
            weight[walk[has]] += self.arc_weight[found[has]]
            to[walk[has]] = self.arc_to[found[has]]
            left = ~(root | has)
            weight[walk[left]] += self.fail_weight[state[left]]
            walk, state, word = walk[left], self.fail_to[state[left]], word[left]
        return weight, to

    def walk(self, word: np.ndarray, first: np.ndarray, pair_at: np.ndarray, gram_at: np.ndarray) -> np.ndarray:
        """Weights of all tokens: texts are walked side by side from left to right, long ones in pieces.

        Arcs need no search here: a word's state and a token are the token's pair, a pair's state
        and a token the n-gram that begins a token before.
        """
        short, long = self.pair_arc[pair_at], np.roll(self.gram_arc[gram_at], 1)
        size = np.diff(first)
        pieces = -(-size // WALK)
        begin = np.repeat(first[:-1] - WALK * (np.cumsum(pieces) - pieces), pieces) + WALK * np.arange(int(pieces.sum()))
        length = np.minimum(np.repeat(first[1:], pieces) - begin, WALK)
        state = np.where(np.isin(begin, first[:-1]), self.word_state[self.start], self.pair_state[pair_at[begin - 1]])
        order = np.argsort(-length, kind="stable")
        begin, length, state = begin[order], length[order], state[order]
        out = np.zeros(len(word))
        for t in range(int(length[0]) if len(length) else 0):
            at = begin[: int(np.searchsorted(-length, -t, "left"))] + t
            out[at], state = self.step(
                state[: len(at)], word[at], lambda walk, state: np.where(state > self.words, long[at[walk]], short[at[walk]])  # noqa: B023
            )
        return out


def lm_scores(docs: DataFrame, training: Column, key: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each row in, scored by the model of the rows for which ``training`` holds.

    Columns: ``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (unigrams with a
    floor) and ``score`` (the automaton), log10 probabilities of the whole text and its end. A null,
    empty or blank text is its end alone. Repeated rows score alike; training on them counts each.
    Without training rows both scores are 0 for each token. Only the named columns are read. Words
    are told apart by a 64-bit hash, n-grams by the numbers of their words.
    """
    scratch = Scratch(docs.sparkSession)
    train, = free_names([key, text], "train")
    letters = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # about six bytes a token
    bits, word_bits = (max(LEAST_BITS, math.ceil(math.log2(max(letters / 6 / size, 1)))) for size in (BUCKET_GRAMS, BUCKET_WORDS))
    kind = docs.schema[key].dataType.simpleString()
    blocks = scratch.keep(
        docs.select(key, text, F.coalesce(training, F.lit(False)).alias(train)).mapInArrow(
            _blocks(key, text, train, word_bits),
            f"block string, ids array<{kind}>, sizes binary, trains binary, codes binary, places binary, words binary, n binary",
        ), "lm-blocks",
    )
    words = scratch.keep(
        blocks.select("block", "places", "words", "n").mapInArrow(_word_posts(word_bits), "block string, bucket int, words binary, n binary")
        .groupBy("bucket").applyInArrow(_numbered(word_bits), "block string, bucket int, numbers binary, n binary, tokens long, distinct long"), "lm-words",
    )
    totals = words.select("bucket", "tokens", "distinct").distinct().agg(F.sum("tokens"), F.sum("distinct")).first()
    tokens_, distinct = totals[0] or 0, totals[1] or 0

    def post(rows: pa.Table, numbers: pa.Table) -> pa.Table:
        numbers = numbers.sort_by("bucket")
        row = rows.to_pylist()[0]
        return Block(row, unpacks(numbers["numbers"])[0], word_bits, bits).posts(row["block"])

    texts = blocks.select("block", "ids", "sizes", "trains", "codes", "places")
    posts = texts.drop("ids").groupBy("block").cogroup(words.select("block", "bucket", "numbers").groupBy("block")).applyInArrow(
        post, "block string, bucket int, a binary, b binary, k binary, c binary, n binary"
    )
    answer = "block string, bucket int, x binary, y binary, z binary"
    counted = scratch.keep(posts.groupBy("bucket").applyInArrow(_counted(word_bits), answer), "lm-counts")
    partial = counted.where("block is null").select("bucket", "x", "y")
    told = words.select("block", "bucket", "numbers", "n").groupBy("bucket").cogroup(partial.groupBy("bucket")).applyInArrow(_followed, answer)
    told = told.select("*", F.lit(True).alias("word")).union(counted.where("block is not null").select("*", F.lit(False)))
    names = [key, "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(rows: pa.Table, told: pa.Table) -> pa.Table:
        told = told.sort_by("bucket")
        own, grams = told.filter(told["word"]), told.filter(pc.invert(told["word"]))
        row = rows.drop_columns("ids").to_pylist()[0]
        block = Block(row, unpacks(own["x"])[0], word_bits, bits)

        def placed(column: pa.ChunkedArray, order: np.ndarray) -> np.ndarray:
            out = np.empty(len(order), np.int64)
            out[order] = unpacks(column)[0]
            return out

        word_n = placed(own["y"], block.posted)
        machine = Automaton(
            word_n, placed(own["z"], block.posted), tokens_, distinct, block.start, block.end,
            block.left, block.right, placed(grams["y"], block.pair_order), placed(grams["z"], block.pair_order),
            block.head, block.tail, block.follows, placed(grams["x"], block.gram_order),
        )
        add = lambda x: pa.array(np.add.reduceat(x, block.first[:-1]))
        ids = rows["ids"].combine_chunks().flatten()
        known = (word_n[block.word] > 0).astype(np.int64)
        gains = machine.walk(block.word, block.first, block.pair_at, block.gram_at)
        return pa.table([ids, pa.array(block.size), add(known), pa.array(np.full(len(ids), tokens_)), add(machine.base[block.word]), add(gains)], names)

    return texts.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        score, f"`{key}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    )


def op6_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return lm_scores(docs, ~held_out()).select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
