"""Operator 4: set-similarity join of texts on word shingles, exact.

Links are needed between sets whose Jaccard coefficient reaches a fraction ``num / den``.

1. *Tiles by size.* A tile takes the sets whose size lies in its band, as the smaller side, and the
   larger sets that can still reach the fraction with one of them. Nothing outside a tile can link.
2. *Places to meet.* Within a tile two linked sets differ in at most ``most`` shingles. The hash
   range is cut into more than ``most`` segments, so some segment holds the same shingles in both:
   its digest is the key under which they meet. Empty segments are no places to meet: there are
   ``spare`` segments more, and a set with more empty ones is cut again under another seed. Exact
   copies share all keys and count as one set; unrelated texts with a passage in common seldom
   agree on a whole segment. Keys are sent packed, with the bits that tell them and their sets
   apart in all likelihood; who only seems to meet is told apart by the exact test.
3. *Bitmaps.* Every set met by another has a hashed bitmap. Two sets differ in at least as many
   shingles as their bitmaps differ in bits, which bounds the overlap from above.
4. *Exact intersection* of the sorted shingle arrays for pairs that pass.

Sets of a key are first tried against its smallest only. Keys that still hold several components
are then gone through in blocks of bounded size. The first time a block gives only pairs that would
join components if they linked, then up to ``16`` and ``128`` pairs a set, then all: near copies by
the thousand need about one trial each, most of them are one component before many pairs are tried,
and no link between different components is lost. Near copies share many keys, so a pair is left to
the smallest key that both bring along, wherever else it meets.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barloom.llm.graph import components
from barloom.llm.scratch import Scratch
from barloom.llm.texts import U64, all_chunks, free_names, i64, mix, table, words_of

BITS = 1024
BLOCK = 1024
ROWS = 128
SEEDS = 3
#: Keys that a set brings along, the smallest of its own, to tell pairs that meet elsewhere too.
LEAST_KEYS = 32
#: Words of such keys' bits looked at at once.
PAIR_WORDS = 1 << 20
#: Words of 64 bits of the filter for texts that are asked for; a power of two.
FILTER_WORDS = 1 << 18
#: Exact sets a task remembers, so that their copies are not posted again.
SEEN = 200_000
#: Posts of a block of sets, packed together; and sets of a block that may share a key before they are told apart there.
BLOCK_POSTS = 1 << 19
HEAVY = 8
#: Characters of text for each bucket of keys, which bounds the posts that meet in a task (about one for 13 characters).
BUCKET_CHARS = 4_000_000
#: Bits of a set's id that its posts leave out.
PREFIX = 24


class Tiles:
    """Bands of set sizes, with the number of segments of each."""

    def __init__(self, num: int, den: int) -> None:
        self.num, self.den = num, den
        edge = [1]
        while edge[-1] < 1 << 31:
            edge.append(max(edge[-1] + 1, edge[-1] * 135 // 100))
        self.edge = np.array(edge)
        largest = self.edge[1:] - 1
        partner = largest * den // num
        self.reach = partner  # the largest set that a tile takes
        self.most = (largest + partner) * (den - num) // (den + num)
        m = self.most + 1.0
        empty = m * (1 - 1 / m) ** self.edge[:-1]
        self.spare = np.ceil(empty + 2 * np.sqrt(empty)).astype(np.int64) * (self.most > 0)
        self.segments = self.most + 1 + self.spare

    @lru_cache(maxsize=1 << 16)
    def of(self, size: int) -> tuple[int, ...]:
        own = int(np.searchsorted(self.edge, size, "right")) - 1
        found = [own]
        while found[-1] and size <= self.reach[found[-1] - 1]:
            found.append(found[-1] - 1)
        return tuple(found)

    def keys(self, shingles: np.ndarray) -> np.ndarray:
        """Where a set (sorted hashes) meets those it may link with."""
        out = []
        with np.errstate(over="ignore"):
            digest = mix(shingles + U64(0xA0761D6478BD642F))
            for tile in self.of(len(shingles)):
                m, spare = int(self.segments[tile]), int(self.spare[tile])
                for seed in range(SEEDS + 1):
                    base = U64((tile << 34) + (seed << 31))
                    if seed == SEEDS:  # empty under every seed tried: those meet each other
                        none = np.setdiff1d(np.arange(m), segment).astype(U64)
                        out.append(mix(mix(none + base) + U64(1)))
                        break
                    if seed:
                        value = mix(shingles + U64(seed))
                        order = np.argsort(value)
                        value, part = value[order], digest[order]
                    else:
                        value, part = shingles, digest
                    cut = ((value >> U64(32)) * U64(m)) >> U64(32)
                    first = np.flatnonzero(np.concatenate(([True], cut[1:] != cut[:-1])))
                    segment = cut[first].astype(np.int64)
                    out.append(mix(np.add.reduceat(part, first) + mix(cut[first] + base)))
                    if m - len(first) <= spare:
                        break
        return np.concatenate(out)


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """Whether the number of shingles at each place is odd: a set larger than the bitmap does not fill it."""
    bits = np.bincount((shingles & U64(BITS - 1)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def _sets(column: pa.Array, n: int) -> Iterator[np.ndarray]:
    hashes, first = words_of(column).shingles(n)
    for a, b in zip(first[:-1], first[1:], strict=True):
        yield np.unique(hashes[a:b])


def _identity(shingles: np.ndarray) -> int:
    with np.errstate(over="ignore"):
        total = mix(shingles ^ U64(0xE7037ED1A0B428DB)).sum() + U64(len(shingles))
        return int(mix(np.array([total], U64)).view(np.int64)[0])


def text_id(text: str) -> Column:
    """What tells texts apart: rows may share a key or have none."""
    return F.xxhash64(text).alias("text_id")


def set_sizes(docs: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """``key``, ``n_shingles``, ``text_id`` and ``set_id`` of each row; a set without shingles has no id."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_chunks(batches, text):
            sets = list(_sets(batch.column(text), n))
            ids = [_identity(x) if len(x) else None for x in sets]
            sizes = [len(x) for x in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(sizes, pa.int64()), batch.column("text_id"), pa.array(ids, pa.int64())],
                [key, "n_shingles", "text_id", "set_id"],
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text, text_id(text)).mapInArrow(run, f"`{key}` {kind}, n_shingles long, text_id long, set_id long")


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of sorted values, byte by byte of all: the upper ones hardly change and pack well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def _from_planes(data: np.ndarray, width: int) -> np.ndarray:
    out = np.zeros((len(data) // width, 8), np.uint8)
    out[:, :width] = data.reshape(width, -1).T
    return out.view("<u8").reshape(-1)


def posts(docs: DataFrame, n: int, tiles: Tiles, buckets: int, text: str) -> DataFrame:
    """``place`` and ``posts``: the keys of the sets, packed by bucket of keys.

    A post takes nine bytes: four of the key, as the bucket tells more of it, and five of the set's id.
    Of a key that more than ``HEAVY`` sets of a block share, its bucket hears of the first only; that
    these have met is known already, and they go by a place of their own, below zero.
    """
    def packed(keys: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        short = ((((keys >> U64(32)) * U64(buckets)) >> U64(32)) << U64(32)) | (keys & U64(0xFFFFFFFF))
        order = np.lexsort((ids, short))
        short, ids = short[order], ids[order]
        begins = np.concatenate(([True], short[1:] != short[:-1]))
        run = np.cumsum(begins) - 1
        heavy = (np.bincount(run) > HEAVY)[run]
        first = ids[np.flatnonzero(begins)[run]]
        place, rows = [], []
        if heavy.any():
            place.append(-1 - int(mix(short[:1])[0] >> U64(2)))
            rows.append(np.concatenate((short[heavy], ids[heavy], first[heavy])).tobytes())
        sent = begins | ~heavy
        short, ids = short[sent], ids[sent]
        bucket = (short >> U64(32)).astype(np.int64)
        cuts = [*np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1]))).tolist(), len(bucket)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            place.append(int(bucket[lo]))
            rows.append(_planes(short[lo:hi], 4) + _planes(ids[lo:hi], 5))
        return pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(rows, pa.binary())], ["place", "posts"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        keys: list[np.ndarray] = []
        ids: list[np.ndarray] = []
        held = 0
        for batch in all_chunks(batches, text):
            for shingles in _sets(batch.column(text), n):
                if not len(shingles) or (own := _identity(shingles)) in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(own)
                keys.append(tiles.keys(shingles))
                ids.append(np.full(len(keys[-1]), own >> PREFIX & 0xFFFFFFFFFF, U64))
                held += len(keys[-1])
                if held >= BLOCK_POSTS:
                    yield packed(np.concatenate(keys), np.concatenate(ids))
                    keys, ids, held = [], [], 0
        if held:
            yield packed(np.concatenate(keys), np.concatenate(ids))

    return docs.select(text).mapInArrow(run, "place long, posts binary")


def _meet(rows: pa.Table) -> pa.Table:
    """``key``, ``part`` of a set's id and the ``first`` of them, of keys that more than one set has; rows of one place."""
    place = rows["place"][0].as_py()
    short, ids, first = [], [], []
    for post in rows["posts"]:
        if place < 0:
            a, b, c = np.frombuffer(post.as_buffer(), U64).reshape(3, -1)
            short.append(a)
            ids.append(b)
            first.append(c)
        else:
            data = np.frombuffer(post.as_buffer(), np.uint8)
            count = len(data) // 9
            short.append(_from_planes(data[: 4 * count], 4) | U64(place << 32))
            ids.append(_from_planes(data[4 * count :], 5))
    short, ids = np.concatenate(short), np.concatenate(ids)
    if place < 0:
        first = np.concatenate(first)
    else:
        order = np.lexsort((ids, short))
        short, ids = short[order], ids[order]
        new = np.concatenate(([True], (short[1:] != short[:-1]) | (ids[1:] != ids[:-1])))
        short, ids = short[new], ids[new]
        begins = np.concatenate(([True], short[1:] != short[:-1]))
        run = np.cumsum(begins) - 1
        met = (np.bincount(run) > 1)[run]
        first = ids[np.flatnonzero(begins)[run]][met]
        short, ids = short[met], ids[met]
    return pa.table([i64(short), i64(ids), i64(first)], ["key", "part", "first"])


def shingle_sets(docs: DataFrame, n: int, text: str) -> DataFrame:
    """``set_id`` as given, size, bitmap and sorted shingles of texts."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_chunks(batches, text):
            sets = list(_sets(batch.column(text), n))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("set_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([bitmap(s) for s in sets], pa.list_(pa.int64())),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ],
                ["set_id", "size", "bits", "shingles"],
            )

    return docs.select("set_id", text).mapInArrow(
        run, "set_id long, size long, bits array<long>, shingles array<long>"
    )


def _perhaps(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``set_id`` is not wanted, before they move: by a bitmap of fixed size."""
    word = F.col("set_id").bitwiseAND(FILTER_WORDS - 1).alias("word")
    bit = "cast(shiftrightunsigned(set_id, 58) as int)"
    words = wanted.groupBy(word).agg(F.bit_or(F.expr(f"shiftleft(1L, {bit})")).alias("there"))
    # at most FILTER_WORDS rows, however many ids there are
    return rows.select("*", word).join(F.broadcast(words), "word").where(f"(shiftright(there, {bit}) & 1) = 1").drop("word", "there")


def _reaches(overlap: Column, sizes: Column, num: int, den: int) -> Column:
    return overlap * den >= (sizes - overlap) * num


def _bounded(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose sizes and bitmaps allow the fraction."""
    side = lambda x: sets.select(F.col("set_id").alias(x), F.col("size").alias(f"size_{x}"), F.col("bits").alias(f"bits_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    apart = F.aggregate(F.zip_with("bits_a", "bits_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    sizes = F.col("size_a") + F.col("size_b")
    return both.where(_reaches(F.floor((sizes - apart) / 2), sizes, num, den)).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs whose shingles truly reach the fraction."""
    side = lambda x: sets.select(F.col("set_id").alias(x), F.col("size").alias(f"size_{x}"), F.col("shingles").alias(f"shingles_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    overlap = F.size(F.array_intersect("shingles_a", "shingles_b")).cast("long")
    return both.where(_reaches(overlap, F.col("size_a") + F.col("size_b"), num, den)).select("a", "b")


def _tile_pairs(num: int, den: int, limit: int):
    """Pairs of different components in a tile that sizes and bitmaps allow; rows come sorted by tile.

    ``limit``: pairs of a set with later ones; 0 for pairs that join what earlier ones have not.
    ``more``: some allowed pair was left for another time.
    """
    def root(joined: dict[int, int], x: int) -> int:
        while (up := joined.get(x, x)) != x:
            joined[x] = joined.get(up, up)
            x = up
        return x

    def smaller_keys(rows: pa.Table) -> np.ndarray:
        """Which of the keys below the tile's own each member brings along, of those that several do; a bit each."""
        lists = rows["least_keys"].combine_chunks()
        keys = lists.flatten().to_numpy()
        member = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        below = keys < rows["key"][0].as_py()
        found, code, many = np.unique(keys[below], return_inverse=True, return_counts=True)
        several = many > 1
        place = np.cumsum(several) - 1
        kept = several[code]
        out = np.zeros((len(lists), (int(several.sum()) + 63) // 64), U64)
        at = place[code[kept]]
        np.bitwise_or.at(out, (member[below][kept], at >> 6), U64(1) << (at & 63).astype(U64))
        return out

    def share_none(holds: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Which of the pairs have no smaller key at which both meet."""
        step = max(1, PAIR_WORDS // holds.shape[1])
        return np.concatenate([~(holds[x[k : k + step]] & holds[y[k : k + step]]).any(axis=1) for k in range(0, len(x), step)])

    def tile(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, bool]:
        ids, size = rows["set_id"].to_numpy(), rows["size"].to_numpy()
        label, block = rows["label"].to_numpy(), rows["block"].to_numpy()
        bits = rows["bits"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1).view(U64)
        holds = smaller_keys(rows)
        i, j = rows["i"][0].as_py(), rows["j"][0].as_py()
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        out, more = [], False
        joined: dict[int, int] = {}
        for part in range(0, len(left), ROWS):
            x = left[part : part + ROWS]
            differ = np.zeros((len(x), len(right)), np.int64)
            for word in range(bits.shape[1]):
                differ += np.bitwise_count(bits[x, word][:, None] ^ bits[right, word])
            sizes = size[x][:, None] + size[right]
            overlap = (sizes - differ) // 2
            allowed = (overlap * den >= (sizes - overlap) * num) & (label[x][:, None] != label[right])
            if i == j:
                allowed &= right > x[:, None]
            if holds.shape[1] and allowed.any():
                at, to = np.nonzero(allowed)
                allowed[at, to] = share_none(holds, x[at], right[to])
            if limit:
                within = np.cumsum(allowed, axis=1) <= limit
                more |= bool((allowed & ~within).any())
                allowed &= within
            at, to = np.nonzero(allowed)
            pairs = np.stack((x[at], right[to]), axis=1)
            if not limit:
                new = []
                for row, (p, q) in enumerate(label[pairs].tolist()):
                    p, q = root(joined, p), root(joined, q)
                    if p != q:
                        joined[q] = p
                        new.append(row)
                more |= len(new) < len(pairs)
                pairs = pairs[new]
            out.append(ids[pairs])
        found = np.sort(np.concatenate(out).reshape(-1, 2), axis=1)
        return found[:, 0], found[:, 1], more

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.RecordBatch] = []
        at = None

        def close() -> Iterator[pa.RecordBatch]:
            if open_:
                a, b, more = tile(pa.Table.from_batches(open_))
                columns = [pa.array(np.full(len(a), at[0])), pa.array(a), pa.array(b), pa.array(np.full(len(a), more))]
                yield pa.RecordBatch.from_arrays(columns, ["key", "a", "b", "more"])

        for batch in batches:
            where = np.stack([batch.column(c).to_numpy() for c in ("key", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((where[1:] != where[:-1]).any(axis=1)) + 1), len(where)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi == lo:
                    continue
                if tuple(where[lo]) != at:
                    yield from close()
                    open_, at = [], tuple(where[lo])
                open_.append(batch.slice(lo, hi - lo))
        yield from close()

    return run


def _members(met: DataFrame, labels: DataFrame, sets: DataFrame) -> DataFrame:
    """Sets of keys that hold several components, sorted by tile: pairs of blocks of one key.

    Keys under which the same sets meet count once: two texts alike share many of them.
    """
    labelled = met.join(labels.withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "key", "set_id", F.coalesce("label", "set_id").alias("label")
    )
    mixed = labelled.groupBy("key").agg(
        F.min("label").alias("x"), F.max("label").alias("y"), F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("set_id")).alias("mark"), F.bit_xor(F.xxhash64("set_id", F.lit(1))).alias("mark_2"),
    ).where("x <> y")
    mixed = mixed.groupBy("n", "mark", "mark_2").agg(F.min("key").alias("key")).select("key")
    members = labelled.join(mixed, "key", "left_semi")
    place = Window.partitionBy("key").orderBy("set_id")
    members = members.withColumn("block", F.floor((F.row_number().over(place) - 1) / BLOCK)).withColumn(
        "blocks", F.max("block").over(Window.partitionBy("key"))
    )
    # a set's keys grow with its own size; a part of them is enough, as a pair is only left to a key that both show
    own = members.groupBy("set_id").agg(F.slice(F.sort_array(F.collect_list("key")), 1, LEAST_KEYS).alias("least_keys"))
    members = members.join(sets.select("set_id", "size", "bits").join(own, "set_id"), "set_id").withColumn(
        "other", F.explode(F.expr("sequence(0L, blocks)"))
    ).select(
        "key", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "set_id", "label", "size", "bits", "least_keys"
    )
    return members.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def _components(docs: DataFrame, n: int, num: int, den: int, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Rows as ``key``, ``n_shingles``, ``text_id``, ``set_id``; and sets as ``set_id``, ``label``, ``component_id``."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    tiles = Tiles(num, den)
    chars = docs.select(F.sum(F.length(text)).alias("chars")).first()["chars"] or 0
    buckets = max(1, math.ceil(chars / BUCKET_CHARS))
    met = scratch.keep(
        posts(docs, n, tiles, buckets, text).groupBy("place").applyInArrow(_meet, "key long, part long, first long"), "jaccard-posts"
    )
    signed = scratch.keep(set_sizes(docs, n, key, text), "jaccard-sizes")
    # from here on a set goes by the least hash of its texts: where these meet, it is made and stays
    ids = scratch.keep(
        signed.where("set_id is not null").groupBy("set_id").agg(F.min("text_id").alias("text_id")).select(
            F.col("text_id").alias("set_id"), F.expr(f"shiftrightunsigned(set_id, {PREFIX})").alias("part")
        ), "jaccard-ids",
    )
    met = scratch.keep(met.join(ids, "part").select("key", "set_id", "first"), "jaccard-met")
    scratch.drop("jaccard-posts")
    first = met.select("first", "set_id").distinct().join(ids.select(F.col("part").alias("first"), F.col("set_id").alias("a")), "first")
    first = first.select("a", F.col("set_id").alias("b"))
    # sets whose ids begin alike look like one where they meet
    alike = ids.groupBy("part").agg(F.min("set_id").alias("a"), F.max("set_id").alias("b"))
    first = scratch.keep(first.union(alike.select("a", "b")).where("a <> b").distinct(), "jaccard-starts")
    wanted = scratch.keep(first.select(F.explode(F.array("a", "b")).alias("set_id")).distinct(), "jaccard-wanted")
    texts = _perhaps(docs.select(text_id(text).alias("set_id"), text), wanted).groupBy("set_id").agg(F.first(text).alias(text)).join(wanted, "set_id", "left_semi")
    sets = scratch.keep_in_buckets(shingle_sets(texts, n, text), "jaccard-sets", "set_id")

    first = scratch.keep(_bounded(first, sets, num, den), "jaccard-first")
    links = scratch.keep(_verified(first, sets, num, den), "jaccard-links")
    labels = components(links, scratch)

    tried, keys = first, met.select("key", "set_id").distinct()
    for step, limit in enumerate((0, 16, 128, BLOCK)):
        pairs = scratch.keep(
            _members(keys, labels, sets).mapInArrow(_tile_pairs(num, den, limit), "key long, a long, b long, more boolean"), f"jaccard-pairs-{step}"
        )
        new = scratch.keep(pairs.select("a", "b").distinct().join(tried, ["a", "b"], "left_anti"), f"jaccard-tried-{step}")
        found = scratch.keep(_verified(new, sets, num, den), f"jaccard-links-{step}")
        tried = tried.union(new)
        if found.limit(1).count():
            links = links.union(found)
            labels = components(links, scratch)
        left = scratch.keep(pairs.where("more").select("key").distinct(), f"jaccard-left-{step}")
        scratch.drop(f"jaccard-pairs-{step}")
        if not left.limit(1).count():
            break
        keys = met.select("key", "set_id").distinct().join(left, "key", "left_semi")

    numbered = signed.where("set_id is not null").groupBy("set_id").agg(F.min(key).alias("least"), F.min("text_id").alias("node"))
    numbered = numbered.join(labels, "node", "left").select("set_id", "least", F.coalesce("label", "node").alias("label"))
    smallest = numbered.groupBy("label").agg(F.min("least").alias("component_id"))
    owner = scratch.keep(numbered.join(smallest, "label").select("set_id", "label", "component_id"), "jaccard-components")
    scratch.drop(*(n for n in list(scratch.folders) if n not in ("jaccard-sizes", "jaccard-components")))
    return signed, owner


def jaccard_components(
    docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_shingles`` (set size) and ``component_id``, one row for each row in.

    ``component_id`` is the smallest key reachable by links. A text of fewer than ``n`` words is one
    shingle. A null, empty or blank text has no shingles, links with nothing and is its own
    component; a row without key takes its component's smallest key, or null. Repeated rows are
    copies like any other. Only ``key`` and ``text`` are read, so other names cannot clash.
    Shingles are 64-bit hashes; sets and texts are told apart by a 64-bit hash of theirs.
    """
    signed, owner = _components(docs, n, num, den, key, text)
    return signed.select(key, "n_shingles", "set_id").join(owner, "set_id", "left").select(
        key, "n_shingles", F.when(F.col("set_id").isNull(), F.col(key)).otherwise(F.col("component_id")).alias("component_id")
    )


def one_of_each_component(
    docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Of the rows of a component, the first by key (null last), hash of the text and the other columns.

    Rows are told apart by their texts, so a key may repeat with other texts or be missing. Null,
    empty and blank texts link with nothing and all stay.
    """
    signed, owner = _components(docs, n, num, den, key, text)
    mark, place = free_names(docs.columns, "__text", "__place")
    first = signed.join(owner.select("set_id", "label"), "set_id").groupBy("label").agg(
        F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "text_id")).alias("first")
    ).select(F.col("first.text_id").alias(mark))
    worded = F.coalesce(F.col(text).rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    others = [F.to_json(F.struct(*[f"`{c}`" for c in docs.columns if c not in (key, text)]))] if len(docs.columns) > 2 else []
    order = Window.partitionBy(mark).orderBy(F.col(key).asc_nulls_last(), *others)
    # copies of a text meet by its hash, all but the first of each task left out before
    copies = docs.where(worded).withColumn(mark, text_id(text)).withColumn(place, F.row_number().over(order)).where(F.col(place) == 1)
    return copies.join(first, mark, "left_semi").select(*[f"`{c}`" for c in docs.columns]).union(docs.where(~worded))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=4, num=85, den=100)


#: The query's rows for one row an id, by way of all pairs that share a shingle.
OP4_SQL = r"""
with recursive words as (
  select doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) end as s
  from words),
shingles as (select doc_id, len(s) as n, unnest(s) as g from sets),
pairs as (
  select a.doc_id as a, b.doc_id as b, count(*) as shared, any_value(a.n) as n, any_value(b.n) as m
  from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (
  select a, b from pairs where 100 * shared >= 85 * (n + m - shared)
  union all select b, a from pairs where 100 * shared >= 85 * (n + m - shared)),
reach(x, y) as (
  select doc_id, doc_id from documents
  union select r.x, l.b from reach r join links l on r.y = l.a)
select doc_id, len(s)::bigint as n_shingles, component_id
from sets join (select x, min(y) as component_id from reach group by x) on doc_id = x
"""
