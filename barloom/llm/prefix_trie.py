"""Operator 11: the trie of all conversations' prefixes, by Z-fast tries.

A turn is known by a digest of its role and text, and a prefix of ``d`` turns by a digest chained
over them, so equal prefixes have equal digests wherever they are met.

1. *Local tries.* Each task keeps a compacted trie of the conversations it reads. Its nodes lie in a
   hash table under their handle: the digest of the prefix whose length, of those on the edge to the
   node, divides by the largest power of two (the two-fattest number). A conversation's exit node is
   found by fat binary search, in about as many look-ups as its length has binary digits. Batches are
   inserted after equal sequences have become one. When a trie has grown to ``ENTRIES`` prefixes its
   edges are expanded to one row a node, and the next one is begun, so memory is bounded and copies
   have shrunk before anything moves.
2. *Merging.* Rows of one node meet by digest: members add up, the smallest id is kept.
3. *Subtrees.* A node belongs to its smallest member; what a conversation owns is the lower end of its
   path, its *chain*. Sums along chains, and of whole chains over the prefixes above them, give
   all subtree sums without going down level by level.
4. *Ends.* Ids of conversations that end at a node are sorted by ranges, so that a hot node is
   spread over tasks, joined there into long pieces, and only the pieces of a node meet.

Digests are 128 bits of SHA-256 or BLAKE2; two prefixes are taken for one if they agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from barloom.llm.scratch import Scratch
from barloom.llm.texts import table

WIDTH = 16
ROOT = bytes(WIDTH)
#: Prefixes a local trie may hold before it is handed out.
ENTRIES = 1 << 18
#: Characters of joined ids that are moved as one piece.
PIECE = 1 << 18
#: Rows handed out at once.
ROWS = 1 << 16

NODE, PARENT = ["h1", "h2"], ["p1", "p2"]


def turn_sequences(
    conversations: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row a conversation: ``key`` and ``turns``, its turns' digests and lengths in code points.

    Turns go by ``turn``, null first; those that tie by their digest. Null roles and texts count as
    empty. Rows without ``key`` belong to no conversation and are left out. Only digests are moved;
    a conversation's must fit a row.
    """
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    whole = F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said)
    turns = conversations.where(F.col(key).isNotNull()).select(
        F.col(key),
        F.struct(
            F.col(turn).alias("turn"), F.substring(F.unhex(F.sha2(whole, 256)), 1, WIDTH).alias("digest"), F.length(said).alias("length")
        ).alias("turn"),
    )
    in_order = F.sort_array(F.collect_list("turn"))
    return turns.groupBy(key).agg(
        F.transform(in_order, lambda t: F.struct(t["digest"].alias("digest"), t["length"].alias("length"))).alias("turns")
    )


def two_fattest(low: int, high: int) -> int:
    """The number in (low, high] that divides by the largest power of two."""
    return high & (-1 << ((low ^ high).bit_length() - 1))


class Node:
    """A compacted node: the first ``end`` turns of ``path``; ``n`` sequences end here, ``least`` their smallest id."""

    __slots__ = ("end", "path", "lengths", "above", "below", "n", "least")

    def __init__(self, end: int, path: bytes, lengths: list[int], above: Node | None) -> None:
        self.end, self.path, self.lengths, self.above = end, path, lengths, above
        self.below: dict[bytes, Node] = {}
        self.n, self.least = 0, None

    def prefix(self, depth: int) -> bytes:
        return self.path[depth * WIDTH : (depth + 1) * WIDTH]

    def handle(self) -> bytes:
        return self.prefix(two_fattest(self.above.end, self.end))


class ZFastTrie:
    """Sequences given as the digests of all their prefixes, the empty one first, in one string."""

    def __init__(self) -> None:
        self.root = Node(0, ROOT, [], None)
        self.handles: dict[bytes, Node] = {}
        self.entries = 0

    def locate(self, path: bytes, depth: int) -> tuple[Node, Node | None]:
        """The deepest node on the path, and the exit node below it on whose edge the path goes on."""
        low, high, at = 0, depth, self.root
        while low < high:
            fat = two_fattest(low, high)
            node = self.handles.get(path[fat * WIDTH : (fat + 1) * WIDTH])
            if node is None:
                high = fat - 1
            elif node.end <= depth and node.prefix(node.end) == path[node.end * WIDTH : (node.end + 1) * WIDTH]:
                at, low = node, node.end
            else:
                return node.above, node
        return at, at.below.get(path[(at.end + 1) * WIDTH : (at.end + 2) * WIDTH])

    def insert(self, path: bytes, lengths: list[int], n: int, least) -> None:
        """Add ``n`` equal sequences, ``least`` being their smallest id."""
        depth = len(path) // WIDTH - 1
        at, exit_node = self.locate(path, depth)
        if exit_node is not None:
            at = self._split(at, exit_node, path, depth)
        if at.end < depth:
            leaf = Node(depth, path, lengths, at)
            at.below[leaf.prefix(at.end + 1)] = leaf
            self.handles[leaf.handle()] = leaf
            self.entries += depth + 1  # its whole path is held
            at = leaf
        at.n += n
        at.least = least if at.least is None else min(at.least, least)

    def _split(self, above: Node, node: Node, path: bytes, depth: int) -> Node:
        """A new node on the edge to ``node``, where the path leaves it."""
        low, high = above.end + 1, min(depth, node.end - 1)
        while low < high:
            middle = (low + high + 1) // 2
            if node.prefix(middle) == path[middle * WIDTH : (middle + 1) * WIDTH]:
                low = middle
            else:
                high = middle - 1
        del self.handles[node.handle()]
        between = Node(low, node.path, node.lengths, above)
        above.below[between.prefix(above.end + 1)] = between
        between.below[node.prefix(low + 1)] = node
        node.above = between
        self.handles[between.handle()] = between
        self.handles[node.handle()] = node
        return between

    def expanded(self) -> Iterator[tuple[bytes, bytes, range, list[int], int, object]]:
        """Every edge with what its nodes share: digests, those of their parents, depths, lengths, members, smallest id."""
        nodes = sorted([self.root, *self.handles.values()], key=lambda node: -node.end)
        for node in nodes:
            above = node.above
            if above is not None:
                above.n += node.n
                above.least = node.least if above.least is None else min(above.least, node.least)
                first, last = above.end, node.end
                yield (
                    node.path[(first + 1) * WIDTH : (last + 1) * WIDTH], node.path[first * WIDTH : last * WIDTH],
                    range(first + 1, last + 1), node.lengths[first:last], node.n, node.least,
                )
            elif node.n:
                yield ROOT, ROOT, range(1), [0], node.n, node.least


def _halves(digests: bytes) -> list[pa.Array]:
    both = np.frombuffer(digests, np.int64).reshape(-1, 2)
    return [pa.array(np.ascontiguousarray(both[:, 0])), pa.array(np.ascontiguousarray(both[:, 1]))]


def paths(sequences: DataFrame, key: str = "conv_id", turns: str = "turns") -> DataFrame:
    """``key``, ``path`` (digests of all prefixes), ``lengths`` of the turns, ``depth`` and the last digest's halves."""
    kind = sequences.schema[key].dataType
    rows = sequences.select(F.col(key), F.transform(turns, lambda t: t["digest"]).alias("digests"), F.transform(turns, lambda t: t["length"]).alias("lengths"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, ends = [], []
            for digests in batch.column("digests").to_pylist():
                last, made = ROOT, [ROOT]
                for digest in digests:
                    last = hashlib.blake2b(last + digest, digest_size=WIDTH).digest()
                    made.append(last)
                out.append(b"".join(made))
                ends.append(last)
            depth = pa.array([len(p) // WIDTH - 1 for p in out], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), pa.array(out, pa.binary()), batch.column("lengths"), depth, *_halves(b"".join(ends))],
                [key, "path", "lengths", "depth", *NODE],
            )

    return rows.mapInArrow(run, f"`{key}` {kind.simpleString()}, path binary, lengths array<int>, depth int, h1 long, h2 long")


def local_nodes(found: DataFrame, key: str = "conv_id", entries: int = ENTRIES) -> DataFrame:
    """Nodes of the tries that tasks build over ``paths``: digests, depth, length, members, smallest id."""
    kind = found.schema[key].dataType

    def out(trie: ZFastTrie) -> Iterator[pa.RecordBatch]:
        own, above, depth, length, members, least = [], [], [], [], [], []

        def batch() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays(
                [*_halves(b"".join(own)), *_halves(b"".join(above)), pa.array(depth, pa.int32()), pa.array(length, pa.int32()),
                 pa.array(members, pa.int64()), pa.array(least, id_type)],
                [*NODE, *PARENT, "depth", "length", "n_convs", key],
            )
            for column in (own, above, depth, length, members, least):
                column.clear()
            return made

        for digests, parents, depths, lengths, n, smallest in trie.expanded():
            own.append(digests)
            above.append(parents)
            depth += depths
            length += lengths
            members += [n] * len(depths)
            least += [smallest] * len(depths)
            if len(depth) >= ROWS:
                yield batch()
        if depth:
            yield batch()

    id_type = to_arrow_type(kind)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = ZFastTrie()
        for batch in batches:
            # equal sequences of the batch become one before they are inserted
            same: dict[bytes, list] = {}
            for i, (path, least) in enumerate(zip(batch.column("path").to_pylist(), batch.column(key).to_pylist(), strict=True)):
                known = same.setdefault(path, [i, 0, least])
                known[1] += 1
                known[2] = min(known[2], least)
            lengths = batch.column("lengths")
            for path, (i, n, least) in same.items():
                trie.insert(path, lengths[i].as_py(), n, least)
                if trie.entries >= entries:
                    yield from out(trie)
                    trie = ZFastTrie()
        yield from out(trie)

    return found.select(key, "path", "lengths").mapInArrow(
        run, f"h1 long, h2 long, p1 long, p2 long, depth int, length int, n_convs long, `{key}` {kind.simpleString()}"
    )


def end_digests(found: DataFrame, key: str = "conv_id", piece: int = PIECE) -> DataFrame:
    """``ends_sha256`` of every node at which conversations end: their ids, rising, joined by commas."""
    kind = found.schema[key].dataType.simpleString()
    told = F.col(key).cast("string").alias("told")
    ranged = found.select(*NODE, key, told).repartitionByRange(*NODE, key).sortWithinPartitions(*NODE, key)

    def pieces(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # runs of a node's ids, in pieces; each batch ends its own
        for batch in batches:
            h1, h2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in NODE)
            ids = batch.column("told").to_pylist()
            new = np.ones(len(ids), bool)
            new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
            at = np.flatnonzero(new).tolist()
            first, texts = [], []
            for begin, end in zip(at, [*at[1:], len(ids)], strict=True):
                size, start = 0, begin
                for i in range(begin, end):
                    size += len(ids[i]) + 1
                    if size >= piece or i == end - 1:
                        first.append(start)
                        texts.append(",".join(ids[start : i + 1]))
                        size, start = 0, i + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(h1[first]), pa.array(h2[first]), batch.column(key).take(pa.array(first, pa.int64())), pa.array(texts, pa.string())],
                [*NODE, key, "piece"],
            )

    def hashed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # sorted by node and id: one running digest a node, however many pieces it has
        node, running = None, None
        for batch in batches:
            done: list[tuple] = []
            for *at, part in zip(*(batch.column(c).to_pylist() for c in (*NODE, "piece")), strict=True):
                if at != node:
                    if node is not None:
                        done.append((*node, running.hexdigest()))
                    node, running = at, hashlib.sha256(part.encode())
                else:
                    running.update(b"," + part.encode())
            yield rows(done)
        if node is not None:
            yield rows([(*node, running.hexdigest())])

    def rows(done: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*done, strict=True)) or [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], [*NODE, "ends_sha256"]
        )

    joined = ranged.mapInArrow(pieces, f"h1 long, h2 long, `{key}` {kind}, piece string")
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, key).mapInArrow(hashed, "h1 long, h2 long, ends_sha256 string")


def above_chains(tops: DataFrame) -> DataFrame:
    """What whole chains add to each prefix above them; ``path`` holds the digests of these prefixes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = [len(p) // WIDTH for p in batch.column("path").to_pylist()]
            both = np.frombuffer(b"".join(batch.column("path").to_pylist()), np.int64).reshape(-1, 2)
            node, at = np.unique(both, axis=0, return_inverse=True)
            at = at.reshape(-1)
            sums = []
            for name in ("saved", "leaves"):
                total = np.zeros(len(node), np.int64)
                np.add.at(total, at, np.repeat(batch.column(name).to_numpy(zero_copy_only=False), size))
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(node[:, 0])), pa.array(np.ascontiguousarray(node[:, 1])), *sums], [*NODE, "saved", "leaves"]
            )

    return tops.select("path", "saved", "leaves").mapInArrow(run, "h1 long, h2 long, saved long, leaves long")


def trie_nodes(sequences: DataFrame, key: str = "conv_id", turns: str = "turns", entries: int = ENTRIES) -> DataFrame:
    """One row a node of the trie of all sequences, the empty root included.

    ``key`` (smallest member), ``depth``, ``parent_<key>`` (null for the root), ``n_convs``,
    ``n_children``, ``n_leaves`` and ``saved_tokens`` (over the subtree; the latter (n_convs - 1) times
    the code points of a node's last text), ``ends_sha256``. A node is named by its smallest member
    and its depth. Sequences without turns end at the root; a table without rows has no nodes. Keys
    are neither null nor repeated, as ``turn_sequences`` has them. Other columns are not kept.
    """
    scratch = Scratch(sequences.sparkSession)
    found = scratch.keep(paths(sequences, key, turns), "trie-paths")
    merged = local_nodes(found, key, entries).groupBy(*NODE).agg(
        *[F.first(c).alias(c) for c in (*PARENT, "depth", "length")], F.sum("n_convs").alias("n_convs"), F.min(key).alias(key)
    )
    nodes = scratch.keep(merged, "trie-nodes")
    children = nodes.where("depth > 0").groupBy(*[F.col(p).alias(h) for p, h in zip(PARENT, NODE, strict=True)]).agg(F.count("*").alias("n_children"))
    worth = nodes.join(children, NODE, "left").withColumns({
        "n_children": F.coalesce("n_children", F.lit(0).cast("long")),
        "own": (F.col("n_convs") - 1) * F.col("length"),
    }).withColumn("leaf", (F.col("n_children") == 0).cast("long"))

    # along a chain, from its lower end; the chain is one conversation's
    upwards = Window.partitionBy(key).orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    chained = scratch.keep(
        worth.withColumns({"saved_tokens": F.sum("own").over(upwards), "n_leaves": F.sum("leaf").over(upwards)}).drop("own", "leaf"), "trie-chains"
    )
    tops = chained.groupBy(key).agg(F.min("depth").alias("top"), F.max("saved_tokens").alias("saved"), F.max("n_leaves").alias("leaves"))
    tops = tops.where("top > 0 and (saved > 0 or leaves > 0)").join(found.select(key, F.col("path").alias("whole")), key)
    lifted = above_chains(tops.select(F.expr(f"substring(whole, 1, {WIDTH} * top)").alias("path"), "saved", "leaves"))
    lifted = lifted.groupBy(*NODE).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))

    owners = nodes.select(F.col(key).alias(f"parent_{key}"), *[F.col(h).alias(p) for h, p in zip(NODE, PARENT, strict=True)])
    nothing = hashlib.sha256(b"").hexdigest()
    whole = chained.join(lifted, NODE, "left").join(end_digests(found, key), NODE, "left").select(
        key, F.col("depth").cast("long").alias("depth"), "n_convs", "n_children",
        (F.col("n_leaves") + F.coalesce("leaves", F.lit(0))).alias("n_leaves"),
        (F.col("saved_tokens") + F.coalesce("saved", F.lit(0))).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"), *PARENT,
    )
    # children of a hot node meet their parent in a join that adaptive execution splits
    below = whole.where("depth > 0").join(owners, PARENT).drop(*PARENT)
    root = whole.where("depth = 0").drop(*PARENT).withColumn(f"parent_{key}", F.lit(None).cast(sequences.schema[key].dataType))
    return below.unionByName(root).select(
        key, "depth", f"parent_{key}", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
    )


def rebuilt(sequences: DataFrame, key: str = "conv_id", every: int = 100, most: int = 6) -> DataFrame:
    """Sequences whose first turns are those of the last conversation whose id divides by ``every``.

    ``h``, the unsigned CRC-32 of the decimal id modulo ``most``, turns are taken over (all if there
    are fewer, none if that conversation is absent) in place of the first ``h`` own ones.
    """
    bases = sequences.where(F.col(key) % every == 0).select(F.col(key).alias("base"), F.slice("turns", 1, most - 1).alias("lent"))
    rows = sequences.withColumns({
        "base": F.col(key) - F.col(key) % every,
        "h": (F.crc32(F.col(key).cast("string").cast("binary")) % most).cast("int"),
    }).join(bases, "base", "left")
    lent = F.slice(F.coalesce("lent", F.slice("turns", 1, 0)), 1, F.col("h"))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns") - F.col("h"), F.lit(0)))
    return rows.select(key, F.concat(lent, own).alias("turns"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_nodes(rebuilt(turn_sequences(table(spark, sf_dir, "conversations"))))


OP11_SQL = """
with told as (
    select conv_id, turn, length(coalesce(text, '')) n,
        left(sha256(strlen(coalesce(role, ''))::varchar || ':' || coalesce(role, '') || coalesce(text, '')), 32) k
    from conversations where conv_id is not null
),
own as (select conv_id, list({'k': k, 'n': n} order by turn nulls first, k) turns from told group by conv_id),
held as (
    select o.conv_id, o.turns, coalesce(b.turns, []) lent,
        xor(list_reduce(
            [4294967295::bigint] || list_transform(range(1, length(o.conv_id::varchar) + 1), lambda i: ascii(substr(o.conv_id::varchar, i, 1))::bigint),
            lambda a, c: list_reduce([xor(a, c)] || range(8), lambda x, r: xor(x >> 1, 3988292384 * (x & 1)))
        ), 4294967295) % 6 h
    from own o left join own b on b.conv_id = o.conv_id - o.conv_id % 100
),
made as (select conv_id, list_concat(list_slice(lent, 1, h), list_slice(turns, h + 1, len(turns))) turns from held),
steps as (select conv_id, turns, len(turns) l, unnest(range(len(turns) + 1)) d from made),
prefixes as (
    select conv_id, l, d, coalesce(turns[d].n, 0) n,
        md5(list_transform(list_slice(turns, 1, d), lambda t: t.k)::varchar) node,
        case when d > 0 then md5(list_transform(list_slice(turns, 1, d - 1), lambda t: t.k)::varchar) end parent
    from steps
),
nodes as (
    select node, d, any_value(parent) parent, min(conv_id) conv_id, count(*) n_convs, any_value(n) n,
        sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where d = l), '')) ends_sha256
    from prefixes group by node, d
),
kids as (select parent node, count(*) n_children from nodes where d > 0 group by parent),
chains as (
    select p.node, p.d,
        sum(case when g.conv_id = p.conv_id then (g.n_convs - 1) * g.n else 0 end) over up saved,
        sum(case when g.conv_id = p.conv_id and k.node is null then 1 else 0 end) over up leaves
    from prefixes p join nodes g using (node, d) left join kids k using (node)
    window up as (partition by p.conv_id order by p.d desc rows unbounded preceding)
),
sums as (select node, d, sum(saved)::bigint saved_tokens, sum(leaves)::bigint n_leaves from chains group by node, d)
select g.conv_id, g.d depth, o.conv_id parent_conv_id, g.n_convs, coalesce(k.n_children, 0) n_children, s.n_leaves, s.saved_tokens, g.ends_sha256
from nodes g join sums s using (node, d) left join kids k using (node) left join nodes o on o.node = g.parent and o.d = g.d - 1
"""
