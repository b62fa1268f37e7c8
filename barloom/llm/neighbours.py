"""Operator 3: nearest neighbours by largest inner product, with vantage-point trees per shard.

Inner products become distances by one more coordinate: a candidate ``x`` gets
``sqrt(M^2 - |x|^2)`` for the largest norm ``M`` of its shard, a query gets 0, and then
``|q - x|^2 = |q|^2 + M^2 - 2 <q, x>``. Neighbours are ranked by the inner product itself, as a large
``M`` would round it away. Each shard holds a bounded number of vectors in a tree of
balls around vantage points; queries come in blocks of bounded size and go down together. The far
side of a ball is left out when the triangle inequality shows nothing nearer there: when the gap to
it, times ``factor``, exceeds the distance of the worst neighbour held. Factor 1 is exact, whatever
the norms, and is the default; more is faster and may miss some, nearly all where norms differ widely.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from barloom.llm.texts import table

SHARD, QUERY_BLOCK, LEAF = 4096, 4096, 128
#: Neighbours held beyond those asked for, so that rounding cannot push one out.
SPARE = 8
FACTOR = 1.0
#: Of the scale of distances, what rounding may shift one by.
ROUNDING = 1e-12


class VantageTree:
    """Balls around vantage points, down to leaves of at most ``LEAF`` points."""

    def __init__(self, points: np.ndarray, seed: int = 7, square: float | None = None) -> None:
        """``square``: the squared norm that all points share, if they do."""
        self.points = points
        own = (points**2).sum(axis=1)
        self.level = float(own.min(initial=np.inf)) if square is None else square
        #: Half of what a point's squared norm exceeds the level by.
        self.half = (own - self.level) / 2 if square is None else np.zeros(len(points))
        self.random = np.random.default_rng(seed)
        self.root = self._grow(np.arange(len(points)))

    def _grow(self, members: np.ndarray):
        if len(members) <= LEAF:
            return members
        at = members[self.random.integers(len(members))]
        distance = np.sqrt(((self.points[members] - self.points[at]) ** 2).sum(axis=1))
        radius = float(np.median(distance))
        inside = distance <= radius
        if inside.all():  # most points equally far: no ball parts them
            half = len(members) // 2
            inside = np.arange(len(members)) < half
            return at, float(distance[inside].max()), float(distance[~inside].min()), self._grow(members[inside]), self._grow(members[~inside])
        return at, float(distance[inside].max()), float(distance[~inside].min()), self._grow(members[inside]), self._grow(members[~inside])

    def search(self, queries: np.ndarray, k: int, factor: float) -> np.ndarray:
        """Places of each query's ``k`` nearest points, -1 where there are fewer; not ordered."""
        n = len(queries)
        self.best = np.full((n, k), np.inf)
        self.found = np.full((n, k), -1)
        self.queries, self.query_square, self.factor, self.k = queries, (queries**2).sum(axis=1), factor, k
        self.visited = 0
        self.slack = ROUNDING * (np.sqrt(self.query_square) + np.sqrt((self.level + 2 * self.half).max(initial=0)))
        self._visit(self.root, np.arange(n), np.zeros(n))
        return self.found

    def _visit(self, node, who: np.ndarray, gap: np.ndarray) -> None:
        """Queries ``who`` enter a node to which their distance is at least ``gap``."""
        if not len(who):
            return
        # held are half the squared distances without what all points share
        worst = np.sqrt(np.maximum(self.query_square[who] + self.level + 2 * self.best[who].max(axis=1), 0))
        near = gap * self.factor <= worst + self.slack[who]
        who, gap = who[near], gap[near]
        if not len(who):
            return
        if isinstance(node, np.ndarray):
            self.visited += len(who) * len(node)
            distance = np.concatenate((self.best[who], self.half[node] - self.queries[who] @ self.points[node].T), axis=1)
            places = np.concatenate((self.found[who], np.broadcast_to(node, (len(who), len(node)))), axis=1)
            top = np.argpartition(distance, self.k - 1, axis=1)[:, : self.k]
            self.best[who] = np.take_along_axis(distance, top, axis=1)
            self.found[who] = np.take_along_axis(places, top, axis=1)
            return
        at, inner, outer, inside, outside = node
        distance = np.sqrt(((self.queries[who] - self.points[at]) ** 2).sum(axis=1))
        to_inside = np.maximum(gap, distance - inner)
        to_outside = np.maximum(gap, outer - distance)
        first = to_inside <= to_outside
        # the nearer side first, so that the other can be left out
        self._visit(inside, who[first], to_inside[first])
        self._visit(outside, who[~first], to_outside[~first])
        self._visit(outside, who[first], to_outside[first])
        self._visit(inside, who[~first], to_inside[~first])


def shard_neighbours(ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float):
    """(query, candidate, score) rows of each query's best ``k`` in one shard, the query's own id left out."""
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    # equal vectors stand once in the tree; of each only the smallest ids can matter
    _, first, copy = np.unique(vectors, axis=0, return_index=True, return_inverse=True)
    copy = copy.reshape(-1)
    by_copy = np.argsort(copy, kind="stable")
    begin = np.searchsorted(copy[by_copy], np.arange(len(first)))
    size = np.minimum(np.diff(np.append(begin, len(ids))), k + 1)
    distinct = vectors[first].astype(np.float64)
    squares = (distinct**2).sum(axis=1)
    tree = VantageTree(np.column_stack((distinct, np.sqrt(squares.max() - squares))), square=float(squares.max()))
    exact = queries.astype(np.float64)
    held = tree.search(np.column_stack((exact, np.zeros(len(exact)))), min(k + 1 + SPARE, len(first)), factor)
    out_q, out_v, out_s = [], [], []
    for row in range(len(exact)):
        places = held[row][held[row] >= 0]
        score = (distinct[places] * exact[row]).sum(axis=1)
        times = size[places]
        at = np.repeat(begin[places] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        some, score = ids[by_copy[at]], np.repeat(score, times)
        other = some != query_ids[row]
        some, score = some[other], score[other]
        top = np.lexsort((some, -score))[:k]
        out_q.append(np.full(len(top), query_ids[row]))
        out_v.append(some[top])
        out_s.append(score[top])
    none = [np.zeros(0, np.int64)]
    return np.concatenate(out_q or none), np.concatenate(out_v or none), np.concatenate(out_s or [np.zeros(0)])


def usable(vector: Column) -> Column:
    """Vectors that take part: not null, not zero, all components finite."""
    infinite = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest(
    rows: DataFrame, asks: Column, k: int, factor: float = FACTOR, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``query_id``, ``rank``, ``key`` and ``score`` of the ``k`` largest inner products of each query.

    ``asks`` marks the queries among the rows; every other row is a candidate for them. Rows with a
    null key or a vector that is null, zero, or holds null or non-finite components take no part,
    nor does one whose number of components is not the commonest (the larger one of a tie). Of rows
    that repeat a key, the one with the smallest vector takes part. Ties go to the smaller key.
    """
    good = rows.where(F.col(key).isNotNull() & usable(F.col(vector))).groupBy(F.col(key).cast("long").alias("id")).agg(
        F.min(vector).alias("vector")
    )
    size = good.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    good = good.where(F.size("vector") == (size["size"] if size else 0)).withColumnRenamed("id", key)
    told = good.agg(F.count("*").alias("n"), F.count_if(asks).alias("asked")).first()
    shards, blocks = max(1, math.ceil(told["n"] / SHARD)), max(1, math.ceil(told["asked"] / QUERY_BLOCK))

    def spread(side: DataFrame, own: str, parts: int, other: str, of: int) -> DataFrame:
        return side.select(
            F.pmod(F.xxhash64(key), F.lit(parts)).alias(own), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(of - 1).cast("long"))).alias(other),
            F.col(key).alias("id"), "vector",
        )

    vectors, queries = spread(good, "shard", shards, "block", blocks), spread(good.where(asks), "block", blocks, "shard", shards)

    def matrix(side: pa.Table) -> np.ndarray:
        return side["vector"].combine_chunks().flatten().to_numpy().reshape(side.num_rows, -1)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            found = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        else:
            found = shard_neighbours(left["id"].to_numpy(), matrix(left), right["id"].to_numpy(), matrix(right), k, factor)
        return pa.table([pa.array(x) for x in found], ["query_id", key, "score"])

    found = vectors.groupBy("shard", "block").cogroup(queries.groupBy("shard", "block")).applyInArrow(
        search, f"query_id long, `{key}` long, score double"
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), key)
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", key, "score")


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)
