"""Operator 12: whitening of embeddings, with covariances by polarisation.

Vectors are held in fixed point, ``x = floor(1024 * c) + 100000``, so that every sum over them is a
whole number and exact, whatever the order of its parts.

1. One pass sums every dimension. ``m``, the whole number nearest to the mean, centres the values:
   ``x - m`` is small, and what is left of the mean, ``r = sum(x - m)``, is known exactly.
2. A second pass sums the squared centred values of every dimension and of the sum of every two
   dimensions. These give exact variances; ``cov(a, b) = (var(a + b) - var(a) - var(b)) / 2`` gives
   all covariances, one division at the very end.
3. The covariance matrix, whose size depends on the dimensions alone, goes through ``eigh`` on the
   driver, and a last pass projects every vector.

A task adds up its own rows in blocks that cannot overflow and hands out one row a statistic, in
limbs of 32 bits, so that Spark's sums of longs stay exact at any size.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DecimalType, DoubleType, LongType, StructType

from barloom.llm.texts import table

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
LIMB, LIMBS = 32, 6
#: Entries of a block inside a task.
BLOCK = 1 << 20
#: Numbers beyond this many bits are taken in Python's whole numbers instead of 64-bit ones.
SAFE_BITS = 62


def usable(vectors: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector is there and has only finite entries."""
    finite = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    return vectors.where(F.col(vector).isNotNull() & finite)


def blocks(batch: pa.RecordBatch, vector: str, width: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """A batch's vectors in fixed point, as blocks of rows with the place of their first.

    Vectors that are shorter than ``width`` (the batch's longest if None) count as filled up with zeros.
    """
    column = batch.column(vector)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0)) if width is None else width
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    first = np.concatenate(([0], np.cumsum(lengths)))
    step = max(1, BLOCK // max(width, 1))
    for at in range(0, len(lengths), step):
        size = lengths[at : at + step]
        filled = np.zeros((len(size), width))
        filled[np.arange(width) < size[:, None]] = values[first[at] : first[at + len(size)]]
        with np.errstate(over="ignore"):
            whole = np.floor(filled * SCALE)
        yield at, np.clip(whole, -(2.0**SAFE_BITS), 2.0**SAFE_BITS).astype(np.int64) + SHIFT


def limbs(numbers: np.ndarray) -> list[pa.Array]:
    """Whole numbers as columns of 32 bits each, the last with the sign."""
    numbers = numbers.astype(object)
    mask = (1 << LIMB) - 1
    parts = [(numbers >> (LIMB * k)) & mask for k in range(LIMBS - 1)]
    return [pa.array(p.astype(np.int64)) for p in (*parts, numbers >> (LIMB * (LIMBS - 1)))]


def summed(parts: DataFrame, *others: Column) -> list[tuple[int, int, tuple]]:
    """Each statistic's exact total and other aggregates; one row a statistic comes to the driver."""
    total = parts.groupBy("stat").agg(*[F.sum(f"l{k}").alias(f"l{k}") for k in range(LIMBS)], *others)
    return sorted(
        (row[0], sum(v << (LIMB * k) for k, v in enumerate(row[1 : LIMBS + 1])), tuple(row[LIMBS + 1 :]))
        for row in zip(*(c.to_pylist() for c in total.toArrow().columns), strict=True)
    )


LIMB_NAMES = [f"l{k}" for k in range(LIMBS)]
LIMB_TYPES = ", ".join(f"{n} long" for n in LIMB_NAMES)


@dataclass
class Moments:
    """Exact moments in fixed point: ``n`` vectors, per dimension ``total`` and ``centre``, and
    ``scaled``, n * n times the covariance of every two dimensions, doubled."""

    n: int
    total: list[int]
    centre: list[int]
    scaled: list[list[int]]

    @property
    def left(self) -> list[int]:
        """What is left of each mean at its centre, times n."""
        return [s - self.n * m for s, m in zip(self.total, self.centre, strict=True)]

    def covariance(self) -> np.ndarray:
        width = len(self.total)
        return np.array([[v / (2 * self.n * self.n) for v in row] for row in self.scaled]).reshape(width, width)


def moments(vectors: DataFrame, vector: str = "embedding") -> Moments:
    """Moments over all usable rows; two passes, and D * (D + 1) / 2 numbers to the driver."""
    rows = usable(vectors, vector).select(vector)

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, acc, there, low, high = 0, np.zeros(0, object), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            seen += batch.num_rows
            lengths = batch.column(vector).value_lengths().to_numpy(zero_copy_only=False)
            for at, x in blocks(batch, vector):
                more = x.shape[1] - len(acc)
                if more > 0:
                    acc = np.concatenate((acc, np.full(more, 0, object)))
                    there = np.concatenate((there, np.zeros(more, np.int64)))
                    low = np.concatenate((low, np.full(more, SHIFT, np.int64)))
                    high = np.concatenate((high, np.full(more, SHIFT, np.int64)))
                if not len(x):
                    continue
                width = x.shape[1]
                inside = np.arange(width) < lengths[at : at + len(x), None]
                exact = int(np.abs(x).max(initial=0)).bit_length() + len(x).bit_length() <= SAFE_BITS
                acc[:width] += np.where(inside, x if exact else x.astype(object), 0).sum(axis=0).astype(object)
                there[:width] += inside.sum(axis=0)
                low[:width] = np.minimum(low[:width], x.min(axis=0))
                high[:width] = np.maximum(high[:width], x.max(axis=0))
        # the row with stat -1 counts the vectors
        counts = np.append(there, seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(np.arange(len(acc)), -1)), *limbs(np.append(acc, 0)), pa.array(counts),
             pa.array(np.append(low, SHIFT)), pa.array(np.append(high, SHIFT))],
            ["stat", *LIMB_NAMES, "n", "low", "high"],
        )

    first = summed(
        rows.mapInArrow(sums, f"stat long, {LIMB_TYPES}, n long, low long, high long"),
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"),
    )
    n = first[0][2][0] if first else 0
    # a vector without the dimension has a zero there
    total = [s + SHIFT * (n - told[0]) for stat, s, told in first if stat >= 0]
    width = len(total)
    if not n or not width:
        return Moments(n, total, [SHIFT] * width, [[0] * width for _ in total])
    centre = [(2 * s + n) // (2 * n) for s in total]
    reach = max(max(abs(told[1] - m), abs(told[2] - m)) for (_, _, told), m in zip(first[1:], centre, strict=True))
    bits = 2 * (2 * reach).bit_length()
    upper = np.triu_indices(width, 1)

    def squares(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.full(width + len(upper[0]), 0, object)
        part, part_rows = np.zeros(len(acc), np.int64), 0
        for batch in batches:
            for _, x in blocks(batch, vector, width):
                if bits + len(x).bit_length() > SAFE_BITS:  # too large for 64 bits
                    x = x.astype(object)
                e = x - np.array(centre, x.dtype)
                now = np.concatenate([(e * e).sum(axis=0), *(
                    np.square(e[:, i + 1 :] + e[:, i, None]).sum(axis=0) for i in range(width - 1)
                )])
                if now.dtype == object or bits + (part_rows + len(x)).bit_length() > SAFE_BITS:
                    acc, part, part_rows = acc + part.astype(object), np.zeros(len(acc), np.int64), 0
                if now.dtype == object:
                    acc = acc + now
                else:
                    part, part_rows = part + now, part_rows + len(x)
        acc = acc + part.astype(object)
        for at in range(0, len(acc), BLOCK):
            some = acc[at : at + BLOCK]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(at, at + len(some))), *limbs(some)], ["stat", *LIMB_NAMES])

    second = [s for _, s, _ in summed(rows.mapInArrow(squares, f"stat long, {LIMB_TYPES}"))]
    made = Moments(n, total, centre, [[0] * width for _ in total])
    left = made.left
    variance = [n * q - r * r for q, r in zip(second[:width], left, strict=True)]  # times n * n
    for i in range(width):
        made.scaled[i][i] = 2 * variance[i]
    for q, i, j in zip(second[width:], *map(np.ndarray.tolist, upper), strict=True):
        both = n * q - (left[i] + left[j]) ** 2
        made.scaled[i][j] = made.scaled[j][i] = both - variance[i] - variance[j]
    return made


@dataclass
class Whitening:
    """Unit eigenvectors as columns, by falling eigenvalue; ``told`` marks those that are not 0."""

    vectors: np.ndarray
    values: np.ndarray
    explained: list[float | None]
    told: np.ndarray


def principal(known: Moments, components: int = COMPONENTS) -> Whitening:
    """The first eigenvectors of the covariance, each with its largest entry above zero."""
    covariance = known.covariance()
    if not covariance.size:
        return Whitening(np.zeros((0, 0)), np.zeros(0), [], np.zeros(0, bool))
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    trace = float(np.trace(covariance))
    least = max(values[0], 0.0) * len(covariance) * np.finfo(float).eps
    return Whitening(vectors, values, [float(v) / trace if trace > 0 else None for v in values], values > least)


def whiten(vectors: DataFrame, known: Moments, components: int = COMPONENTS, vector: str = "embedding") -> DataFrame:
    """Usable rows with all their columns, and ``whitened``, ``deviation`` and ``deviation_exact``.

    Columns of these names are replaced. ``whitened`` holds one number a component, null where the
    eigenvalue is 0 (fewer directions than components). ``deviation`` is null where it does not fit a
    long, ``deviation_exact`` where it does not fit 38 digits. Rows whose vector is null or holds null
    or non-finite entries are left out; shorter vectors, empty ones too, count as filled up with zeros. Entries
    beyond 2^52 count as that. Repeated rows and ids all stay.
    """
    made = principal(known, components)
    width, n, left = len(known.total), known.n, known.left
    new = ["whitened", "deviation", "deviation_exact"]
    rows = usable(vectors, vector)
    rest = [c for c in rows.columns if c not in new]
    schema = StructType([rows.schema[c] for c in rest]).add("whitened", ArrayType(DoubleType())).add(
        "deviation", LongType()).add("deviation_exact", DecimalType(38, 0))
    centre = np.array(known.centre, np.int64)
    away = np.array([r / n for r in left]) if n else np.zeros(width)
    project = np.where(made.told, made.vectors / np.sqrt(np.where(made.told, made.values, 1.0)), 0.0)
    told = [bool(t) for t in made.told]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in blocks(batch, vector, width):
                e = x - centre
                some = batch.slice(at, len(x))
                white = (e.astype(np.float64) - away) @ project
                lists = pa.array(
                    [[v if t else None for v, t in zip(row, told, strict=True)] for row in white.tolist()], pa.list_(pa.float64())
                )
                reach = n * int(np.abs(e).max(initial=0)) + max(map(abs, left), default=0)
                if 2 * reach.bit_length() + width.bit_length() <= SAFE_BITS:
                    exact = np.square(n * e - np.array(left, np.int64)).sum(axis=1).tolist()
                else:
                    exact = np.square(n * e.astype(object) - np.array(left, object)).sum(axis=1).tolist()
                yield pa.RecordBatch.from_arrays(
                    [*(some.column(c) for c in rest), lists,
                     pa.array([v if v < 1 << 63 else None for v in exact], pa.int64()),
                     pa.array([v if v < 10**38 else None for v in exact], pa.decimal128(38, 0))],
                    [*rest, *new],
                )

    return rows.mapInArrow(run, schema)


def identity_error(whitened: DataFrame, told: Iterable[bool]) -> float | None:
    """The largest entry of the covariance of whitened rows minus the identity, by size.

    Measured on the rows themselves: centred sums of products, divisor n. None without components.
    """
    which = [k for k, t in enumerate(told) if t]
    pairs = [(a, b) for a in which for b in which if a <= b]
    if not pairs:
        return None
    found = whitened.agg(*[F.covar_pop(F.get("whitened", F.lit(a)), F.get("whitened", F.lit(b))) for a, b in pairs]).first()
    return max(abs(v - (a == b)) for v, (a, b) in zip(found, pairs, strict=True))


def components(vectors: DataFrame, count: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row a usable vector and component: ``key``, ``component`` (from 1), ``n``, ``deviation``,
    ``whitened``, ``explained``, ``identity_error`` and ``deviation_exact``; see ``whiten``.

    Only ``key`` of the other columns is kept. An empty table, or one of empty vectors only, gives no rows.
    """
    rows = vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector"))
    known = moments(rows, "vector")
    made = principal(known, count)
    white = whiten(rows, known, count, "vector")
    error = identity_error(white, made.told) if known.n else None
    explained = F.array(*[F.lit(v).cast("double") for v in made.explained]).cast("array<double>")
    return white.select(
        F.col("id").alias(key), "deviation", "deviation_exact", F.posexplode("whitened").alias("at", "whitened")
    ).select(
        key, (F.col("at") + 1).alias("component"), F.lit(known.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(explained, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"), "deviation_exact",
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components(table(spark, sf_dir, "embeddings"))
