"""Whole texts as Arrow batches of bounded size, and hashed words and shingles by numpy."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text taken at once inside a task; a longer text is taken alone.
CHUNK_BYTES = 1 << 19

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_names(columns: Iterable[str], *wanted: str) -> list[str]:
    """Names for helper columns that a table does not have yet, in any case of letters."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and each row's first byte, with one more at the end. Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    if not len(column) or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    first = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[first[0] : first[-1]], first - first[0]


def chunks(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts hold about ``CHUNK_BYTES`` together."""
    offsets = buffers(batch.column(text))[1]
    at = 0
    while at < batch.num_rows:
        to = int(np.searchsorted(offsets, offsets[at] + CHUNK_BYTES, "right")) - 1
        to = min(max(to, at + 1), batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def give_back() -> None:
    """Freed memory goes back to the system: a worker outlives its task, and the C library would keep it there."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux" and (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)):
        trim(0)


def all_chunks(batches: Iterable[pa.RecordBatch], text: str) -> Iterator[pa.RecordBatch]:
    """All rows in runs of bounded size; what their work took is given back after each batch."""
    for batch in batches:
        yield from chunks(batch, text)
        give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit words (the finaliser of splitmix64)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 1 << 63, 256, dtype=U64) | U64(1)
_BASE = U64(0x9E3779B97F4A7C15)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Word bytes are letters, digits and all bytes of other alphabets.
NOT_LETTERS = np.ones(256, bool)
NOT_LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_PLACE = _RNG.integers(1, 1 << 63, 64, dtype=U64) | U64(1)


class Words:
    """Words of a run of texts: maximal runs of bytes other than ``space``, A-Z lowered.

    ``hash``: one 64-bit hash a word; ``start``, ``end``: its bytes; ``first``: each text's first
    word, with one more at the end.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, space: np.ndarray = _SPACE):
        self.data = lowered = _LOWER[data]
        inside = ~space[lowered]
        before = np.zeros(len(data), bool)
        before[1:] = inside[:-1]
        begins = offsets[:-1][offsets[:-1] < len(data)]
        before[begins] = False
        after = np.zeros(len(data), bool)
        after[:-1] = inside[1:]
        ends = offsets[1:]
        after[ends[ends > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        n = len(self.start)
        if not n:
            self.hash = np.zeros(0, U64)
            return
        length = self.end - self.start
        at = np.flatnonzero(inside)
        word_first = np.concatenate(([0], np.cumsum(length)[:-1]))
        place = np.arange(len(at)) - np.repeat(word_first, length)
        powers = np.full(int(length.max()), _BASE, U64)
        powers[0] = 1
        terms = _BYTE[lowered[at]] * np.multiply.accumulate(powers)[place]
        self.hash = mix(np.add.reduceat(terms, word_first) + U64(0x632BE59BD9B4E019) * length.astype(U64))

    def beginnings(self, size: int) -> np.ndarray:
        """A hash of each word's first ``size`` bytes; 0 for words that are not longer."""
        out = np.zeros(len(self.start), U64)
        for k in range(size):
            at = np.minimum(self.start + k, max(len(self.data) - 1, 0))
            out += _BYTE[self.data[at]] * _PLACE[32 + k] if len(at) else U64(0)
        return np.where(self.end - self.start > size, mix(out + U64(size)), U64(0))

    def shingles(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each text's runs of ``n`` words, and each text's first.

        A text of fewer words gives its whole sequence as one; a text without words none.
        """
        counts = np.diff(self.first)
        runs = np.where(counts >= n, counts - n + 1, (counts > 0).astype(counts.dtype))
        first = np.concatenate(([0], np.cumsum(runs)))
        at = np.arange(first[-1]) - np.repeat(first[:-1] - self.first[:-1], runs)
        size = np.repeat(np.minimum(counts, n), runs)
        out = size.astype(U64) * U64(0xD6E8FEB86659FD93)
        for k in range(n):
            there = k < size
            word = self.hash[np.minimum(at + k, max(len(self.hash) - 1, 0))] if len(self.hash) else self.hash
            out += np.where(there, word * _PLACE[k], U64(0))
        return mix(out), first


def words_of(column: pa.Array) -> Words:
    return Words(*buffers(column))


def i64(x: np.ndarray) -> pa.Array:
    """Hashes as Spark longs, bit for bit."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))
