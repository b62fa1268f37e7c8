"""Operator 7: benchmark items inside documents, by size-partitioned MinHash containment.

An item whose share ``t`` of shingles lies in a document shares at least one of its
``floor((1 - t) * size) + 1`` smallest hashes with it. So the bottom hashes of an item, as many as
the largest size of its partition asks for, are its MinHash sketch: the search for them in a
document's shingles finds every document that can contain the item, whatever the document's
length. Candidates are verified by the exact share of the item's shingles.

Items are indexed in blocks of bounded size, and each block is a pass over the documents.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm.texts import U64, all_chunks, table, words_of

#: Words of all items of a block: bounds what is sent to the executors (8 bytes a word).
BLOCK_WORDS = 2_000_000
WORDS = 5
NUM, DEN = 4, 5


class ItemIndex:
    """Shingles and sketches of a block of items, by the number of words of a shingle."""

    def __init__(self, items: list[tuple[object, str]], n: int, num: int, den: int) -> None:
        self.num, self.den, self.n = num, den, n
        self.ids: list[object] = []
        self.sets: list[np.ndarray] = []
        sketches: dict[int, list[tuple[int, int]]] = {}
        for item, text in items:
            words = words_of(pa.array([text or ""]))
            count = int(words.first[-1])
            if not count:
                continue
            width = min(n, count)
            shingles = np.unique(words.shingles(width)[0])
            at = len(self.ids)
            self.ids.append(item)
            self.sets.append(shingles)
            top = 1 << (len(shingles) - 1).bit_length() if len(shingles) > 1 else 1  # the partition's largest size
            keep = min(len(shingles), top * (den - num) // den + 1)
            sketches.setdefault(width, []).extend((int(h), at) for h in shingles[:keep])
        self.sketch: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width, pairs in sketches.items():
            pairs.sort()
            self.sketch[width] = np.array([p[0] for p in pairs], U64), np.array([p[1] for p in pairs])

    def search(self, column: pa.Array) -> Iterator[tuple[int, int, int]]:
        """(row, item, shared shingles) for every item contained in a text."""
        words = words_of(column)
        for width, (hashes, owner) in self.sketch.items():
            shingles, first = words.shingles(width)
            lo = np.searchsorted(hashes, shingles, "left")
            hit = np.flatnonzero((lo < len(hashes)) & (hashes[np.minimum(lo, len(hashes) - 1)] == shingles))
            if not len(hit):
                continue
            lo, hi = lo[hit], np.searchsorted(hashes, shingles[hit], "right")
            times = hi - lo
            item = owner[np.arange(times.sum()) + np.repeat(lo - (np.cumsum(times) - times), times)]
            row = np.repeat(np.searchsorted(first, hit, "right") - 1, times)
            pairs = np.unique(np.stack([row, item], axis=1), axis=0)
            at, inside = -1, shingles[:0]
            for r, i in pairs.tolist():
                if r != at:
                    at, inside = r, np.unique(shingles[first[r] : first[r + 1]])
                wanted = self.sets[i]
                if len(inside) * self.den < len(wanted) * self.num:
                    continue
                found = np.searchsorted(inside, wanted)
                shared = int((inside[np.minimum(found, len(inside) - 1)] == wanted).sum())
                if shared * self.den >= len(wanted) * self.num:
                    yield r, i, shared


def item_blocks(items: DataFrame, n: int, num: int, den: int, key: str, text: str) -> Iterator[ItemIndex]:
    """Indexes of all items, each of a bounded number of words."""
    size = items.select(F.sum(F.length(text)).alias("chars")).first()["chars"] or 0
    blocks = max(1, math.ceil(size / 2 / BLOCK_WORDS))  # a word and its space take two characters at least
    part = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(blocks))
    for block in range(blocks):
        rows = items.where(part == block).select(key, text).orderBy(key, text).collect()
        yield ItemIndex([(r[0], r[1]) for r in rows], n, num, den)


def contained_items(
    docs: DataFrame, items: DataFrame, n: int = WORDS, num: int = NUM, den: int = DEN,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """A row for each document and item whose shingles it contains at a share of ``num / den``.

    Columns: ``key``, ``item_key``, ``n_shared``, ``n_item`` and ``containment``. A shingle is ``n``
    words, A-Z lowered, or all words of a shorter item. Null, empty and blank texts and items match
    nothing; repeated rows give their rows each; only the named columns are read. Two items of the
    same text are both reported.
    """
    def search(index: ItemIndex) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in all_chunks(batches, text):
                found = list(index.search(batch.column(text)))
                size = [len(index.sets[i]) for _, i, _ in found]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(key).take(pa.array([r for r, _, _ in found], pa.int64())),
                        pa.array([index.ids[i] for _, i, _ in found], pa_item),
                        pa.array([s for _, _, s in found], pa.int64()),
                        pa.array(size, pa.int64()),
                        pa.array([s / k for (_, _, s), k in zip(found, size, strict=True)], pa.float64()),
                    ],
                    [key, item_key, "n_shared", "n_item", "containment"],
                )
        return run

    from pyspark.sql.pandas.types import to_arrow_type

    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item_key].dataType.simpleString()
    pa_item = to_arrow_type(items.schema[item_key].dataType)
    schema = f"`{key}` {kind}, `{item_key}` {item_kind}, n_shared long, n_item long, containment double"
    out = None
    for index in item_blocks(items, n, num, den, item_key, item_text):
        rows = docs.select(key, text).mapInArrow(search(index), schema)
        out = rows if out is None else out.unionByName(rows)
    return out


def without_items(
    docs: DataFrame, items: DataFrame, n: int = WORDS, num: int = NUM, den: int = DEN,
    text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item; nulls and empty texts stay."""
    def clean(index: ItemIndex) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in all_chunks(batches, text):
                keep = np.ones(batch.num_rows, bool)
                for row, _, _ in index.search(batch.column(text)):
                    keep[row] = False
                yield batch.filter(pa.array(keep))
        return run

    for index in item_blocks(items, n, num, den, item_key, item_text):
        docs = docs.mapInArrow(clean(index), docs.schema)
    return docs


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP7_SQL = r"""
with item_words as (
  select item_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from benchmark),
doc_words as (
  select row_number() over () as r, doc_id, list_filter(
    regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                          '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents),
items as (
  select item_id, len(s) as n, k, unnest(s) as g from (
    select item_id, least(5, len(w)) as k,
           list_distinct(list_transform(range(1, len(w) - least(5, len(w)) + 2), lambda i: array_to_string(w[i:i + least(5, len(w)) - 1], ' '))) as s
    from item_words where len(w) > 0)),
docs as (
  select r, doc_id, k, unnest(list_distinct(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')))) as g
  from doc_words, (select distinct k from items))
select doc_id, item_id, count(*) as n_shared, any_value(n)::bigint as n_item, count(*) / any_value(n) as containment
from docs join items using (g, k) group by r, doc_id, item_id having count(*) * 5 >= any_value(n) * 4
"""
