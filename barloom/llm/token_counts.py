"""Operator 8: token counts from pre-token frequencies.

A run of texts is a small relation (text, pre-token, frequency). The pieces of a pre-token are
counted once in the life of a worker; the counts are joined to the frequencies and summed by text.
No ids are made for a text. The join stays inside the task on purpose: rows (text, pre-token) hold
most of the corpus again, so dealing them out by pre-token would move as much as the input, to
save counting a pre-token once in each worker (figures in the README).
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from barloom.llm.bpe import MEMO_CHARS, encoder, vocabulary_path
from barloom.llm.texts import all_chunks, buffers, table

MEMO_COUNTS = 1_000_000
LIMIT = 1024


class PieceCounts(dict):
    """Pieces by pre-token, counted when first asked for; bounded, as long pre-tokens are not kept."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece.encode()))
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_COUNTS:
                self.clear()
            self[piece] = n
        return n


_counts: dict[str, PieceCounts] = {}


def token_counts(
    docs: DataFrame, path: str, limit: int = LIMIT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``key``, ``n_bytes``, ``n_tokens`` and ``over_limit`` of each row; null is empty.

    Repeated rows are counted each; columns of other names are not read. Special strings count
    one, as they are one token each. Memory: one chunk of texts and a bounded memo a worker.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        pieces = _counts.setdefault(path, PieceCounts(code.vocabulary.encode))
        special, find = code.vocabulary.special, code.special
        for batch in all_chunks(batches, text):
            tokens = []
            for value in batch.column(text).to_pylist():
                parts = [value or ""]
                n = 0
                if find is not None and find.search(parts[0]):
                    split = find.split(parts[0])
                    n, parts = sum(x in special for x in split[1::2]), split[::2]
                for part in parts:
                    n += sum(pieces[t] * k for t, k in Counter(code.pieces(part)).items())
                tokens.append(n)
            counts = pa.array(tokens, pa.int64())
            size = pa.array(np.diff(buffers(batch.column(text))[1]), pa.int64())
            over = pa.array([n > limit for n in tokens], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(key), size, counts, over], [key, "n_bytes", "n_tokens", "over_limit"]
            )

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path())
