"""Operator 13: text quality by histogram gradient-boosted trees over document statistics.

A text becomes some thirty numbers (lengths, shares of kinds of bytes, words, lines and of what is
repeated), none of which knows a word. Trees are grown on the logistic loss: every statistic is cut
into at most ``BINS`` bins of about as many rows, gradients are summed by bin, and a node is split
where these sums gain most. The grown trees lie one after the other in flat arrays (statistic,
threshold, children, value), and all rows walk through all of them at once in numpy.

The model is fitted on a bounded sample of labelled rows: the ``PER_CLASS`` rows of either label with
the smallest hash of their id, whole texts. A sampled row weighs as many rows as its label has for
it, so that scores are shares at every size of the sample. Scoring reads every row in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType, StructType

from barloom.llm.texts import U64, Words, all_chunks, buffers, mix, table
from barloom.llm.toxicity import held_out

PER_CLASS = 3_000
BINS = 64
TREES, DEPTH, RATE = 120, 4, 0.1
#: Weight pulling a leaf towards 0, and the least weight (as curvature) of a leaf, in rows of the sample.
SHRINK, LEAST = 1.0, 1.0
#: Rows that walk through the trees at once.
WALK = 4_096

_KIND = np.full(256, 5, np.uint8)  # other signs
_KIND[128:] = 4
_KIND[[0x20, *range(0x09, 0x0E)]] = 3
_KIND[48:58] = 2
_KIND[65:91] = 1
_KIND[97:123] = 0
_KIND[[ord(c) for c in ".,;:!?'\"()-"]] = 6
_END = np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True
_LINE = np.zeros(256, bool)
_LINE[10] = True

STATISTICS = (
    "bytes", "words", "lines", "word_bytes", "longest_word", "word_bytes_spread", "short_words", "words_a_line",
    "lower", "upper", "digits", "blanks", "non_ascii", "signs", "punctuation", "entropy", "doubled_bytes",
    "distinct_words", "commonest_word", "single_words", "word_again", "longest_run", "distinct_pairs", "pair_again",
    "distinct_lines", "repeated_line_words", "no_letters", "capitals_only", "capitalised", "word_ends_in_sign",
    "word_ends_in_punctuation", "sentence_ends",
)


def _groups(row: np.ndarray, value: np.ndarray, rows: int) -> tuple[np.ndarray, ...]:
    """By row: the number of different values, the size of the largest group of equal ones, the values
    that come once, and the members of groups of more. A run of texts has far fewer rows than 2^22."""
    both = np.sort((row.astype(U64) << U64(42)) | (value >> U64(22)))
    new = np.ones(len(both), bool)
    new[1:] = both[1:] != both[:-1]
    at = np.flatnonzero(new)
    size = np.diff(np.append(at, len(both)))
    r = (both[at] >> U64(42)).astype(np.int64)
    distinct, single = np.bincount(r, minlength=rows), np.bincount(r[size == 1], minlength=rows)
    return distinct, _most(r, size, rows), single, np.bincount(r, size * (size > 1), rows)


def _most(row: np.ndarray, value: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, np.int64)
    np.maximum.at(out, row, value)
    return out


def statistics(column: pa.Array) -> np.ndarray:
    """One row of ``STATISTICS`` a text. Null, empty and wordless texts have zeros where nothing can be counted."""
    data, offsets = buffers(column)
    rows = len(offsets) - 1
    out = dict.fromkeys(STATISTICS, np.zeros(rows))
    if not len(data):
        return np.stack([out[name] for name in STATISTICS], axis=1)
    size = np.diff(offsets)
    of_byte = np.repeat(np.arange(rows), size)
    kind = _KIND[data]

    def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return part / np.maximum(whole, 1)

    kinds = np.bincount(of_byte * 7 + kind, minlength=rows * 7).reshape(rows, 7)
    for name, k in zip(("lower", "upper", "digits", "blanks", "non_ascii", "signs", "punctuation"), range(7), strict=True):
        out[name] = share(kinds[:, k], size)
    seen = np.bincount((of_byte << 8) + data, minlength=rows << 8)
    at = np.flatnonzero(seen)
    seen = seen[at] / size[at >> 8]
    out["entropy"] = np.bincount(at >> 8, -seen * np.log2(seen), rows)
    doubled = (data[1:] == data[:-1]) & (of_byte[1:] == of_byte[:-1])
    out["doubled_bytes"] = share(np.bincount(of_byte[1:][doubled], minlength=rows), size)

    words = Words(data, offsets)
    count = np.diff(words.first)
    row = np.repeat(np.arange(rows), count)
    length = words.end - words.start
    line_of = np.concatenate(([0], np.cumsum(_LINE[data])))[words.start]
    out["bytes"], out["words"] = np.log1p(size), np.log1p(count)
    total = np.bincount(row, length, rows)
    out["word_bytes"] = share(total, count)
    out["word_bytes_spread"] = np.sqrt(np.maximum(share(np.bincount(row, length.astype(float) ** 2, rows), count) - out["word_bytes"] ** 2, 0))
    out["longest_word"] = np.log1p(_most(row, length, rows))
    out["short_words"] = share(np.bincount(row, length <= 3, rows), count)

    distinct, largest, single, _ = _groups(row, words.hash, rows)
    out["distinct_words"], out["commonest_word"], out["single_words"] = share(distinct, count), share(largest, count), share(single, count)
    again = np.zeros(len(row), bool)
    again[1:] = (words.hash[1:] == words.hash[:-1]) & (row[1:] == row[:-1])
    out["word_again"] = share(np.bincount(row, again, rows), count)
    begin = np.flatnonzero(~again)
    out["longest_run"] = share(_most(row[begin], np.diff(np.append(begin, len(row))), rows), count)
    if len(row) > 1:
        inside = row[1:] == row[:-1]
        pair = mix(words.hash[:-1] * U64(3) + words.hash[1:])[inside]
        of_pair, pairs = row[1:][inside], np.maximum(count - 1, 0)
        distinct, _, _, repeated = _groups(of_pair, pair, rows)
        out["distinct_pairs"], out["pair_again"] = share(distinct, pairs), share(repeated, pairs)

    if len(row):
        first_of_line = np.ones(len(row), bool)
        first_of_line[1:] = (line_of[1:] != line_of[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(first_of_line)
        place = np.arange(len(row)) - np.repeat(at, np.diff(np.append(at, len(row))))
        whole = np.add.reduceat(mix(words.hash + place.astype(U64) * U64(0x9E3779B97F4A7C15)), at)
        lines = np.bincount(row[at], minlength=rows)
        in_line = np.diff(np.append(at, len(row)))
        distinct = _groups(row[at], whole, rows)[0]
        _, line, members = np.unique(mix(whole + row[at].astype(U64)), return_inverse=True, return_counts=True)
        out["lines"], out["words_a_line"] = np.log1p(lines), np.log1p(share(count, lines))
        out["distinct_lines"] = share(distinct, lines)
        out["repeated_line_words"] = share(np.bincount(row[at], in_line * (members[line] > 1), rows), count)
        letters = np.concatenate(([0], np.cumsum((kind <= 1) | (kind == 4))))
        capitals = np.concatenate(([0], np.cumsum(kind == 1)))
        n_letters = letters[words.end] - letters[words.start]
        n_capitals = capitals[words.end] - capitals[words.start]
        last = kind[words.end - 1]
        for name, told in (
            ("no_letters", n_letters == 0), ("capitals_only", (n_capitals > 1) & (n_capitals == n_letters)),
            ("capitalised", (kind[words.start] == 1) & (n_capitals == 1)), ("word_ends_in_sign", last == 5),
            ("word_ends_in_punctuation", last == 6), ("sentence_ends", _END[data[words.end - 1]]),
        ):
            out[name] = share(np.bincount(row, told, rows), count)
    return np.stack([out[name] for name in STATISTICS], axis=1)


@dataclass
class BoostedTrees:
    """Trees in flat arrays. A leaf is its own child; ``root`` is each tree's first node."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    root: np.ndarray
    depth: int
    base: float

    def logits(self, rows: np.ndarray) -> np.ndarray:
        out = np.full(len(rows), self.base)
        for at in range(0, len(rows) if len(self.root) else 0, WALK):
            some = rows[at : at + WALK]
            which = np.arange(len(some))[:, None]
            node = np.broadcast_to(self.root, (len(some), len(self.root)))
            for _ in range(self.depth):
                node = np.where(some[which, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            out[at : at + WALK] += self.value[node].sum(axis=1)
        return out

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(rows), -500, 500)))


def constant(share: float) -> BoostedTrees:
    none = np.zeros(0, np.int64)
    return BoostedTrees(none, np.zeros(0), none, none, np.zeros(0), none, 0, float(np.log(share / (1 - share))))


def boost(
    rows: np.ndarray, good: np.ndarray, weight: np.ndarray, trees: int = TREES, depth: int = DEPTH, rate: float = RATE, bins: int = BINS
) -> BoostedTrees:
    """Trees on the weighted logistic loss. Ties between splits go to the earlier statistic and lower threshold."""
    n, width = rows.shape
    weight = weight * (n / weight.sum())
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    # a row is in bin b if it is above b cuts; cut k parts bins 0..k from the rest
    code = np.stack([np.searchsorted(c, rows[:, f], "left") for f, c in enumerate(cuts)], axis=1) + np.arange(width) * bins
    usable = np.zeros((width, bins), bool)
    for f, c in enumerate(cuts):
        usable[f, : len(c)] = True
    share = float(np.clip((weight * good).sum() / weight.sum(), 1e-6, 1 - 1e-6))
    base = float(np.log(share / (1 - share)))
    logits = np.full(n, base)
    feature, threshold, left, right, value, root = [], [], [], [], [], []

    def node() -> int:
        for column, start in ((feature, 0), (threshold, 0.0), (left, len(left)), (right, len(right)), (value, 0.0)):
            column.append(start)
        return len(feature) - 1

    def worth(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return g * g / (h + SHRINK)

    for _ in range(trees):
        p = 1 / (1 + np.exp(-logits))
        slope, bend = weight * (p - good), weight * p * (1 - p)
        open_nodes = [(node(), np.arange(n))]
        root.append(open_nodes[0][0])
        for level in range(depth + 1):
            further = []
            for me, members in open_nodes:
                g, h = slope[members].sum(), bend[members].sum()
                best = None
                if level < depth and h >= 2 * LEAST:
                    some = code[members].reshape(-1)
                    by_bin = [np.bincount(some, np.repeat(s[members], width), width * bins).reshape(width, bins).cumsum(axis=1) for s in (slope, bend)]
                    gain = worth(by_bin[0], by_bin[1]) + worth(g - by_bin[0], h - by_bin[1]) - worth(g, h)
                    gain[~usable | (by_bin[1] < LEAST) | (h - by_bin[1] < LEAST)] = 0
                    at = int(gain.argmax())
                    if gain.reshape(-1)[at] > 1e-9:
                        best = divmod(at, bins)
                if best is None:
                    value[me] = -rate * g / (h + SHRINK)
                    logits[members] += value[me]
                    continue
                f, cut = best
                feature[me], threshold[me] = f, float(cuts[f][cut])
                below = code[members, f] - f * bins <= cut
                left[me], right[me] = node(), node()
                further += [(left[me], members[below]), (right[me], members[~below])]
            open_nodes = further
    return BoostedTrees(*map(np.array, (feature, threshold, left, right, value, root)), depth, base)


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> BoostedTrees:
    """Fit on at most ``per_class`` rows of either label (0, 1) that are not held out.

    An id with both labels counts as 0; of several texts under one id one counts. Without sampled
    rows of both labels every text scores as the labels are shared out, ``(good + 1) / (all + 2)``.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.min(label).cast("int").alias(label))
    many = {r[0]: r[1] for r in known.groupBy(label).count().collect()}  # two rows
    some = None
    for value in (0, 1):
        part = known.where(F.col(label) == value).orderBy(F.xxhash64(key), key).limit(per_class)
        some = part if some is None else some.unionByName(part)

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_chunks(batches, text):
            told = pa.array(list(statistics(batch.column(text))), pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(key), batch.column(label), told], [key, label, "told"])

    joined = docs.select(key, text).join(F.broadcast(some), key)  # at most per_class ids a label
    kinds = f"`{key}` {docs.schema[key].dataType.simpleString()}, `{label}` int, told array<double>"
    rows = joined.mapInArrow(measured, kinds).groupBy(key).agg(F.min(label).alias(label), F.min("told").alias("told")).collect()
    rows.sort(key=lambda r: str(r[key]))
    good = np.array([r[label] for r in rows], float)
    if not 0 < good.sum() < len(good):
        return constant((many.get(1, 0) + 1) / (sum(many.values()) + 2))
    weight = np.where(good > 0, many[1] / good.sum(), many[0] / (1 - good).sum())
    return boost(np.array([r["told"] for r in rows]), good, weight)


def score_texts(docs: DataFrame, model: BoostedTrees, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score``, from 0 to 1, higher for better texts.

    A column of that name is replaced. Null texts score as empty ones, from the same trees; repeated
    rows score alike.
    """
    docs = docs.drop(*(["score"] if text != "score" else []))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # some thousand nodes

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_chunks(batches, text):
            score = pa.array(shared.value.scores(statistics(batch.column(text))))
            yield pa.RecordBatch.from_arrays([*batch.columns, score], [*batch.schema.names, "score"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields]).add("score", DoubleType()))


def good_texts(docs: DataFrame, model: BoostedTrees, threshold: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score ``threshold`` or more."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_chunks(batches, text):
            yield batch.filter(pa.array(shared.value.scores(statistics(batch.column(text))) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def op13_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
