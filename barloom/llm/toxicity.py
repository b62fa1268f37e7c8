"""Operator 5: toxicity by multiple-instance learning.

Only documents have labels; sentences are the instances. A sentence's probability is a logistic
function of its telling words and word beginnings, and a document is toxic unless none of its sentences is
(noisy-or: ``1 - prod(1 - p)``). The gradient of the document's likelihood falls on the sentences
that explain its label, so the model also tells which sentences offend. A sentence without a telling
feature has probability 0, so length alone never makes a document toxic; what its other words lean to,
on average, is the leak of the noisy-or, which stays under ``LEAK`` and only ranks such documents.

The model is fitted on a bounded sample of labelled rows: the ``PER_CLASS`` rows of either label
with the smallest hash of their id, whole texts. Telling features are those whose share among toxic
rows is too high for chance, so that of all that are chosen no more than ``BY_CHANCE`` are expected to be
there by chance (Benjamini and Hochberg's rule on the hypergeometric tail): with little evidence
they are few, or none, and nothing is toxic. Only their places in the sample go to the driver.
Scoring reads every row.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import lgamma

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from barloom.llm.texts import NOT_LETTERS, U64, Words, all_chunks, buffers, table

FEATURE_BITS = 20
BEGINNINGS = (4, 5)
#: Share of the telling features that may be expected to be there by chance.
BY_CHANCE = 0.1
#: Most that words which do not tell may add, and rows by which their share is drawn to that of all rows.
LEAK, SHRINK = 0.05, 10.0
PER_CLASS = 3_000
ROUNDS, RATE, DECAY = 100, 0.3, 1e-4

_ENDS = np.zeros(256, bool)
_ENDS[[ord(c) for c in ".!?\n"]] = True


class Sentences:
    """Hashed words and word beginnings of a run of texts, by sentence.

    ``feature``; ``first``: each sentence's first feature, with one more; ``doc``: each sentence's
    text; ``start``, ``end``: its bytes from its first to its last word.
    """

    def __init__(self, column: pa.Array) -> None:
        data, offsets = buffers(column)
        words = Words(data, offsets, NOT_LETTERS)
        hashes = np.stack([words.hash, *(words.beginnings(k) for k in BEGINNINGS)], axis=1)
        self.feature = (hashes >> U64(64 - FEATURE_BITS)).astype(np.int32).reshape(-1)
        self.feature[hashes.reshape(-1) == 0] = 0  # shorter words have no such beginning
        again = np.zeros(len(words.hash), bool)
        again[1:] = words.hash[1:] == words.hash[:-1]
        self.feature[np.repeat(again, hashes.shape[1])] = 0  # a word said again at once tells no more
        ended = np.concatenate(([0], np.cumsum(_ENDS[data])))
        doc = np.searchsorted(words.first, np.arange(len(words.hash)), "right") - 1
        part = ended[words.start] if len(words.hash) else np.zeros(0, np.int64)
        new = np.ones(len(words.hash), bool)
        new[1:] = (part[1:] != part[:-1]) | (doc[1:] != doc[:-1])
        begin = np.flatnonzero(new)
        first = np.append(begin, len(words.hash))
        self.first = first * hashes.shape[1]
        self.doc = doc[begin]
        self.start, self.end = words.start[begin], words.end[first[1:] - 1]
        self.offsets, self.docs = offsets, len(column)


@dataclass
class ToxicityModel:
    weights: np.ndarray
    bias: float
    lean: np.ndarray

    def sentence_logits(self, text: Sentences) -> np.ndarray:
        """Each sentence's logit; minus infinity without a telling feature."""
        if not len(text.feature):
            return np.zeros(0)
        weight = self.weights[text.feature]
        logits = np.add.reduceat(weight, text.first[:-1]).astype(np.float64) + self.bias
        return np.where(np.logical_or.reduceat(weight != 0, text.first[:-1]), logits, -np.inf)

    def scores(self, text: Sentences, logits: np.ndarray) -> np.ndarray:
        """Each text's probability; 0 for one without words."""
        row = np.repeat(text.doc, np.diff(text.first))
        there = text.feature > 0
        lean = np.bincount(row, self.lean[text.feature], text.docs) / np.maximum(np.bincount(row, there, text.docs), 1)
        leak = LEAK / (1 + np.exp(-np.clip(10 * lean, -40, 40))) * (np.bincount(row, minlength=text.docs) > 0) * self.lean.any()
        return 1 - (1 - leak) * (1 - _noisy_or(logits, text.doc, text.docs))


def _noisy_or(logits: np.ndarray, doc: np.ndarray, docs: int) -> np.ndarray:
    """Each text's probability; 0 without sentences."""
    return -np.expm1(-np.bincount(doc, np.logaddexp(0, logits), docs))


def fit(feature: np.ndarray, first: np.ndarray, doc: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, float]:
    """Full-batch Adam on the noisy-or likelihood, both classes weighing the same.

    ``feature``, ``first`` and ``doc`` are the sentences with telling features as ``Sentences`` has
    them; other sentences take no part. Gives the weights of all features and the bias.
    """
    used, code = np.unique(feature, return_inverse=True)
    weights = np.zeros(len(used))
    bias = -4.0
    sentence = np.repeat(np.arange(len(first) - 1), np.diff(first))
    share = np.where(toxic, 0.5 / max(toxic.sum(), 1), 0.5 / max((~toxic).sum(), 1))
    m = np.zeros(len(used) + 1)
    v = np.zeros(len(used) + 1)
    for step in range(1, ROUNDS + 1):
        logits = np.bincount(sentence, weights[code], len(first) - 1) + bias
        p_doc = np.clip(_noisy_or(logits, doc, len(toxic)), 1e-9, 1)
        pull = (1 - np.where(toxic, 1 / p_doc, 0)) * share
        slope = pull[doc] / (1 + np.exp(-np.clip(logits, -40, 40)))
        grad = np.append(np.bincount(code, slope[sentence], len(used)), slope.sum())
        grad[:-1] += DECAY * weights
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad**2
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-12)
        weights -= move[:-1]
        bias -= move[-1]
    full = np.zeros(1 << FEATURE_BITS, np.float32)
    full[used] = weights
    return full, float(bias)


def chance(n: int, n_toxic: int, rows: int, toxic: int) -> float:
    """How likely ``rows`` of ``n`` rows, drawn by chance, hold ``toxic`` or more of its ``n_toxic``."""

    def choose(a: int, b: int) -> float:
        return lgamma(a + 1) - lgamma(b + 1) - lgamma(a - b + 1)

    whole = choose(n, rows)
    return sum(
        np.exp(choose(n_toxic, k) + choose(n - n_toxic, rows - k) - whole)
        for k in range(max(toxic, rows - (n - n_toxic)), min(rows, n_toxic) + 1)
    )


def telling(n: int, n_toxic: int, seen: list[tuple[int, int, int]], by_chance: float = BY_CHANCE) -> list[tuple[int, int]]:
    """Which (rows, toxic rows) of a feature tell, given how many features have each.

    A feature in so few rows that not even all of them toxic would tell is no candidate.
    """
    odds = sorted((chance(n, n_toxic, rows, toxic), rows, toxic, many) for rows, toxic, many in seen)
    best = {rows: chance(n, n_toxic, rows, min(rows, n_toxic)) for rows, _, _ in seen}
    for limit in sorted({p for p, *_ in odds}, reverse=True):
        candidates = sum(many for _, rows, _, many in odds if best[rows] <= limit)
        chosen = sum(many for p, _, _, many in odds if p <= limit)
        if limit * candidates <= by_chance * chosen:
            return [(rows, toxic) for p, rows, toxic, _ in odds if p <= limit]
    return []


def held_out(key: str = "doc_id"):
    """Rows kept from training: the remainder of the id's checksum by 5 is 0; not so a null id."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, key: str = "doc_id", text: str = "text", label: str = "toxic"
) -> ToxicityModel:
    """Fit on at most ``per_class`` rows of either label that are not held out.

    An id with two labels counts as toxic; of several texts under one id one counts. Without rows of
    both labels every text scores 0; without features that tell them apart, under ``LEAK``.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~held_out(key)).groupBy(key).agg(F.max(label).alias(label))
    some = None
    for value in (0, 1):
        part = known.where(F.col(label) == value).orderBy(F.xxhash64(key), key).limit(per_class)
        some = part if some is None else some.unionByName(part)
    none = np.zeros(1 << FEATURE_BITS, np.float32)
    # at most per_class ids a label; one text an id
    rows = docs.select(key, text).join(F.broadcast(some), key).groupBy(key).agg(F.max(label).alias(label), F.min(text).alias(text))

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_chunks(batches, text):
            found = Sentences(batch.column(text))
            toxic = np.array(batch.column(label).to_pylist()) == 1
            row = np.repeat(found.doc, np.diff(found.first))
            pairs = np.unique(found.feature.astype(np.int64) + (row << FEATURE_BITS))
            pairs = pairs[(pairs & ((1 << FEATURE_BITS) - 1)) > 0]
            feature, at = np.unique(pairs & ((1 << FEATURE_BITS) - 1), return_inverse=True)
            of_toxic = np.bincount(at, toxic[pairs >> FEATURE_BITS], len(feature)).astype(np.int64)
            # feature 0 stands for the rows themselves
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.append(feature, 0)), pa.array(np.append(np.bincount(at, minlength=len(feature)), len(toxic)).astype(np.int64)),
                    pa.array(np.append(of_toxic, toxic.sum())),
                ],
                ["feature", "n", "toxic"],
            )

    # one row a feature at most, so its size is fixed
    counts = rows.mapInArrow(counted, "feature long, n long, toxic long").groupBy("feature").agg(
        F.sum("n").alias("n"), F.sum("toxic").alias("toxic")
    ).orderBy("feature").toArrow()
    features, of_rows, of_toxic = (counts[c].to_numpy() for c in ("feature", "n", "toxic"))
    n, n_toxic = (int(of_rows[0]), int(of_toxic[0])) if len(features) and features[0] == 0 else (0, 0)
    if not 0 < n_toxic < n:
        return ToxicityModel(none, 0.0, none)
    features, of_rows, of_toxic = features[1:], of_rows[1:], of_toxic[1:]
    pairs, which, many = np.unique(np.stack([of_rows, of_toxic]), axis=1, return_inverse=True, return_counts=True)
    tell = set(telling(n, n_toxic, [(*map(int, pair), int(k)) for pair, k in zip(pairs.T, many, strict=True)]))
    telling_features = features[np.array([tuple(map(int, pair)) in tell for pair in pairs.T], bool)[which.reshape(-1)]]
    lean = none.copy()
    usual = SHRINK * of_rows / n
    lean[features] = np.log((of_toxic + usual) / (n_toxic + SHRINK)) - np.log((of_rows - of_toxic + usual) / (n - n_toxic + SHRINK))

    def chosen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tells = np.zeros(1 << FEATURE_BITS, bool)
        tells[telling_features] = True
        for batch in all_chunks(batches, text):
            found = Sentences(batch.column(text))
            kept = tells[found.feature]
            sentence = np.repeat(np.arange(len(found.doc)), np.diff(found.first))[kept]
            feature = found.feature[kept]
            at = np.searchsorted(found.doc[sentence], np.arange(batch.num_rows + 1))
            parts = list(zip(at[:-1], at[1:], strict=True))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key), batch.column(label),
                    pa.array([feature[a:b] for a, b in parts], pa.list_(pa.int32())),
                    pa.array([(sentence[a:b] - (sentence[a] if b > a else 0)).astype(np.int32) for a, b in parts], pa.list_(pa.int32())),
                ],
                [key, label, "features", "sentences"],
            )

    kinds = f"`{key}` {docs.schema[key].dataType.simpleString()}, `{label}` {some.schema[label].dataType.simpleString()}"
    found = rows.mapInArrow(chosen, f"{kinds}, features array<int>, sentences array<int>").toArrow().to_pylist()
    found.sort(key=lambda r: str(r[key]))
    feature, first, doc = [], [0], []
    for number, row in enumerate(found):
        last = None
        for f, at in zip(row["features"], row["sentences"], strict=True):
            if at != last:
                doc.append(number)
                first.append(first[-1])
                last = at
            feature.append(f)
            first[-1] += 1
    weights, bias = fit(np.array(feature, np.int64), np.array(first), np.array(doc, np.int64), np.array([r[label] == 1 for r in found], bool))
    return ToxicityModel(weights, bias, lean)


def score_texts(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``score``, ``worst_score``, ``worst_sentence``.

    Columns of those names are replaced. A null, empty or wordless text scores 0; without a telling
    sentence there is no worst one. Repeated rows score alike; of sentences that tie, the first is the worst.
    """
    new = ["score", "worst_score", "worst_sentence"]
    docs = docs.drop(*(c for c in new if c != text))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # fixed size, 8 MB

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = shared.value
        for batch in all_chunks(batches, text):
            column = batch.column(text)
            found = Sentences(column)
            data, _ = buffers(column)
            logits = weights.sentence_logits(found)
            score = weights.scores(found, logits)
            first = np.searchsorted(found.doc, np.arange(batch.num_rows + 1))
            worst_score, worst = [None] * batch.num_rows, [None] * batch.num_rows
            for row in np.flatnonzero(np.diff(first)).tolist():
                at = first[row] + int(np.argmax(logits[first[row] : first[row + 1]]))
                if np.isneginf(logits[at]):
                    continue
                worst_score[row] = float(1 / (1 + np.exp(-logits[at])))
                worst[row] = data[found.start[at] : found.end[at]].tobytes().decode()
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score), pa.array(worst_score, pa.float64()), pa.array(worst, pa.string())],
                [*batch.schema.names, *new],
            )

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType([*docs.schema.fields]).add("score", DoubleType()).add("worst_score", DoubleType()).add("worst_sentence", StringType())
    return docs.mapInArrow(run, schema)


def clean_texts(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``; null and empty texts stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in all_chunks(batches, text):
            found = Sentences(batch.column(text))
            score = shared.value.scores(found, shared.value.sentence_logits(found))
            yield batch.filter(pa.array(score < threshold))

    return docs.mapInArrow(run, docs.schema)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"))
    return score_texts(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "worst_score", "worst_sentence",
    )
