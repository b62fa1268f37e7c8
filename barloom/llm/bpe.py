"""Operator 1: byte-level BPE by backtracking, and decoding by an offset table.

A vocabulary whose ids follow the order of its merges has a simple test for two neighbouring
tokens: undo the later of their merges, step by step, and see whether a merge across the border
would have come first. A sequence whose neighbours all pass is the one that merging gives. The
encoder takes the longest token at each place, found for all places in one Aho-Corasick pass, and
falls back to the next shorter one, or to the place before, when the test fails. A bit for each
place that led nowhere keeps the work linear in the text.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from barloom.llm.texts import all_chunks, give_back, table

#: Memo entries of a task; longer pieces are never kept. Bounds memory, not results.
MEMO_PIECES, MEMO_CHARS, MEMO_PAIRS = 200_000, 48, 60_000

VOCABULARY = "byte_bpe_50k.json"

_LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
_NUMBERS = "0-9²³¹¼-¾"
_SPACES = "\t-\r \u0085 "


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _pattern(letters: str, numbers: str, spaces: str) -> str:
    """Contractions, words, numbers, signs and white space; the word form first as the commonest."""
    return (
        rf" ?[{letters}]+| ?[{numbers}]+|'(?:[stmd]|re|ve|ll)| ?[^{spaces}{letters}{numbers}]+"
        rf"|[{spaces}]+(?![^{spaces}])|[{spaces}]+"
    )


class PreTokens:
    """Splits a text as the library's byte-level pre-tokenizer does.

    Texts in Latin-1 have a plain pattern. The general one follows the library where its
    character tables are of another Unicode version than those of ``regex``: code points that
    Python does not know yet are tried once.
    """

    def __init__(self, split) -> None:
        self.latin = re.compile(_pattern(_LETTERS, _NUMBERS, _SPACES)).findall
        new = "".join(c for i in range(0x110000) if not 0xD800 <= i < 0xE000 and unicodedata.category(c := chr(i)) == "Cn")
        named = regex.findall(r"[\p{L}\p{N}]", new)
        odd = [ord(c) for c in named if len(split("a" + c)) == 2 and len(split("!" + c)) == 1]
        self.general = regex.compile(self._general(odd)).findall

    @staticmethod
    def _general(odd: list[int]) -> str:
        runs: list[list[int]] = []
        for i in odd:
            if runs and runs[-1][1] == i - 1:
                runs[-1][1] = i
            else:
                runs.append([i, i])
        signs = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)
        if not signs:
            return _pattern(r"\p{L}", r"\p{N}", r"\s")
        letters, numbers = rf"[\p{{L}}--[{signs}]]", rf"[\p{{N}}--[{signs}]]"
        return (
            rf"(?V1) ?{letters}+| ?{numbers}+|'(?:[stmd]|re|ve|ll)| ?(?:[^\s\p{{L}}\p{{N}}]|[{signs}])+"
            r"|\s+(?!\S)|\s+"
        )

    def __call__(self, text: str) -> list[str]:
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.general(text)
        return self.latin(text)


class PairTable(dict):
    """Whether two tokens may stand side by side, found when first asked for; bounded."""

    def __init__(self, fits) -> None:
        super().__init__()
        self.fits = fits

    def __missing__(self, pair: int) -> bool:
        if len(self) >= MEMO_PAIRS:
            self.clear()
        fits = self[pair] = self.fits(pair >> 32, pair & 0xFFFFFFFF)
        return fits


class Vocabulary:
    """Tokens as bytes, the pair table, and the offset table for decoding."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model = told["model"]
        kind = (told.get("pre_tokenizer") or {}).get("type"), (told.get("decoder") or {}).get("type")
        if model["type"] != "BPE" or kind != ("ByteLevel", "ByteLevel") or told.get("normalizer"):
            raise ValueError("a byte-level BPE vocabulary is needed")
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in shown} | {
            chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))
        }
        tokens = {i: bytes(byte_of[c] for c in t) for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in told.get("added_tokens", [])}
        tokens |= {i: t.encode() for t, i in self.special.items()}
        size = max(tokens) + 1
        ordinary = {b: i for i, b in tokens.items() if i not in self.special.values()}
        self.length = [len(tokens.get(i, b"")) for i in range(size)]
        self.pair: dict[int, int] = {}
        self.left, self.right = list(range(size)), list(range(size))
        seen = -1
        for merge in model["merges"]:
            a, b = (model["vocab"][x] for x in (merge.split(" ") if isinstance(merge, str) else merge))
            made = ordinary[tokens[a] + tokens[b]]
            if made <= seen or made <= max(a, b):
                raise ValueError("ids must follow the order of the merges")
            seen = made
            self.pair[a << 32 | b] = made
            self.left[made], self.right[made] = a, b
        self.find = ahocorasick.Automaton()
        for b, i in ordinary.items():
            self.find.add_word(b.decode("latin-1"), (len(b) - 1, i))
        self.find.make_automaton()
        self.ordinary = ordinary
        self.compatible = PairTable(self._fits)
        self.shorter = [-1] * size
        for b, i in ordinary.items():
            self.shorter[i] = next((ordinary[b[:k]] for k in range(len(b) - 1, 0, -1) if b[:k] in ordinary), -1)
        self.blob = np.frombuffer(b"".join(tokens.get(i, b"") for i in range(size)), np.uint8)
        self.offset = np.concatenate(([0], np.cumsum(self.length)))

    def _fits(self, a: int, b: int) -> bool:
        """Whether merging leaves ``a`` and ``b`` side by side."""
        pair, left, right = self.pair, self.left, self.right
        limit = 1 << 62
        while True:
            made = pair.get(a << 32 | b)
            if made is not None and made < limit:
                return False
            # undo the later merge of the two; the other side's bound moves with it
            if a > b:
                limit, a = a, right[a]
                if a == limit:
                    limit, b = b + 1, left[b]
                    if b + 1 == limit:
                        return True
            else:
                limit, b = b + 1, left[b]
                if b + 1 == limit:
                    limit, a = a, right[a]
                    if a == limit:
                        return True

    def encode(self, piece: bytes) -> list[int]:
        """Ids of one pre-token."""
        whole = self.ordinary.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest: list[int] = [-1] * (n + 1)
        for end, (back, token) in self.find.iter(piece.decode("latin-1")):
            longest[end - back] = token  # ends come in rising order, so the last is the longest
        length, compatible, shorter = self.length, self.compatible, self.shorter
        open_ = bytearray(b"\1") * (n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while at < n:
            last = out[-1] if out else -1
            while token >= 0 and not (
                open_[at + length[token]] and (last < 0 or compatible[last << 32 | token])
            ):
                token = shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at]
            elif last < 0:
                raise ValueError("the vocabulary lacks a byte")
            else:
                open_[at] = 0
                out.pop()
                at -= length[last]
                token = last
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of a sequence of ids: all are gathered from the blob at once."""
        size = self.offset[ids + 1] - self.offset[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.offset[ids] - (ends - size), size)
        return self.blob[at].tobytes()


class PieceMemo(dict):
    """Ids of pre-tokens as bytes, made when first asked for; bounded."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        made = array("i", self.encode(piece.encode())).tobytes()
        if len(piece) <= MEMO_CHARS:
            if len(self) >= MEMO_PIECES:
                self.clear()
            self[piece] = made
        return made


class Encoder:
    """Encodes whole texts; special strings inside them become their own ids, as in the library."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.pieces = PreTokens(split)
        special = self.vocabulary.special
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
        self.memo = PieceMemo(self.vocabulary.encode)
        self.decimal = list(map(str, range(len(self.vocabulary.length))))

    def encode(self, text: str) -> np.ndarray:
        special = self.vocabulary.special
        if self.special is None or not self.special.search(text):
            return np.frombuffer(self._bytes(text), np.int32)
        parts = self.special.split(text)
        return np.frombuffer(
            b"".join([np.array([special[p]], np.int32).tobytes() if i % 2 else self._bytes(p) for i, p in enumerate(parts)]), np.int32
        )

    def _bytes(self, text: str) -> bytes:
        return b"".join(map(self.memo.__getitem__, self.pieces(text)))

    def forget(self) -> None:
        """Empty the memos: the worker runs other stages after a task, and a new task soon knows its pieces again."""
        self.memo.clear()
        self.vocabulary.compatible.clear()
        give_back()

    def digits(self, ids: np.ndarray) -> str:
        """The ids in decimal, joined by commas."""
        return ",".join(map(self.decimal.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.vocabulary.decode(ids).decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process and vocabulary file."""
    code = Encoder(path)
    give_back()
    return code


def encode_texts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ``ids``, the array of token ids of the whole text; null is empty.

    One row out for each row in, repeated rows included; other columns are not read. Memory: one
    chunk of texts and a bounded memo a task.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in all_chunks(batches, text):
            ids = [code.encode(t or "") for t in batch.column(text).to_pylist()]
            column = pa.array(ids, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(key), column], [key, "ids"])
        code.forget()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, ids array<int>")


def decode_ids(rows: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and ``text``; bytes that are not UTF-8 become U+FFFD. Null ids are an empty text."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in batches:
            out = [code.decode(np.array(x or [], np.int64)) for x in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(key), pa.array(out, pa.string())], [key, "text"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, ids).mapInArrow(run, f"`{key}` {kind}, text string")


def encode_digests(
    docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Token count and digests of the ids and of the text decoded from them, in one pass.

    Columns: ``key``, ``n_tokens``, ``ids_sha256`` of the ids joined by commas, ``decoded_sha256``,
    and ``ids`` if asked for. Encoding and decoding are those of ``encode_texts`` and ``decode_ids``.
    """
    names = [key, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        for batch in all_chunks(batches, text):
            counts, ids_sha, text_sha, kept = [], [], [], []
            for value in batch.column(text).to_pylist():
                ids = code.encode(value or "")
                counts.append(len(ids))
                ids_sha.append(hashlib.sha256(code.digits(ids).encode()).hexdigest())
                if with_ids:
                    kept.append(ids)
                decoded = code.vocabulary.decode(ids).decode("utf-8", "replace")
                text_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
            columns = [batch.column(key), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            if with_ids:
                ends = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())
                columns.append(pa.ListArray.from_arrays(ends, pa.array(np.concatenate(kept) if kept else np.zeros(0, np.int32))))
            yield pa.RecordBatch.from_arrays(columns, names)
        code.forget()

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(
        run, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    )


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), vocabulary_path())
