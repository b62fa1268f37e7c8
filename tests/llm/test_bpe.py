"""The encoder and the counts against the library, and exact round trips."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from barloom.llm.bpe import Vocabulary, decode_ids, encode_digests, encode_texts, encoder, op1_bpe, vocabulary_path
from barloom.llm.token_counts import op8_token_counts, token_counts

PATH = vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(), st.text(alphabet="ab eé'sß\n\t  12<|endoftext|>!?中ª²"), st.lists(
    st.sampled_from(["the", "ing", " ", "aaaa", "  ", "'s", "1234", "\n", "<|endoftext|>", "՘"])).map("".join)))
def test_any_text_encodes_as_the_library_does(text):
    ids = encoder(PATH).encode(text)
    assert ids.tolist() == ids_of(text)
    assert encoder(PATH).decode(ids.astype(np.int64)) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False)


def test_long_runs_stay_linear():
    for text in ("a" * 50_000, "=" * 20_000, "ab" * 20_000):
        assert encoder(PATH).encode(text).tolist() == ids_of(text)


def test_only_byte_level_vocabularies(tmp_path):
    with pytest.raises(ValueError):
        Vocabulary(vocabulary_path("word_bpe_49k.json"))


def test_rows_round_trip(spark, odd, none):
    back = decode_ids(encode_texts(odd, PATH), PATH)
    said = sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    assert sorted((str(r.doc_id), r.text) for r in back.collect()) == said
    assert encode_texts(none, PATH).count() == decode_ids(encode_texts(none, PATH), PATH).count() == 0


def test_digests_and_counts_against_the_library(spark, odd, none):
    texts = sorted((str(r.doc_id), r.text or "") for r in odd.collect())
    expected = sorted((
        name, len(ids_of(t)), hashlib.sha256(",".join(map(str, ids_of(t))).encode()).hexdigest(),
        hashlib.sha256(t.encode()).hexdigest(), ids_of(t)) for name, t in texts)
    digests = encode_digests(odd, PATH, with_ids=True).collect()
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids) for r in digests) == expected
    counts = token_counts(odd, PATH, limit=5)
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in counts.collect()) == sorted(
        (name, len(t.encode()), len(ids_of(t)), len(ids_of(t)) > 5) for name, t in texts)
    assert token_counts(none, PATH).count() == encode_digests(none, PATH).count() == 0


def test_registered_queries(spark, sf):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    encoded = LIBRARY.encode_batch(list(docs.values()), add_special_tokens=False)
    expected = {d: e.ids for d, e in zip(docs, encoded, strict=True)}
    for r in op1_bpe(spark, sf).collect():
        assert r.n_tokens == len(expected[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, expected[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()
    counts = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op8_token_counts(spark, sf).collect()}
    assert counts == {d: (len(docs[d].encode()), len(i), len(i) > 1024) for d, i in expected.items()}


def test_memos_of_a_worker_stay_small():
    """A worker keeps them for the stages that follow in it."""
    import tracemalloc

    from barloom.llm.bpe import PairTable, PieceMemo

    tracemalloc.start()
    try:
        memo, pairs = PieceMemo(lambda piece: [2000, 3000, 4000]), PairTable(lambda a, b: True)
        for i in range(500_000):
            memo[f" piece{i}"]
            pairs[i << 32 | 5000]
        assert tracemalloc.get_traced_memory()[0] < 120e6
    finally:
        tracemalloc.stop()


def test_a_stage_leaves_no_memos_to_the_next(odd, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(type(odd), "mapInArrow", lambda rows, run, schema: run)
    code = encoder(PATH)
    texts = [f"word{i} zqx{i % 5}y" for i in range(5_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(5_000)), pa.array(texts)], ["doc_id", "text"])
    for stage in (encode_digests, encode_texts):
        for n, out in enumerate(stage(odd, PATH)(iter([batch, batch.slice(0, 1)])), 1):
            assert code.memo and out.num_rows
        assert n == 2 and not code.memo and not code.vocabulary.compatible
