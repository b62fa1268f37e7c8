"""Each stage on its own input against brute force, and the run as a whole."""

import hashlib

from tokenizers import Tokenizer

import corpus_pipeline as pipeline
from barloom.llm.bpe import vocabulary_path
from barloom.llm.catalog import QUERIES

from .test_containment import brute_force as contained
from .test_jaccard import brute_force as components

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_and_run(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    seen = {}
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, sf)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r for r in docs.collect()}
        assert len(after) == docs.count() and set(after) <= set(before)
        if name != "bpe":
            assert docs.columns == COLUMNS
        if name == "toxicity":
            gone = (set(before) - set(after)) & set(toxic)  # those with a label
            assert gone and sum(toxic[i] for i in gone) >= 0.8 * len(gone)
        if name == "ngram_jaccard":
            assert set(after) == {i for i, _, c in components(list(before.items()), 5, 4, 5) if i == c}
        if name == "decontamination":
            assert set(before) - set(after) == {d for d, *_ in contained(list(before.items()), items)}
        if name == "pii":
            assert set(after) == set(before)
            assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "bpe":
            library = Tokenizer.from_file(vocabulary_path())
            for i, text in before.items():
                ids = library.encode(text, add_special_tokens=False).ids
                assert after[i].ids == ids and after[i].n_tokens == len(ids)
                assert after[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        seen[name] = after
    whole = {r.doc_id: r.ids_sha256 for r in pipeline.run(spark, sf).collect()}
    assert whole == {i: r.ids_sha256 for i, r in seen["bpe"].items()}


def test_odd_rows_pass_every_stage(spark, odd, sf):
    rows = odd
    for name, stage in pipeline.STAGES:
        out = stage(spark, rows, sf)
        if name == "bpe":
            break
        assert out.columns == odd.columns
        empty = stage(spark, rows.limit(0), sf)
        assert empty.count() == 0
        rows = spark.createDataFrame(out.collect(), odd.schema)
    ids = sorted(str(r.doc_id) for r in out.collect())
    assert ids == sorted(["1", "2", "3", "4", "5", "7", "8", "None"])


def test_near_copies_by_text_and_not_by_id(spark):
    """Ids that repeat with different texts, and rows without id, met as near copies or not."""
    words = [f"w{i}" for i in range(100)]
    base, near, nameless = " ".join(words), " ".join([*words[:-1], "x"]), [f"n{i}" for i in range(100)]
    rows = [(3, base), (5, near), (5, "a text all of its own"), (5, "a text all of its own"), (None, base), (7, None), (7, ""),
            (None, " ".join(nameless)), (None, " ".join(nameless)), (None, " ".join(["y", *nameless[1:]])), (None, "")]
    frame = spark.createDataFrame([(*r, "en", n) for n, r in enumerate(rows)], "doc_id long, text string, lang string, n_chars int")
    kept = [(r.doc_id, r.text) for r in pipeline.keep_one_of_near_copies(spark, frame, "").collect()]
    whole = [t for i, t in kept if i is None and t]
    assert len(whole) == 1 and whole[0].endswith("n99")
    assert sorted((str(i), str(t)) for i, t in kept if not (i is None and t)) == [("3", base), ("5", "a text all of its own"), ("7", ""), ("7", "None"), ("None", "")]


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
