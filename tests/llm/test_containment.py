"""Contained items against every document and item."""

import re

from barloom.llm.containment import contained_items, op7_decontamination, without_items

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall("[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def brute_force(docs, items, n=5, num=4, den=5):
    found = []
    for doc, text in docs:
        there = words(text)
        for item, wanted in items:
            w = words(wanted)
            if not w:
                continue
            k = min(n, len(w))
            inside = {tuple(there[i : i + k]) for i in range(len(there) - k + 1)}
            ask = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
            shared = len(ask & inside)
            if shared * den >= len(ask) * num:
                found.append((doc, item, shared, len(ask)))
    return sorted(found, key=str)


def rows_of(frame):
    return sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in frame.collect()), key=str)


def test_whole_parts_and_short_items(spark):
    passage = [f"q{i}" for i in range(40)]
    filler = [f"f{i}" for i in range(3000)]
    docs = [
        (1, " ".join(filler[:900] + passage + filler[900:])), (2, " ".join(passage[:38]).upper()),
        (3, " ".join(passage[:30] + filler[:50])), (4, " ".join(passage[:20] + ["x"] + passage[21:])),
        (5, "yes no maybe"), (6, None), (7, ""), (None, " ".join(passage)), (1, " ".join(passage)), (8, "the cat sat"),
    ]
    items = [(10, " ".join(passage)), (11, "no maybe"), (12, None), (13, " "), (14, " ".join(passage)), (None, "cat")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert rows_of(contained_items(frame, asked)) == brute_force(docs, items)
    dirty = {str((d, t)) for d, t in docs if brute_force([(d, t)], items)}
    kept = without_items(frame, asked).collect()
    assert sorted(str((r.doc_id, r.text)) for r in kept) == sorted(str(d) for d in docs if str(d) not in dirty)
    assert contained_items(frame, asked.limit(0)).count() == contained_items(frame.limit(0), asked).count() == 0


def test_odd_rows_keep_all_columns(spark, odd):
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert without_items(odd, items).columns == odd.columns
    assert without_items(odd, items).count() == odd.count() - 2


def test_registered_query(spark, sf):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert rows_of(op7_decontamination(spark, sf)) == brute_force(docs, items) != []
