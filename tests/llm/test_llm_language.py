from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from helpers import awkward, documents
from pyspark.sql import functions as F

from tabulark.llm import language as L


def spoken(seed: int, n: int, syllables: list[str]) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices(syllables, k=draw.randint(1, 4))) for _ in range(n))


A, B = ["ka", "to", "mi", "ru"], ["stra", "gel", "üm", "and"]


def labelled(spark, n=160):
    rows = [(i, spoken(i, 30, A if i % 2 else B), "aa" if i % 2 else "bb", "s") for i in range(n)]
    return documents(spark, rows + [(9000, None, "cc"), (9001, "no label"), (9002, "", "aa")])


def test_held_out_accuracy(spark):
    docs = labelled(spark)
    filters = L.fit_filters(docs.where(~L.held_out("doc_id")))
    out = L.identify(docs, filters).where(L.held_out("doc_id") & F.col("text").isNotNull() & (F.col("doc_id") < 9000))
    rows = out.collect()
    assert len(rows) > 20 and all(r["lang"] == r["lang_pred"] and r["score"] > 0.5 for r in rows)


def test_awkward_rows(spark):
    filters = L.fit_filters(labelled(spark))
    docs = documents(spark, awkward(4000) + [(10, "123 !? ::")])
    rows = L.identify(docs, filters).collect()
    assert len(rows) == docs.count()
    for r in rows:
        has_letter = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == L.NONE) == (not has_letter)
        assert 0 <= r["score"] <= 1 and r["key"] == 7
    assert L.identify(docs.where("false"), filters).count() == 0


def test_nothing_learned(spark):
    docs = documents(spark, [(1, "some words", None)])
    filters = L.fit_filters(docs)
    assert filters.languages == ()
    row = L.identify(docs, filters).first()
    assert (row["lang_pred"], row["score"]) == (L.NONE, 0.0)


def test_filters_hold_all_that_was_put_in():
    grams = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    slots = np.zeros(1 << 16, np.uint64)
    for p in L.places(grams, len(slots), 2):
        slots[p] |= np.uint64(1)
    masks = [slots[p] for p in L.places(grams, len(slots), 2)]
    assert (masks[0] & masks[1] == 1).all()
    other = np.random.default_rng(2).integers(0, 1 << 63, 50_000).astype(np.uint64)
    passed = np.logical_and(*[slots[p] == 1 for p in L.places(other, len(slots), 2)]).mean()
    expected = L.Filters(("x",), slots, (2,), 2).false_positives[0]
    assert abs(passed - expected) < 0.005


def test_texts_do_not_run_into_each_other():
    together = L.batches_of_text(pa.array(["ab", "", None, "cd!ef"]))
    (first, rows, points, owner), = together
    words, of = L.bare_words(points, owner)
    grams, doc = L.ngram_hashes(words, of, 2)
    assert (first, rows) == (0, 4) and doc.tolist() == [0, 3, 3]


def test_rows_leave_in_bounded_runs():
    slots = np.random.default_rng(3).integers(0, 4, 1 << 16).astype(np.uint64)
    filters = L.Filters(("aa", "bb"), slots, L.SIZES, 2)
    texts = [spoken(i, 8_000, A if i % 2 else B) for i in range(40)] + [None, "", "1 2", "ka" * 200_000, "to"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(45)), pa.array(texts), pa.array([7] * 45)], names=["doc_id", "text", "key"])
    parts = list(L.named_rows(batch, 1, 3, filters))
    assert len(parts) > 10
    for part in parts:
        *before, _ = [len(t or "") for t in part.column(1).to_pylist()]
        assert sum(before) < L.CHUNK <= 1 << 17
    whole = pa.Table.from_batches(parts)
    assert whole.schema.names == ["doc_id", "text", "key", "lang_pred", "score"]
    assert whole.select([0, 1, 2]).equals(pa.Table.from_batches([batch]))
    alone = [L.scores(pa.array([t], pa.string()), filters) for t in texts]
    assert whole.select([3, 4]).to_pylist() == [
        {"lang_pred": named[0], "score": found[0]} for runs in alone for _, named, found in runs
    ]


def test_a_text_is_sent_once(spark):
    docs = labelled(spark)
    plan = L.identify(docs, L.fit_filters(docs))._jdf.queryExecution().analyzed()
    sent = plan.children().apply(0).output()
    assert sent.size() == len(docs.columns)


def test_held_out_rule(spark):
    import zlib

    got = {r[0]: r[1] for r in spark.range(50).select("id", L.held_out("id")).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(50)}
