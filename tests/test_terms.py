from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulark.functions import text
from tabulark.operators import entities, learn, terms

DOCS = [
    (1, "en", "Cats chase mice and mice chase cheese"),
    (2, "en", "Cheese cheese cheese"),
    (3, "fr", "Le chat mange le fromage"),
    (4, "fr", "le fromage et le chat"),
    (5, "fr", "?!"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc int, lang string, text string")


def words(value):
    return [w for w in "".join(c if c.isalnum() else " " for c in value.lower()).split() if len(w) > 1]


def vectors(docs, keep=("doc",)):
    counts = terms.term_counts(docs, list(keep), text.word_tokens(F.col("text")))
    idf = terms.smooth_idf(terms.frequency_of(counts), docs.count())
    return terms.tf_idf(counts, list(keep), idf)


def expected_weights():
    df = Counter(w for _, _, t in DOCS for w in set(words(t)))
    idf = {w: math.log((1 + len(DOCS)) / (1 + n)) + 1 for w, n in df.items()}
    out = {}
    for doc, _, t in DOCS:
        raw = {w: n * idf[w] for w, n in Counter(words(t)).items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        out.update({(doc, w): v / norm for w, v in raw.items()})
    return out


def test_weights_match_plain_python(docs, widths):
    got = {(r["doc"], r["term"]): r["weight"] for r in vectors(docs).collect()}
    want = expected_weights()
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k]) for k in want)


def test_broadcast_and_salted_weights_agree(docs, monkeypatch):
    from tabulark.operators import joins

    near = {tuple(r) for r in vectors(docs).withColumn("weight", F.round("weight", 12)).collect()}
    monkeypatch.setattr(joins, "lookup", lambda big, small, on, how="inner", weight=None, **_: joins.salted_join(big, small, on, how, weight))
    monkeypatch.setattr(terms, "lookup", joins.lookup)
    far = {tuple(r) for r in vectors(docs).withColumn("weight", F.round("weight", 12)).collect()}
    assert near == far


def test_naive_bayes_matches_numpy(docs):
    weighted = vectors(docs, ("doc", "lang"))
    model = terms.fit_naive_bayes(weighted, docs.select("doc", "lang"), "lang", alpha=0.1)
    got = {(r["lang"], r["term"]): r["log_weight"] for r in terms.naive_bayes_table(model, "lang").collect()}
    want = expected_weights()
    lang = {d: language for d, language, _ in DOCS}
    vocabulary = {w for _, w in want}
    for c in ("en", "fr"):
        sums = {w: sum(v for (d, t), v in want.items() if t == w and lang[d] == c) for w in vocabulary}
        whole = sum(sums.values()) + 0.1 * len(vocabulary)
        for w in vocabulary:
            assert math.isclose(got[c, w], math.log((sums[w] + 0.1) / whole))
    guesses = terms.predict_naive_bayes(model, weighted.select("doc", "term", "weight"), docs.select("doc", "lang"), "doc")
    # The document without words falls to the larger class.
    assert {r["doc"]: r["predicted"] for r in guesses.collect()} == {1: "en", 2: "en", 3: "fr", 4: "fr", 5: "fr"}


def test_vocabulary_limits(docs):
    frequency = terms.document_frequency(docs, text.word_tokens(F.col("text")))
    kept = {r["term"]: r["df"] for r in terms.pruned_vocabulary(frequency, 5, 2, 0.5, 10).collect()}
    assert kept == {"chat": 2, "cheese": 2, "fromage": 2, "le": 2}
    assert [r["term"] for r in terms.pruned_vocabulary(frequency, 5, 2, 0.5, 2).collect()] == ["chat", "cheese"]
    ids = {r["term"]: r["term_id"] for r in terms.dictionary(frequency).collect()}
    assert [ids[t] for t in sorted(ids)] == list(range(len(ids)))


def test_letter_tokens_and_stop_words(spark):
    row = spark.createDataFrame([("This is Überraschung, cats2dogs an abcdefghijklmnopq with cats",)], "t string")
    tokens = text.letter_tokens(F.col("t"))
    assert row.select(tokens.alias("x")).first()["x"] == ["this", "überraschung", "cats", "dogs", "with", "cats"]
    kept = text.without(tokens, text.STOP_WORDS)
    assert row.select(kept.alias("x")).first()["x"] == ["überraschung", "cats", "dogs", "cats"]


@pytest.mark.parametrize(
    ("word", "stem"),
    [("ponies", "pony"), ("zombies", "zomby"), ("eaies", "eaie"), ("classes", "classe"), ("goes", "goe"),
     ("cats", "cat"), ("glass", "glass"), ("status", "status"), ("tree", "tree")],
)
def test_plural_stem(spark, word, stem):
    assert spark.range(1).select(text.plural_stem(F.lit(word)).alias("s")).first()["s"] == stem


TEXT = (
    "Maria Gomez wrote to a.b@mail.example.com yesterday. Call the office at +1 (555) 555-0101 before noon!\n"
    "Numbers 123456789012 and 210987654321 differ.\n10.0.0.1 answers"
)


@pytest.fixture(scope="module")
def note(spark):
    return spark.createDataFrame([(7, TEXT)], "doc int, text string")


def test_entities_and_sentences(note):
    found = entities.pattern_entities(note, ["doc"], "text", entities.PATTERNS).collect()
    assert sorted((r["type"], r["entity"]) for r in found) == [
        ("EMAIL", "a.b@mail.example.com"), ("IP", "10.0.0.1"), ("NUMBER", "123456789012"),
        ("NUMBER", "210987654321"), ("PHONE", "+1 (555) 555-0101"),
    ]
    rows = entities.sentence_rows(note, "doc", "text")
    assert [r["sentence"] for r in rows.orderBy("sentence_no").collect()][1] == "Call the office at +1 (555) 555-0101 before noon"
    assert rows.count() == 4
    assert entities.mentioning(rows, "NUMBER", 2).count() == 1
    assert entities.mentioning(rows, "PHONE", 2).count() == 0


def test_span_and_participants(note):
    spans = entities.entity_spans(entities.sentence_rows(note, "doc", "text"), "PHONE")
    row = entities.participants(spans).first()
    tokens = row["sentence"].split(" ")
    assert " ".join(tokens[row["start"] : row["end"]]) == row["entity"]
    assert (row["word_before"], row["word_after"]) == ("office", "noon")


def test_top_entities_rank_before_the_count_filter(spark):
    mentions = spark.createDataFrame([("T", e) for e in "aabbcd"], "type string, entity string")
    assert [(r["entity"], r["rank"]) for r in entities.top_entities(mentions, 3).orderBy("rank").collect()] == [("a", 1), ("b", 2)]


def test_topics(spark, docs):
    tokens = docs.select("doc", text.word_tokens(F.col("text")).alias("tokens"))
    listed = ["cats", "chat", "cheese", "fromage", "mice"]
    counted = learn.term_vectors(tokens, "tokens", listed)
    model = learn.fit_topics(counted, 2, rounds=3)
    shares = learn.topic_mix(model, counted.where("doc < 5"), "doc")
    for r in shares.groupBy("doc").agg(F.sum("share").alias("s")).collect():
        assert r["s"] == pytest.approx(1.0)
    keywords = learn.topic_terms(model, listed, spark, 3)
    assert keywords.count() == 6
    best = learn.main_topics(shares, "doc", keywords).collect()
    assert len(best) == 4
    top = {(r["doc"]): max(x["share"] for x in shares.where(F.col("doc") == r["doc"]).collect()) for r in best}
    assert all(r["share"] == round(top[r["doc"]], 4) and len(r["keywords"].split(", ")) == 3 for r in best)


def test_shipped_stop_words_are_those_of_spark(spark):
    from pyspark.ml.feature import StopWordsRemover

    from tabulark.functions import text as words

    assert list(words.ENGLISH_STOP_WORDS) == StopWordsRemover.loadDefaultStopWords("english")
    rows = spark.createDataFrame([(1, "I don't THINK, they've gone: the over-\nview"), (2, ""), (3, None)], "i int, t string")
    kept = rows.select("i", words.without(words.spoken_tokens(F.col("t")), words.ENGLISH_STOP_WORDS).alias("k"))
    assert {r["i"]: r["k"] for r in kept.collect()} == {1: ["think", "gone", "view"], 2: [], 3: None}
