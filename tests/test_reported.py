"""Inputs on which earlier forms of these operators went wrong."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tabulark.functions.normal import distribution
from tabulark.operators import entities, series
from tabulark.plans import shared
from tabulark.sources import files


def test_distribution_is_exact(spark):
    points = [i / 64 for i in range(-512, 513)]
    df = spark.createDataFrame([(x,) for x in points], "x double").select("x", distribution(F.col("x")).alias("p"))
    for r in df.collect():
        assert r["p"] == pytest.approx(math.erfc(-r["x"] / math.sqrt(2)) / 2, abs=1e-12)


def test_null_keys_keep_their_predictions(spark):
    schema = "row_id string, price double, quantity double, discount double, tax double, line double"
    rows = spark.createDataFrame([("a", 5.0, None, 0.1, 0.0, 1.0), ("b", 7.0, 2.0, None, 0.0, None)], schema)
    assert shared.prediction_store(rows).count() == 6


def test_spans_point_at_whole_tokens(spark):
    text = "one two three four five 9123456789012 or 123456789012 now 123456789012"
    rows = spark.createDataFrame([(1, 0, text)], "doc long, sentence_no int, sentence string")
    spans = entities.entity_spans(rows, "NUMBER").orderBy("start").collect()
    assert [(r["entity"], r["start"], r["end"]) for r in spans] == [
        ("9123456789012", 5, 6), ("123456789012", 7, 8), ("123456789012", 9, 10),
    ]


def test_sentences_of_one_name(spark):
    rows = spark.createDataFrame([(1, 0, "Then Anna met Bert"), (1, 1, "Bert left")], "doc long, sentence_no int, sentence string")
    assert entities.mentioning(rows, "NAME", entity="Anna").count() == 1
    assert entities.mentioning(rows, "NAME", least=2, entity="Bert").count() == 1


@pytest.mark.parametrize(
    ("text", "kept"),
    [
        ("From: a@b\n\nBody: this stays\n-- not a footer line\nWhat: x\n> q", "Body: this stays\n-- not a footer line\nWhat: x"),
        ("no header\n\nbody\n--\nsignature", "no header\n\nbody"),
        ("--\nonly a rule first", "--\nonly a rule first"),
        ("Subject: x\nwithout a blank line", "Subject: x\nwithout a blank line"),
        ("", ""),
    ],
)
def test_messages_lose_header_footer_and_quotes(spark, text, kept):
    docs = spark.createDataFrame([(text,)], "text string")
    assert files.cleaned_corpus(docs, "text").first()["text"] == kept


def test_drift_line_starts_at_the_first_tail_price(spark):
    prices = [1.0, 2.0, 4.0, 5.0, 9.0]
    rows = spark.createDataFrame([(1, i, p) for i, p in enumerate(prices)], "k long, at int, price double")
    held = series.tail_holdout(series.log_return(rows, ["k"], ["at"], "price"), ["k"], ["at"], 2)
    trend = series.drift_line(held, ["k"], "price", "log_return").orderBy("at").collect()
    assert [r["trend"] for r in trend] == pytest.approx([math.log(5.0), math.log(5.0) + math.log(2.0)])
