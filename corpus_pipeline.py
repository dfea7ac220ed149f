"""The training-text pipeline: language, lines, near copies, mix, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.llm import language, lines, minhash, mixing, packing
from tabulark.llm.common import table, written

#: A text is rejected if less than this share of its n-grams is known in any language.
#: Texts below so many characters say too little to be rejected for it.
LEAST_SCORE = 0.05
LEAST_CHARS = 50


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text was given a language; the filters learn from the labels of ``docs``.

    Defined cases: a text that is null or holds no letter goes; with no label
    in the table no language is known, every text is ``und`` and goes.
    """
    named = language.identify(docs, language.fit_filters(docs))
    unknown = (F.col("score") < LEAST_SCORE) & (F.length("text") >= LEAST_CHARS)
    kept = (F.col("lang_pred") != language.NONE) & ~unknown
    return named.where(kept).select(*docs.columns)


def unshared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share; a null text stays null."""
    return lines.drop_common_lines(docs).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies; rows without an id all stay.

    Of rows that repeat an id one stays, whichever it is.
    """
    stay = minhash.near_copies(docs).where(F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    named = docs.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.where(F.col("doc_id").isNull())).select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the wanted proportions; one taken twice is there twice."""
    return mixing.repeated(mixing.mix_sources(docs), docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 tokens; a null text is one end token."""
    return packing.pack_documents(docs, added=True)


STAGES = [
    ("language", known_language),
    ("lines", unshared_lines),
    ("near_copies", one_of_each_group),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: The tokenizer, the signatures and the seeded draws are outside SQL; a test holds the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
