"""Text statistics over long (document, term) tables.

A document is one row, so its counts and norms are bounded by that row. Term
joins go through ``lookup``: a small vocabulary is broadcast after its rows are
counted, a large one meets the tokens in a salted shuffle, so a word found in
every document is spread over many tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulark.operators.joins import bounded_rows, lookup
from tabulark.operators.ordering import numbered
from tabulark.session import pin


def top_in_group(df: DataFrame, by: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First ``n`` rows per group; Spark cuts each group to ``n`` before it shuffles."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def document_frequency(docs: DataFrame, tokens: Column) -> DataFrame:
    """Documents per term. Repeats fall away inside the row, so no distinct count is shuffled."""
    return (
        docs.select(F.explode(F.array_distinct(tokens)).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )


def pruned_vocabulary(frequency: DataFrame, documents: int, least: int, share: float, keep: int) -> DataFrame:
    """Terms in at least ``least`` and at most ``share`` of the documents, most frequent first."""
    fitting = frequency.where((F.col("df") >= least) & (F.col("df") <= documents * share))
    return fitting.orderBy(F.desc("df"), "term").limit(keep)


def dictionary(frequency: DataFrame) -> DataFrame:
    """Zero-based term ids in sorted term order."""
    return numbered(frequency, [], ["term"], "_n").select(
        "term", (F.col("_n") - 1).alias("term_id"), "df"
    )


def frequency_of(counts: DataFrame) -> DataFrame:
    """Documents per term from already counted (document, term) rows."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def term_counts(docs: DataFrame, keep: list[str], tokens: Column) -> DataFrame:
    """Occurrences per document and term; ``keep`` starts with the document key.

    The texts are placed by document before they are cut into words. That one
    shuffle also serves the counts and every later sum per document.
    """
    return (
        docs.repartition(keep[0])
        .select(*keep, F.explode(tokens).alias("term"))
        .groupBy(*keep, "term")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def bag_of_words(counts: DataFrame, key: str, words: DataFrame) -> DataFrame:
    return lookup(counts, words, ["term"], weight="df").select(key, "term_id", "n")


def smooth_idf(frequency: DataFrame, documents: int) -> DataFrame:
    """ln((1 + documents) / (1 + df)) + 1."""
    return frequency.select(
        "term", "df", (F.log(F.lit(1.0 + documents) / (1 + F.col("df"))) + 1).alias("idf")
    )


def tf_idf(counts: DataFrame, keep: list[str], idf: DataFrame) -> DataFrame:
    """Count times idf, scaled to unit length per document; unknown terms drop out."""
    return _unit_length(lookup(counts, idf, ["term"], weight="df"), keep)


def tf_idf_parts(parts: list[DataFrame], keep: list[str], idf: DataFrame) -> list[DataFrame]:
    """:func:`tf_idf` of several count tables with one written idf table."""
    idf = pin(idf)
    return [_unit_length(lookup(p, idf, ["term"], weight="df", pinned=True), keep) for p in parts]


def _unit_length(joined: DataFrame, keep: list[str]) -> DataFrame:
    weighted = joined.withColumn("_w", F.col("n") * F.col("idf"))
    length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy(*keep)))
    return weighted.select(*keep, "term", (F.col("_w") / length).alias("weight"))


@dataclass(frozen=True)
class NaiveBayes:
    """Log weight per term with one column per class, class priors and class defaults."""

    classes: tuple[str, ...]
    prior: dict[str, float]
    weights: DataFrame


def fit_naive_bayes(
    vectors: DataFrame, docs: DataFrame, label: str, alpha: float = 0.1, most_classes: int = 200
) -> NaiveBayes:
    """Multinomial naive Bayes on weighted terms."""
    rows = {r[label]: r["n"] for r in bounded_rows(docs.groupBy(label).agg(F.count(F.lit(1)).alias("n")), most_classes, label)}
    classes = tuple(sorted(rows))
    whole = sum(rows.values())
    per_term = pin(
        vectors.groupBy("term").agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.sum(F.when(F.col(label) == c, F.col("weight")).otherwise(0.0)).alias(c) for c in classes]
        )
    )
    facts = per_term.agg(F.count(F.lit(1)).alias("_terms"), *[F.sum(c).alias(c) for c in classes]).first()
    weights = per_term.select(
        "term",
        "_rows",
        *[
            F.log((F.col(c) + alpha) / F.lit((facts[c] or 0.0) + alpha * facts["_terms"])).alias(c)
            for c in classes
        ],
    )
    return NaiveBayes(classes, {c: math.log(rows[c] / whole) for c in classes}, weights)


def naive_bayes_table(model: NaiveBayes, label: str) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias(label), F.col(c).alias("log_weight")) for c in model.classes]
    flat = model.weights.select("term", F.explode(F.array(*pairs)).alias("_p"))
    return flat.select(f"_p.{label}", "term", "_p.log_weight")


def predict_naive_bayes(model: NaiveBayes, vectors: DataFrame, docs: DataFrame, key: str) -> DataFrame:
    """Most likely class per document; a document without known terms gets the prior's choice."""
    summed = (
        lookup(vectors.select(key, "term", "weight"), model.weights, ["term"], weight="_rows", pinned=True)
        .groupBy(key)
        .agg(*[F.sum(F.col("weight") * F.col(c)).alias(c) for c in model.classes])
    )
    scores = [
        F.struct(
            (F.coalesce(F.col(c), F.lit(0.0)) + F.lit(model.prior[c])).alias("score"),
            F.lit(-i).alias("order"),
            F.lit(c).alias("label"),
        )
        for i, c in enumerate(model.classes)
    ]
    return docs.join(summed, key, "left").select(
        *docs.columns, F.array_max(F.array(*scores))["label"].alias("predicted")
    )


def mean_weights(vectors: DataFrame, docs: DataFrame, label: str) -> DataFrame:
    """Mean term weight per class over all of its documents."""
    sizes = docs.groupBy(label).agg(F.count(F.lit(1)).alias("_docs"))
    return (
        lookup(vectors.groupBy(label, "term").agg(F.sum("weight").alias("_s")), sizes, [label])
        .select(label, "term", (F.col("_s") / F.col("_docs")).alias("mean_weight"))
    )
