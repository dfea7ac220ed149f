"""Logistic regression per fold by reweighted least squares: one aggregate per step serves all folds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.functions.numeric import clip, total
from tabulark.operators.joins import bounded_rows
from tabulark.operators.linear import Moments, Ridge, fit_ridge, out_of_fold

#: Scores beyond this say the same to the last digit; the weights of the next step stay above zero.
MOST = 30.0
#: The model fitted on all rows.
WHOLE = -1


def probability(score: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-clip(score, -MOST, MOST)))


def _weighted_moments(df: DataFrame, label: str, fold: str, models: dict[int, Ridge]) -> dict[int, Moments]:
    """Weighted products of (1, features..., working response) per model, over the rows that the model may see.

    Each row meets the models of the other folds inside the row; the sums meet map-side.
    """
    features = next(iter(models.values())).features
    scores = [
        F.when(~F.col(fold).eqNullSafe(i), F.struct(F.lit(i).alias("model"), clip(m.column(), -MOST, MOST).alias("eta")))
        for i, m in models.items()
    ]
    spread = df.select(label, *features, F.explode(F.array_compact(F.array(*scores))).alias("_s")).select(
        F.col("_s.model").alias("model"), F.col("_s.eta").alias("_eta"), *features, F.col(label).cast("double").alias("_y")
    )
    p = probability(F.col("_eta"))
    worked = spread.withColumn("_p", p).withColumn("_w", F.col("_p") * (1 - F.col("_p")))
    worked = worked.withColumn("_z", F.col("_eta") + (F.col("_y") - F.col("_p")) / F.col("_w"))
    parts = [F.lit(1.0), *[F.col(f) for f in features], F.col("_z")]
    size = len(parts)
    sums = [F.sum(F.col("_w") * parts[i] * parts[j]).alias(f"m_{i}_{j}") for i in range(size) for j in range(i, size)]
    found = {}
    for row in bounded_rows(worked.groupBy("model").agg(*sums), len(models), "model"):
        square = np.zeros((size, size))
        for i in range(size):
            for j in range(i, size):
                square[i, j] = square[j, i] = row[f"m_{i}_{j}"]
        found[row["model"]] = Moments(tuple(features), square, np.zeros(size))
    return found


def fit_logistic(
    df: DataFrame, features: list[str], label: str, fold: str, folds: int, steps: int = 8, alpha: float = 1.0
) -> dict[int, Ridge]:
    """The model of each fold, fitted on the other folds, and under ``WHOLE`` the one of all rows.

    ``steps`` reweighted least-squares steps from zero, with ``alpha`` on the
    squared weights of the features. A label, feature or fold that is null
    takes its row out of every fit. A fold whose other folds are empty has no model.
    """
    numbers = df.select(
        F.col(fold).cast("int").alias(fold), F.col(label), *[F.col(f).cast("double").alias(f) for f in features]
    ).na.drop()
    start = Ridge(tuple(features), (0.0,) * len(features), 0.0)
    models = {i: start for i in (*range(folds), WHOLE)}
    for _ in range(steps):
        moments = _weighted_moments(numbers, label, fold, models)
        models = {i: fit_ridge(m, alpha) for i, m in sorted(moments.items())}
        if not models:
            break
    return models


def held_out_probability(models: dict[int, Ridge], fold: str) -> Column:
    """Each row scored by the model that did not see it."""
    return probability(out_of_fold({i: m for i, m in models.items() if i != WHOLE}, fold))


def mean_probability(models: dict[int, Ridge]) -> Column:
    """Mean of the fold models, for rows that none of them saw."""
    parts = [probability(m.column()) for i, m in models.items() if i != WHOLE]
    return total(parts) / F.lit(float(len(parts)))


def one_against_rest(
    df: DataFrame, features: list[str], label: str, classes: list, fold: str, folds: int, steps: int = 8, alpha: float = 1.0
) -> dict[object, dict[int, Ridge]]:
    """For each class the fold models that tell it from all others."""
    return {
        c: fit_logistic(df.withColumn("_own", (F.col(label) == c).cast("int")), features, "_own", fold, folds, steps, alpha)
        for c in classes
    }


def class_shares(scores: list[Column]) -> Column:
    """One-against-rest probabilities made to add up to one."""
    made = F.array(*scores)
    return F.transform(F.array(made), lambda s: F.transform(s, lambda x: x / F.aggregate(s, F.lit(0.0), lambda a, b: a + b)))[0]
