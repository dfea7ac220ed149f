"""Prediction tables of several models: long store, wide view, blends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def long_predictions(wide: DataFrame, key: list[str], models: list[str]) -> DataFrame:
    """(key, model, pred) rows from one column per model."""
    pairs = [F.struct(F.lit(m).alias("model"), F.col(m).alias("pred")) for m in models]
    return wide.select(*key, F.explode(F.array(*pairs)).alias("_p")).select(*key, "_p.*")


def wide_predictions(long: DataFrame, key: list[str], models: list[str]) -> DataFrame:
    """One column per model; the model list is given, so one aggregate does it."""
    return long.groupBy(*key).agg(
        *[F.max(F.when(F.col("model") == m, F.col("pred"))).alias(m) for m in models]
    )


def bound_columns(parts: list[DataFrame], key: list[str]) -> DataFrame:
    """Keyed form of a column bind: inner joins that must not lose a row."""
    return reduce(lambda a, b: a.join(b, key), parts)


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def blend(wide: DataFrame, key: list[str], weights: dict[str, float]) -> DataFrame:
    """Weighted mean of the model columns; a projection."""
    weighted = _total([F.lit(w) * F.col(m) for m, w in weights.items()])
    return wide.select(*key, (weighted / sum(weights.values())).alias("pred"))


def log_blend(wide: DataFrame, key: list[str], models: list[str]) -> DataFrame:
    """Mean of the model columns in log space, back in the original unit; a projection."""
    return wide.select(*key, F.expm1(_total([F.log1p(m) for m in models]) / len(models)).alias("pred"))
