"""Fitted scalers and encoders: ``fit_*`` returns small literal parameters."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.functions.numeric import zero_as_null
from tabulark.operators.aggregate import quartile_table
from tabulark.operators.project import distinct_values


@dataclass(frozen=True)
class LinearScale:
    """``(x - center) / spread`` per column; a spread of 0 gives null."""

    center: dict[str, float]
    spread: dict[str, float]

    def column(self, name: str) -> Column:
        spread = zero_as_null(F.lit(self.spread[name]).cast("double"))
        return (F.col(name) - F.lit(self.center[name])) / spread

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: self.column(c) for c in self.center})


def _from_row(row, cols: list[str]) -> LinearScale:
    return LinearScale({c: row[f"{c}_a"] for c in cols}, {c: row[f"{c}_b"] for c in cols})


def fit_z_score(df: DataFrame, cols: list[str], population: bool = False) -> LinearScale:
    std = F.stddev_pop if population else F.stddev_samp
    row = df.agg(
        *[F.avg(c).alias(f"{c}_a") for c in cols], *[std(c).alias(f"{c}_b") for c in cols]
    ).first()
    return _from_row(row, cols)


def fit_min_max(df: DataFrame, cols: list[str]) -> LinearScale:
    row = df.agg(
        *[F.min(c).cast("double").alias(f"{c}_a") for c in cols],
        *[(F.max(c) - F.min(c)).cast("double").alias(f"{c}_b") for c in cols],
    ).first()
    return _from_row(row, cols)


def fit_robust(df: DataFrame, cols: list[str]) -> LinearScale:
    """Median and interquartile range, both exact."""
    rows = {r["column"]: r for r in quartile_table(df, cols).collect()}
    return LinearScale(
        {c: rows[c]["q50"] for c in cols}, {c: rows[c]["q75"] - rows[c]["q25"] for c in cols}
    )


@dataclass(frozen=True)
class OneHot:
    """One 0/1 column per category seen while fitting; unseen ones give all zeros."""

    levels: dict[str, list]

    def columns(self) -> list[Column]:
        return [
            F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{c}_{v}")
            for c, values in self.levels.items()
            for v in values
        ]

    def apply(self, df: DataFrame, keep_source: bool = False) -> DataFrame:
        kept = [c for c in df.columns if keep_source or c not in self.levels]
        return df.select(*kept, *self.columns())


def fit_one_hot(df: DataFrame, cols: list[str], most: int = 200) -> OneHot:
    return OneHot({c: distinct_values(df, c, most) for c in cols})


@dataclass(frozen=True)
class MixedEncoder:
    """Robust scaling of numbers and one-hot categories in one projection."""

    scale: LinearScale
    onehot: OneHot

    def apply(self, df: DataFrame, keep: list[str]) -> DataFrame:
        scaled = [self.scale.column(c).alias(c) for c in self.scale.center]
        return df.select(*keep, *scaled, *self.onehot.columns())


def fit_mixed(df: DataFrame, numbers: list[str], categories: list[str]) -> MixedEncoder:
    return MixedEncoder(fit_robust(df, numbers), fit_one_hot(df, categories))
