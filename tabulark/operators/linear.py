"""Ridge regression from moments that one distributed pass collects per fold."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.functions.numeric import total
from tabulark.operators.joins import bounded_rows


@dataclass(frozen=True)
class Moments:
    """Sums of products of (1, features..., target), measured from ``origin``; they add up over folds."""

    features: tuple[str, ...]
    products: np.ndarray
    origin: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.features, self.products + other.products, self.origin)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.features, self.products - other.products, self.origin)

    @property
    def rows(self) -> float:
        return self.products[0, 0]

    def scaled(self, stats: dict[str, tuple[float, float]]) -> Moments:
        """The moments of ``(x - mean) / std`` for the named features; no second pass is needed."""
        move, origin = np.eye(self.products.shape[0]), self.origin.copy()
        for name, (mean, std) in stats.items():
            i = 1 + self.features.index(name)
            move[i, i] = 1.0 / std
            move[i, 0] = (origin[i] - mean) / std
            origin[i] = 0.0
        return Moments(self.features, move @ self.products @ move.T, origin)

    def renamed(self, names: list[str]) -> Moments:
        return Moments(tuple(names), self.products, self.origin)

    def mean_std(self, feature: str) -> tuple[float, float]:
        """Mean and sample standard deviation of one feature."""
        i = 1 + self.features.index(feature)
        mean = self.products[0, i] / self.rows
        square = self.products[i, i] - self.rows * mean * mean
        return mean + self.origin[i], float(np.sqrt(max(square, 0.0) / (self.rows - 1)))


def origin_of(df: DataFrame, names: list[str]) -> np.ndarray:
    """Mean of all rows, with a leading 0 for the constant; a column without values counts 0."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"_{i}") for i, c in enumerate(names)]).first()
    return np.array([0.0, *[x if x is not None else 0.0 for x in row]])


def moments_by_fold(
    df: DataFrame,
    features: list[str],
    target: str,
    fold: str,
    most_folds: int = 200,
    origin: np.ndarray | None = None,
) -> dict[int, Moments]:
    """One aggregate row per fold; the products are summed map-side first.

    Values are measured from ``origin``, by default the mean of all rows. Any
    origin gives the same moments; one inside the data keeps the digits that
    large values would cost. Rows with a null fold belong to no moment.
    """
    names = [*features, target]
    if origin is None:
        origin = origin_of(df, names)
    parts = [F.lit(1.0), *[F.col(c).cast("double") - F.lit(float(o)) for c, o in zip(names, origin[1:], strict=True)]]
    size = len(parts)
    sums = [
        F.sum(parts[i] * parts[j]).alias(f"m_{i}_{j}") for i in range(size) for j in range(i, size)
    ]
    found = {}
    for row in bounded_rows(df.groupBy(fold).agg(*sums), most_folds, fold):
        if row[fold] is None:
            continue
        square = np.zeros((size, size))
        for i in range(size):
            for j in range(i, size):
                square[i, j] = square[j, i] = row[f"m_{i}_{j}"]
        found[row[fold]] = Moments(tuple(features), square, origin)
    return dict(sorted(found.items()))


def all_moments(by_fold: dict[int, Moments]) -> Moments:
    parts = list(by_fold.values())
    return sum(parts[1:], parts[0])


@dataclass(frozen=True)
class Ridge:
    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        terms = [F.lit(w) * F.col(c) for w, c in zip(self.weights, self.features, strict=True)]
        return total([*terms, F.lit(self.intercept)])


def fit_ridge(m: Moments, alpha: float = 1.0, subset: list[str] | None = None) -> Ridge:
    """Least squares with ``alpha`` on the squared weights; the intercept is free."""
    names = list(subset if subset is not None else m.features)
    at = [1 + m.features.index(n) for n in names]
    mean = m.products[0, at] / m.rows
    target_mean = m.products[0, -1] / m.rows
    square = m.products[np.ix_(at, at)] - m.rows * np.outer(mean, mean)
    cross = m.products[at, -1] - m.rows * mean * target_mean
    weights = np.linalg.solve(square + alpha * np.eye(len(names)), cross)
    intercept = target_mean + m.origin[-1] - weights @ (mean + m.origin[at])
    return Ridge(tuple(names), tuple(float(w) for w in weights), float(intercept))


def squared_error(m: Moments, model: Ridge) -> float:
    """Sum of squared errors of ``model`` on the rows behind ``m``, without touching them."""
    full = np.zeros(m.products.shape[0])
    for name, w in zip(model.features, model.weights, strict=True):
        full[1 + m.features.index(name)] = w
    full[-1] = -1.0
    full[0] = model.intercept + full @ m.origin
    return float(full @ m.products @ full)


def fold_models(
    by_fold: dict[int, Moments], alpha: float = 1.0, subset: list[str] | None = None
) -> dict[int, Ridge]:
    """The model of fold ``i`` is fitted on every other fold."""
    whole = all_moments(by_fold)
    return {i: fit_ridge(whole - m, alpha, subset) for i, m in by_fold.items()}


def out_of_fold(models: dict[int, Ridge], fold: str) -> Column:
    """Each row scored by the model that did not see it: one projection, no join."""
    return F.coalesce(*[F.when(F.col(fold) == i, m.column()) for i, m in models.items()])


def mean_prediction(models: dict[int, Ridge]) -> Column:
    return total([m.column() for m in models.values()]) / F.lit(float(len(models)))


def scaled_out_of_fold(by_fold: dict[int, Moments], fold: str, features: list[str]) -> list[Column]:
    """Features scaled with the mean and std of the other folds."""
    whole = all_moments(by_fold)
    columns = []
    for f in features:
        picks = []
        for i, m in by_fold.items():
            mean, std = (whole - m).mean_std(f)
            picks.append(F.when(F.col(fold) == i, (F.col(f) - F.lit(mean)) / F.lit(std or None)))
        columns.append(F.coalesce(*picks).alias(f"{f}_scaled"))
    return columns


def cross_validated_rmse(
    by_fold: dict[int, Moments], alpha: float, subset: list[str] | None = None
) -> dict[int, float]:
    models = fold_models(by_fold, alpha, subset)
    return {i: float(np.sqrt(squared_error(m, models[i]) / m.rows)) for i, m in by_fold.items()}


def alpha_grid(by_fold: dict[int, Moments], alphas: list[float]) -> list[tuple[float, int, float]]:
    """(alpha, fold, rmse) for every grid point, all from the same moments."""
    return [(a, i, e) for a in alphas for i, e in cross_validated_rmse(by_fold, a).items()]


def forward_selection(
    train: Moments, valid: Moments, start: list[str], candidates: list[str], alpha: float = 1.0
) -> list[tuple[int, str, float, bool]]:
    """Try each candidate once and keep it when the validation error falls.

    Returns (step, candidate, rmse, kept); step 0 is the starting set.
    """

    def error(names: list[str]) -> float:
        return float(np.sqrt(squared_error(valid, fit_ridge(train, alpha, names)) / valid.rows))

    kept = list(start)
    best = error(kept)
    trace = [(0, "", best, True)]
    for step, name in enumerate(candidates, 1):
        score = error([*kept, name])
        better = score < best
        if better:
            kept, best = [*kept, name], score
        trace.append((step, name, score, better))
    return trace
