"""Numeric column expressions."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def scaled_size(x: Column, divisor: float, low: float, high: float) -> Column:
    """Marker size: ``x / divisor`` held inside [low, high]."""
    return clip(x / F.lit(divisor), low, high)


def zero_as_null(x: Column) -> Column:
    """Divisor guard: an all-equal column has no spread, its scaled value is null."""
    return F.when(x != 0, x)


def total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body or its lambdas use it."""
    return F.transform(F.array(value), body)[0]


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v)


def softmax(scores: Column) -> Column:
    """Softmax over an array of scores, shifted by the row maximum."""
    return let(
        scores,
        lambda s: let(
            F.array_max(s),
            lambda top: let(
                F.transform(s, lambda x: F.exp(x - top)),
                lambda raised: let(
                    array_sum(raised), lambda whole: F.transform(raised, lambda e: e / whole)
                ),
            ),
        ),
    )


def distance(a: Column, b: Column) -> Column:
    """Euclidean distance between two arrays of equal length."""
    return F.sqrt(array_sum(F.zip_with(a, b, lambda x, y: (x - y) * (x - y))))


def double_matrix(rows: list[list[float]]) -> Column:
    """A small fixed matrix as one array-of-arrays constant."""
    text = ",".join("array(" + ",".join(f"{v!r}D" for v in row) + ")" for row in rows)
    return F.expr(f"array({text})")


def tidy(x: Column, digits: int) -> Column:
    """Rounded after a nudge far below the last digit, so that exact halves round alike everywhere."""
    return F.round(x + F.lit(float(f"1e-{digits + 3}")), digits)
