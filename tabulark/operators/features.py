"""Generated feature columns; every builder returns columns for one ``select``."""

from __future__ import annotations

from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column
from pyspark.sql import functions as F

RATIO_SHIFT = 1e-5
MOST_COLUMNS = 200


def _named(names: tuple[str, ...], joint: str) -> str:
    return joint.join(names)


def _product(names: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a * b, [F.col(n) for n in names])


def products(cols: list[str], ways: int, joint: str = "_x_") -> list[Column]:
    """All ``ways``-fold products with repetition."""
    picks = list(combinations_with_replacement(cols, ways))
    if len(picks) > MOST_COLUMNS:
        raise ValueError(f"{len(picks)} columns in one stage; split the list")
    return [_product(p).alias(_named(p, joint)) for p in picks]


def log_products(cols: list[str], ways: int) -> list[Column]:
    return [
        F.log1p(_product(p)).alias("log_" + _named(p, "_x_"))
        for p in combinations_with_replacement(cols, ways)
    ]


def pair_sums(cols: list[str]) -> list[Column]:
    """``a*b + c*d`` for every four-fold pick with repetition."""
    return [
        (_product(p[:2]) + _product(p[2:])).alias(_named(p, "_p_"))
        for p in combinations_with_replacement(cols, 4)
    ]


def log_pair_sums(cols: list[str]) -> list[Column]:
    """log1p of ``a*b + c*d`` for every four-fold pick with repetition."""
    return [
        F.log1p(_product(p[:2]) + _product(p[2:])).alias("log_" + _named(p, "_p_"))
        for p in combinations_with_replacement(cols, 4)
    ]


def ratios(cols: list[str], shift: float = RATIO_SHIFT) -> list[Column]:
    """``a / (b + shift)`` for every pair with repetition."""
    return [
        (F.col(a) / (F.col(b) + F.lit(shift))).alias(f"{a}_d_{b}")
        for a, b in combinations_with_replacement(cols, 2)
    ]


def domain_ratios(mass: str, size: str, load: str, time: str, age: str, cap: float) -> list[Column]:
    """Body-index, intensity, load-by-time, distance to a cap and share of the cap.

    A divisor of 0 gives null.
    """
    index = F.try_divide(F.col(mass), (F.col(size) / 100) * (F.col(size) / 100))
    room = F.lit(cap) - F.col(age)
    return [
        index.alias("body_index"),
        F.try_divide(load, time).alias("intensity"),
        (F.col(load) * F.col(time)).alias("load_time"),
        F.try_divide(load, age).alias("load_by_age"),
        (F.col(age) * index).alias("age_index"),
        room.alias("room"),
        F.try_divide(F.col(load), room).alias("load_of_room"),
    ]
