"""Standard normal density and distribution as column expressions, to double precision.

The distribution function is a published ratio of polynomials (Hart 1968) times
the density; beyond seven and a bit it is a continued fraction. Both sides come
from the tail of the absolute value, so small tails keep their digits.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published approximation, highest power first.
UPPER = (
    3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
)
LOWER = (
    8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
)
SWITCH = 7.07106781186547
ROOT_TWO_PI = math.sqrt(2.0 * math.pi)


def density(x: Column) -> Column:
    return F.exp(-(x * x) / 2.0) / F.lit(ROOT_TWO_PI)


def _polynomial(x: Column, coefficients: tuple[float, ...]) -> Column:
    total = F.lit(coefficients[0])
    for c in coefficients[1:]:
        total = total * x + F.lit(c)
    return total


def distribution(x: Column) -> Column:
    size = F.abs(x)
    fraction = size + 0.65
    for i in (4.0, 3.0, 2.0, 1.0):
        fraction = size + F.lit(i) / fraction
    tail = F.when(
        size < SWITCH, F.exp(-(x * x) / 2.0) * _polynomial(size, UPPER) / _polynomial(size, LOWER)
    ).otherwise(density(x) / fraction)
    return F.when(x > 0, F.lit(1.0) - tail).otherwise(tail)
