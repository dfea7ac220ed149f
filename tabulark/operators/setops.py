"""Unions by name with the source of each row kept as a column."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stacked(parts: dict[str, DataFrame], tag: str = "part") -> DataFrame:
    """Union of named parts; the name travels in ``tag`` so the parts can be told apart later."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def part_of(df: DataFrame, name: str, tag: str = "part") -> DataFrame:
    return df.where(F.col(tag) == name).drop(tag)


def union_distinct(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts).distinct()
