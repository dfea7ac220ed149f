"""Joins whose broadcast side is measured first and whose large form splits hot keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulark.session import pin

BROADCAST_BYTES = 64 * 1024 * 1024
ROW_BYTES = 24
SALTS = 16
MOST_HOT_KEYS = 1_000


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi join in which null keys meet; the key columns of the left side stay."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") for c in on], *[c for c in right.columns if c not in on]
    )
    met = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    return left.join(renamed, met, how).drop(*[f"_r_{c}" for c in on])


def _cell_bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(field.name), F.lit(0)).cast("long")
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.octet_length(F.to_json(F.struct(field.name))).cast("long")
    return F.lit(8).cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Approximate bytes of all rows, counted by one aggregate."""
    row = reduce(lambda a, b: a + b, [_cell_bytes(f) for f in df.schema.fields], F.lit(ROW_BYTES))
    return df.agg(F.sum(row)).first()[0] or 0


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    weight: str | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Shuffle join that spreads hot keys of ``big`` over ``salts`` tasks.

    ``weight`` names a column of ``small`` that says how many rows of ``big``
    carry the key. Keys above a thousandth of the total are hot; there are
    fewer than a thousand of them whatever the data, so their list is
    broadcast, and only they are copied. Without a weight every key is spread.
    The salt comes from the row itself, so a repeated task sees the same one.
    """
    last = F.lit(salts - 1).cast("long")
    every = F.sequence(F.lit(0).cast("long"), last)
    salt = F.pmod(F.xxhash64(*big.columns), F.lit(salts))
    if weight is None:
        spread = big.withColumn("_salt", salt)
        copies = small.withColumn("_salt", F.explode(every))
    else:
        limit = (small.agg(F.sum(weight)).first()[0] or 0) / MOST_HOT_KEYS
        is_hot = F.col(weight) > F.lit(limit)
        hot = small.where(is_hot).select(*on, F.lit(True).alias("_hot"))
        none = F.lit(0).cast("long")
        spread = (
            big.join(F.broadcast(hot), on, "left")
            .withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(none))
            .drop("_hot")
        )
        copies = small.withColumn("_salt", F.explode(F.when(is_hot, every).otherwise(F.array(none))))
    return spread.join(copies, [*on, "_salt"], how).drop("_salt")


def lookup(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "inner",
    weight: str | None = None,
    most_bytes: int = BROADCAST_BYTES,
    pinned: bool = False,
) -> DataFrame:
    """Attach the columns of ``small``: broadcast when its measured size allows, else salted.

    ``small`` is written once so that measuring and joining do not compute it
    twice; ``pinned`` says that the caller has done so.
    """
    if not pinned:
        small = pin(small)
    if measured_bytes(small) <= most_bytes:
        return big.join(F.broadcast(small), on, how)
    return salted_join(big, small, on, how, weight)


def bounded_rows(df: DataFrame, most: int, what: str) -> list:
    """Bring a small summary to the driver; more than ``most`` rows is an error."""
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{what}: more than {most} rows")
    return rows
