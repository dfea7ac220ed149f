"""Column selection, renaming, pairing and interactions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulark.operators.joins import bounded_rows


def drop_generated(df: DataFrame, prefix: str, numbers: range, extra: tuple[str, ...] = ()) -> DataFrame:
    """Drop ``prefix0 .. prefixN`` plus the extra names."""
    return df.drop(*[f"{prefix}{i}" for i in numbers], *extra)


def aligned(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Select the columns of ``names`` under the names of another schema."""
    return df.select(*[F.col(old).alias(new) for old, new in names.items()])


def paired_difference(df: DataFrame, triples: list[tuple[str, str, str]]) -> DataFrame:
    """Add ``out = left - right`` for each triple and drop all inputs."""
    used = {c for _, left, right in triples for c in (left, right)}
    kept = [c for c in df.columns if c not in used]
    return df.select(*kept, *[(F.col(a) - F.col(b)).alias(out) for out, a, b in triples])


def columns_by_kind(df: DataFrame) -> dict[str, list[str]]:
    """Column names split into number, text and other."""
    kinds: dict[str, list[str]] = {"number": [], "text": [], "other": []}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.NumericType):
            kinds["number"].append(field.name)
        elif isinstance(field.dataType, T.StringType):
            kinds["text"].append(field.name)
        else:
            kinds["other"].append(field.name)
    return kinds


def sorted_columns(df: DataFrame) -> DataFrame:
    return df.select(*sorted(df.columns))


def distinct_values(df: DataFrame, col: str, most: int = 200) -> list:
    """Sorted distinct values for data-dependent columns; too many is an error."""
    rows = bounded_rows(df.select(col).where(F.col(col).isNotNull()).distinct(), most, col)
    return sorted(r[0] for r in rows)


def conditional_columns(key: str, value: str, levels: list) -> list[Column]:
    """``value`` where the key equals the level and 0 elsewhere, one column per level."""
    return [
        F.when(F.col(key) == F.lit(level), F.col(value)).otherwise(F.lit(0)).alias(f"{value}_{key}_{level}")
        for level in levels
    ]


def flag_interactions(flag: str, values: list[str]) -> list[Column]:
    """Each value times the 0/1 flag and times its complement."""
    columns = []
    for v in values:
        columns.append((F.col(v) * F.col(flag)).alias(f"{v}_x_{flag}"))
        columns.append((F.col(v) * (1 - F.col(flag))).alias(f"{v}_x_not_{flag}"))
    return columns


def first_rows(df: DataFrame, order: list[str], n: int, last: bool = False) -> DataFrame:
    """First or last ``n`` rows in a stated order (a bounded top-n, never a full sort)."""
    keys = [F.col(c).desc() if last else F.col(c).asc() for c in order]
    return df.orderBy(*keys).limit(n)
