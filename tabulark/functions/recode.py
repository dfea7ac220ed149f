"""Code and label recoding with small literal maps."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F


def literal_map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(v) for v in chain.from_iterable(pairs.items())])


def recode(col: Column, pairs: dict) -> Column:
    """Replace known codes and keep the others as they are."""
    return F.coalesce(literal_map(pairs)[col], col.cast("string"))


def fold_rare(col: Column, kept: list, other: str = "other") -> Column:
    """One shared label for every code outside ``kept``."""
    return F.when(col.isin(kept), col).otherwise(F.lit(other))


def inverted(pairs: dict) -> dict:
    """Label to code; where several codes share a label the last one stays."""
    return {label: code for code, label in pairs.items()}


def emphasis(col: Column, chosen: str, strong: float = 0.8, weak: float = 0.15) -> Column:
    """Weight that lifts the chosen category and dims the rest; ``all`` lifts every row."""
    if chosen == "all":
        return F.lit(strong)
    return F.when(col == chosen, F.lit(strong)).otherwise(F.lit(weak))
