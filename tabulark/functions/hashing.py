"""Hash columns that do not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(keys: list[str], seed: str) -> Column:
    """Hex md5 of the key values and a seed."""
    return F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys], F.lit(seed)))


def bucket32(keys: list[str], seed: str) -> Column:
    """Unsigned 32-bit number from the first eight hex digits of :func:`digest`."""
    return F.conv(F.substring(digest(keys, seed), 1, 8), 16, 10).cast("long")


def unit_draw(keys: list[str], seed: str) -> Column:
    """A draw in [0, 1)."""
    return bucket32(keys, seed) / F.lit(4294967296.0)
