"""Order-dependent work without one task per series.

Rows are range-partitioned on (series, order) and written once, so a series of
any length lies in several evenly sized chunks. Each operator works inside the
chunks and carries one summary row per chunk across them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulark.functions.hashing import digest
from tabulark.operators.joins import null_safe_join
from tabulark.session import pin, shuffle_width

CHUNK = "_chunk"


def place(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """Range-partition by series and order; the chunk number becomes a column.

    The partition count is left to the session, so adaptive execution may merge
    small neighbours; merged ranges are still ranges.
    """
    keys = [F.col(c) for c in [*by, *order]]
    return pin(df.repartitionByRange(*keys).withColumn(CHUNK, F.spark_partition_id()))


def placed_once(df: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``df`` itself if it still has the chunks of an earlier placement by the same series and order."""
    return df if CHUNK in df.columns else place(df, by, order)


def running_sums(
    placed: DataFrame, by: list[str], order: list[str], sums: dict[str, Column]
) -> DataFrame:
    """Inclusive running sums per series, and the series total as ``<name>_total``."""
    inside = (
        Window.partitionBy(*by, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    per_chunk = placed.groupBy(*by, CHUNK).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    earlier = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    series = Window.partitionBy(*by)
    carried = per_chunk.select(
        *by,
        CHUNK,
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"{n}_before") for n in sums],
        *[F.sum(n).over(series).alias(f"{n}_total") for n in sums],
    )
    local = placed.select("*", *[F.sum(c).over(inside).alias(n) for n, c in sums.items()])
    joined = null_safe_join(local, carried, [*by, CHUNK])
    return joined.withColumns({n: F.col(n) + F.col(f"{n}_before") for n in sums}).drop(
        *[f"{n}_before" for n in sums]
    )


def neighbour(
    placed: DataFrame, by: list[str], order: list[str], value: str, name: str, ahead: bool = False
) -> DataFrame:
    """The value one row earlier (or later) in the series, across chunk borders."""
    step = F.lead if ahead else F.lag
    inside = Window.partitionBy(*by, CHUNK).orderBy(*order)
    edge = (F.min_by if ahead else F.max_by)(F.col(value), F.struct(*order))
    across = Window.partitionBy(*by).orderBy(CHUNK)
    carried = (
        placed.groupBy(*by, CHUNK)
        .agg(edge.alias("_edge"))
        .select(*by, CHUNK, step("_edge").over(across).alias("_near"))
    )
    local = placed.select(
        "*",
        step(value).over(inside).alias("_inside"),
        step(F.lit(1)).over(inside).isNull().alias("_at_edge"),
    )
    return (
        null_safe_join(local, carried, [*by, CHUNK])
        .withColumn(name, F.when(F.col("_at_edge"), F.col("_near")).otherwise(F.col("_inside")))
        .drop("_inside", "_at_edge", "_near")
    )


def numbered(df: DataFrame, by: list[str], order: list[str], name: str = "_n") -> DataFrame:
    """One-based row number per series (all rows when ``by`` is empty)."""
    return running_sums(placed_once(df, by, order), by, order, {name: F.lit(1)})


def with_run_up(placed: DataFrame, by: list[str], order: list[str], value: str, rows: int) -> DataFrame:
    """Each chunk of a series, preceded by the last ``rows`` values before it.

    ``_own`` is false on the run-up, where only ``by``, the chunk, ``value`` and
    ``_at`` are filled. ``_at`` falls from the last row of the run-up backwards
    and is null on own rows, so ``_own, _at desc, order`` sorts a chunk. A
    chunk hands on one array of at most ``rows`` values; short chunks are
    bridged by those before them.
    """
    backwards = Window.partitionBy(*by, CHUNK).orderBy(*[F.desc(c) for c in order])
    last = placed.select(*by, CHUNK, *order, value, F.row_number().over(backwards).alias("_at")).where(F.col("_at") <= rows)
    # Falling "_at" is the order of the series; a struct keeps null values.
    tails = F.sort_array(F.collect_list(F.struct((-F.col("_at")).alias("_at"), F.col(value).alias("v"))))
    earlier = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(-rows, -1)
    handed = (
        last.groupBy(*by, CHUNK)
        .agg(tails.alias("_tail"))
        .select(*by, CHUNK, F.flatten(F.collect_list("_tail").over(earlier)).alias("_before"))
    )
    cut = F.slice("_before", F.greatest(F.lit(1), F.size("_before") - rows + 1), rows)
    run_up = handed.where(F.size("_before") > 0).select(*by, CHUNK, cut.alias("_cut")).select(
        *by, CHUNK, F.size("_cut").alias("_n"), F.posexplode("_cut").alias("_i", "_s")
    )
    carried = run_up.select(*by, CHUNK, F.col("_s.v").alias(value), F.lit(False).alias("_own"), (F.col("_n") - F.col("_i")).alias("_at"))
    own = placed.withColumns({"_own": F.lit(True), "_at": F.lit(None).cast("int")})
    return own.unionByName(carried, allowMissingColumns=True)


def value_ranks(df: DataFrame, by: list[str], value: str, sums: dict[str, Column]) -> DataFrame:
    """Distinct values in order with running sums; equal rows meet before the shuffle."""
    grouped = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(
        *[F.sum(c).alias(f"_{n}") for n, c in sums.items()]
    )
    placed = place(grouped, by, [value])
    return running_sums(placed, by, [value], {n: F.col(f"_{n}") for n in sums})


def quantiles(df: DataFrame, by: list[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Exact, linearly interpolated quantiles per group: one row per group."""
    ranks = value_ranks(df, by, value, {"upto": F.lit(1)})

    def at(position: Column) -> Column:
        here = (F.col("upto") - F.col("_upto") <= position) & (position < F.col("upto"))
        return F.max(F.when(here, F.col(value)))

    parts = []
    for name, p in probs.items():
        spot = (F.col("upto_total") - 1) * F.lit(p)
        parts += [
            at(F.floor(spot)).alias(f"{name}_lo"),
            at(F.ceil(spot)).alias(f"{name}_hi"),
            F.max(spot - F.floor(spot)).alias(f"{name}_w"),
        ]
    return (
        ranks.groupBy(*by)
        .agg(*parts)
        .select(
            *by,
            *[
                (
                    F.col(f"{n}_lo") + (F.col(f"{n}_hi") - F.col(f"{n}_lo")) * F.col(f"{n}_w")
                ).alias(n)
                for n in probs
            ],
        )
    )


def hash_ranks(
    df: DataFrame, by: list[str], keys: list[str], seed: str, name: str = "_rank", digits: int | None = None
) -> DataFrame:
    """One-based rank per group in hash order, and the group size as ``<name>_total``.

    A group is cut by its leading hash digits, so even one class holding most
    rows is ranked by many tasks. Unless given, the digits follow the shuffle
    width: at least sixteen pieces of a group per shuffle partition.
    """
    if digits is None:
        digits = 1 + max(1, math.ceil(math.log(shuffle_width(df.sparkSession), 16)))
    hashed = df.withColumn("_h", digest(keys, seed)).withColumn(
        CHUNK, F.substring("_h", 1, digits)
    )
    return running_sums(hashed, by, ["_h", *keys], {name: F.lit(1)}).drop("_h", CHUNK)
