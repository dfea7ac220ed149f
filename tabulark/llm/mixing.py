"""Mixing sources to target weights: capped water-filling, then whole and fractional repetitions."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from tabulark.llm.common import word_count
from tabulark.operators.joins import null_safe_join
from tabulark.operators.ordering import numbered
from tabulark.session import pin

WEIGHTS = (3, 1, 2)
SLICES = 1 << 16


def source_weights(sources: DataFrame, source: str, weights: tuple[int, ...]) -> DataFrame:
    """Adds ``_weight``: the weights dealt in turn to the sources in code-point order, null last."""
    placed = numbered(sources.withColumn("_absent", F.col(source).isNull()), [], ["_absent", source])
    turn = F.pmod(F.col("_n") - 1, F.lit(len(weights)))
    cases = [F.when(turn == i, F.lit(w)) for i, w in enumerate(weights)]
    return placed.select(source, "_total", F.coalesce(*cases).cast("long").alias("_weight"))


def water_level(sources: DataFrame, share: float, epochs: float) -> tuple[float, int]:
    """The level at which min(epochs * size, level * weight) sums to ``share`` of all sizes.

    Each round clamps the sources above their cap and spreads the rest over the
    free weights. Clamped sources stay clamped, so the level only rises; a round
    is one small aggregate, and at most as many rounds as sources are needed.
    """
    total = sources.agg(F.sum("_total")).first()[0] or 0
    wanted, cap = share * total, F.lit(epochs) * F.col("_total")
    level, clamped = 0.0, -1
    while True:
        over = cap <= F.lit(level) * F.col("_weight")
        row = sources.agg(
            F.sum(F.when(over, F.col("_total")).otherwise(F.lit(0))).alias("full"),
            F.sum(F.when(over, F.lit(0)).otherwise(F.col("_weight"))).alias("free"),
            F.sum(over.cast("long")).alias("n"),
        ).first()
        if not row["free"] or row["n"] == clamped:
            return level, total
        level, clamped = (wanted - epochs * row["full"]) / row["free"], row["n"]


def spread_rounding(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Whole numbers of documents per size whose words follow the wanted share, large sizes first.

    The rounding error of a size is carried to the next smaller one, so what is
    left at the end is at most half of the smallest document.
    """
    for part in parts:
        part = part.sort_values("_size", ascending=False)
        carry, picked = 0.0, []
        for size, n, share in zip(part["_size"], part["_n"], part["_share"]):
            want = share * n * size + carry
            k = min(max(math.floor(want / size + 0.5), 0), n) if size else 0
            carry = want - k * size
            picked.append(k)
        yield part.assign(_picked=picked)[["_source", "_size", "_picked"]]


def mix_sources(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    share: float = 1.5,
    epochs: float = 2.0,
    weights: tuple[int, ...] = WEIGHTS,
    seed: int = 17,
) -> DataFrame:
    """``docs`` plus ``size``, ``source_size``, ``target`` and ``copies``.

    Sizes are white-space words. The sources share ``share`` times all words in
    proportion to their weights, none above ``epochs`` times its own words. A
    source whose target is r times its size repeats every document floor(r)
    times; the rest of r is reached by one more copy of some documents, chosen
    by a seeded hash among documents of equal size. How many per size comes
    from the counts of sizes, rounded from large to small, so the words taken
    end within half a small document of the target.

    Only (source, size, hash) travels before the choice. A source with a third
    of all rows is cut by size and by the leading bits of the hash. One task
    sees the distinct sizes of a source: their number is at most the square
    root of twice its words.

    Defined cases: a null text has size 0 and is never taken more than the
    whole repetitions; null sources form one source, the last in order; rows
    that repeat a key and text are drawn alike or one after the other; input
    columns of the four names are replaced.
    """
    draw = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    rows = docs.select(
        F.struct("*").alias("_row"), F.col(source).alias("_source"), word_count(F.col(text)).alias("_size"), draw.alias("_draw")
    )
    narrow = pin(rows.select("_source", "_size", "_draw"))
    slice_of: Column = F.shiftrightunsigned(F.col("_draw"), 48).cast("int")
    slices = pin(narrow.groupBy("_source", "_size", slice_of.alias("_slice")).agg(F.count(F.lit(1)).alias("_n")))
    classes = pin(slices.groupBy("_source", "_size").agg(F.sum("_n").alias("_n")))
    sources = classes.groupBy("_source").agg(F.sum(F.col("_n") * F.col("_size")).alias("_total"))
    weighted = pin(source_weights(sources, "_source", weights))
    level, _ = water_level(weighted, share, epochs)
    aims = weighted.select(
        "_source",
        F.col("_total"),
        F.least(F.lit(epochs) * F.col("_total"), F.lit(level) * F.col("_weight")).alias("_target"),
    ).select(
        "*",
        F.when(F.col("_total") > 0, F.col("_target") / F.col("_total")).otherwise(F.lit(0.0)).alias("_ratio"),
    )
    aims = pin(aims.select("*", F.floor("_ratio").alias("_whole"), (F.col("_ratio") - F.floor("_ratio")).alias("_share")))

    counted = null_safe_join(classes, aims.select("_source", "_share"), ["_source"])
    quota = pin(
        counted.repartition("_source")
        .groupBy("_source")
        .applyInPandas(lambda p: next(spread_rounding(iter([p]))), T.StructType([*classes.schema.fields[:2], T.StructField("_picked", T.LongType())]))
    )
    # The slice of the hash at which a size reaches its number, and how many are still due there.
    before = Window.partitionBy("_source", "_size").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    last = pin(
        null_safe_join(
            slices.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))), quota, ["_source", "_size"]
        )
        .where((F.col("_before") < F.col("_picked")) & (F.col("_picked") <= F.col("_before") + F.col("_n")))
        .select("_source", "_size", F.col("_slice").alias("_edge"), (F.col("_picked") - F.col("_before")).alias("_due"))
    )
    edge = null_safe_join(narrow, last, ["_source", "_size"]).where(slice_of == F.col("_edge"))
    cut = (
        edge.withColumn("_r", F.row_number().over(Window.partitionBy("_source", "_size").orderBy("_draw")))
        .where(F.col("_r") == F.col("_due"))
        .select("_source", "_size", F.col("_draw").alias("_cut"))
    )
    # Unsigned order of the draws is the order of (slice, draw) above.
    upto = (slice_of < F.shiftrightunsigned(F.col("_cut"), 48).cast("int")) | (
        (slice_of == F.shiftrightunsigned(F.col("_cut"), 48).cast("int")) & (F.col("_draw") <= F.col("_cut"))
    )
    plan = null_safe_join(classes.drop("_n"), cut, ["_source", "_size"], "left")
    plan = null_safe_join(plan, aims, ["_source"])
    met = null_safe_join(rows, plan, ["_source", "_size"])
    names = ("size", "source_size", "target", "copies")
    return met.select(
        *[F.col("_row").getField(c).alias(c) for c in docs.columns if c not in names],
        F.col("_size").alias("size"),
        F.col("_total").cast("long").alias("source_size"),
        F.col("_target").alias("target"),
        (F.col("_whole") + F.coalesce(upto, F.lit(False)).cast("long")).alias("copies"),
    )


def repeated(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The mix itself: every document as many times as ``copies`` says."""
    times = F.array_repeat(F.lit(0), F.col("copies").cast("int"))
    return mixed.select(*columns, F.explode(times).alias("_again")).drop("_again")
