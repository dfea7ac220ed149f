"""Hash-based splits, folds and resampling; the same row always gets the same draw."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.functions.hashing import bucket32, digest, unit_draw
from tabulark.operators.joins import bounded_rows
from tabulark.operators.ordering import hash_ranks, quantiles


def holdout_flag(keys: list[str], seed: str, share: float = 0.2) -> Column:
    return unit_draw(keys, seed) < F.lit(share)


def fold_number(keys: list[str], seed: str, folds: int) -> Column:
    return F.pmod(bucket32(keys, seed), F.lit(folds)).cast("int")


def stratified_holdout(
    df: DataFrame, label: str, keys: list[str], seed: str, share: float = 0.2, digits: int | None = None
) -> DataFrame:
    """Adds ``is_test``: exactly round(share * n) rows of every class."""
    ranked = hash_ranks(df, [label], keys, seed, "_rank", digits)
    return ranked.withColumn(
        "is_test", F.col("_rank") <= F.floor(F.col("_rank_total") * F.lit(share) + 0.5)
    ).drop("_rank", "_rank_total")


def stratified_folds(
    df: DataFrame, label: str, keys: list[str], seed: str, folds: int, digits: int | None = None
) -> DataFrame:
    """Adds ``fold``: every class is spread over the folds as evenly as it divides."""
    ranked = hash_ranks(df, [label], keys, seed, "_rank", digits)
    return ranked.withColumn("fold", F.pmod(F.col("_rank") - 1, F.lit(folds)).cast("int")).drop(
        "_rank", "_rank_total"
    )


def quantile_edges(df: DataFrame, col: str, bins: int) -> list[float]:
    """Inner bin edges at exact quantiles, repeated edges removed."""
    probs = {f"e{i}": i / bins for i in range(bins + 1)}
    row = quantiles(df.select(F.col(col).cast("double").alias(col)), [], col, probs).first()
    edges = sorted({row[n] for n in probs})
    return edges[1:-1]


def quantile_bin(col: str, inner_edges: list[float]) -> Column:
    """Ordinal bin: the number of inner edges at or below the value."""
    if not inner_edges:
        return F.lit(0)
    edges = F.array(*[F.lit(e) for e in inner_edges])
    return F.size(F.filter(edges, lambda e: e <= F.col(col)))


def upsample_minority(
    df: DataFrame, label: str, minority, majority, key: str, seed: str, digits: int | None = None
) -> DataFrame:
    """Majority rows plus as many minority draws with replacement.

    Draw ``i`` takes the minority row numbered hash(i) mod n. The draws are
    counted per number before they meet the rows, and each row then repeats
    itself, so no draw list and no class is gathered anywhere.
    """
    sizes = {
        r[label]: r["n"]
        for r in bounded_rows(
            df.where(F.col(label).isin([minority, majority]))
            .groupBy(label)
            .agg(F.count(F.lit(1)).alias("n")),
            2,
            label,
        )
    }
    spark = df.sparkSession
    draws = (
        spark.range(sizes.get(majority, 0))
        .select(
            (F.pmod(bucket32(["id"], seed), F.lit(max(sizes.get(minority, 1), 1))) + 1).alias("_rank")
        )
        .groupBy("_rank")
        .agg(F.count(F.lit(1)).alias("_times"))
    )
    rows = hash_ranks(df.where(F.col(label) == minority), [label], [key], seed, "_rank", digits)
    repeated = (
        rows.join(draws, "_rank")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
        .drop("_rank", "_rank_total", "_times")
    )
    return df.where(F.col(label) == majority).withColumn("copy", F.lit(0).cast("long")).unionByName(repeated)


def shuffled(df: DataFrame, keys: list[str], seed: str) -> DataFrame:
    """Rows in a seeded random order (range-partitioned sort on the hash)."""
    return df.orderBy(digest(keys, seed), *keys)


def shuffled_position(df: DataFrame, keys: list[str], seed: str, digits: int | None = None) -> DataFrame:
    """One-based place of each row in the seeded order."""
    return hash_ranks(df, [], keys, seed, "position", digits).drop("position_total")
