"""Counts, summaries, histograms and facets."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.operators.joins import lookup
from tabulark.operators.ordering import numbered, quantiles, value_ranks


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


def collapse_to_min(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """One row per feature combination, holding its lowest target."""
    return df.groupBy(*features).agg(F.min(target).alias(target))


def melted(df: DataFrame, cols: list[str]) -> DataFrame:
    """Long form (column, value) with double values."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in cols]
    return df.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.column", "_p.value")


#: Equal-width buckets of a column that a first count tells apart.
BUCKETS = 4096
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def plain_statistics(df: DataFrame, cols: list[str]) -> list[dict]:
    """Count, mean, sample std, min and max of each column, from one aggregate without a shuffle of rows."""
    kinds = {"n": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = df.agg(*[f(F.col(c).cast("double")).alias(f"{k}_{i}") for i, c in enumerate(cols) for k, f in kinds.items()]).first()
    return [{"column": c, **{k: row[f"{k}_{i}"] for k in kinds}} for i, c in enumerate(cols)]


def _bucket(value: Column, low: float, high: float) -> Column:
    """Which of ``BUCKETS`` equal parts of [low, high] holds the value; never falls as the value rises."""
    if not high > low:
        return F.lit(0)
    return F.least(F.floor((value - F.lit(low)) / F.lit(high - low) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def narrowed_quantiles(
    df: DataFrame, cols: list[str], probs: dict[str, float], stats: list[dict] | None = None
) -> dict[str, dict[str, float | None]]:
    """Exact, linearly interpolated quantiles of several columns.

    A first scan counts equal-width buckets; a second one ranks the distinct
    values of only those buckets that hold a wanted place. Columns with values
    that are not finite are ranked in full. The driver sees bucket counts and
    the values at the wanted places. A column without values has null quantiles.
    """
    stats = stats or plain_statistics(df, cols)
    found: dict[str, dict[str, float | None]] = {s["column"]: dict.fromkeys(probs) for s in stats}
    held = [s for s in stats if s["n"] and math.isfinite(s["min"]) and math.isfinite(s["max"]) and math.isfinite(s["max"] - s["min"])]
    odd = [s["column"] for s in stats if s["n"] and s not in held]
    if odd:
        for row in quantiles(melted(df, odd), ["column"], "value", probs).collect():
            found[row["column"]] = {n: row[n] for n in probs}
    if not held:
        return found
    cells = [
        F.struct(F.lit(s["column"]).alias("column"), F.col(s["column"]).cast("double").alias("value"), _bucket(F.col(s["column"]).cast("double"), s["min"], s["max"]).alias("bucket"))
        for s in held
    ]
    long = df.select(F.explode(F.array(*cells)).alias("_p")).select("_p.*").where(F.col("value").isNotNull())
    counts: dict[str, dict[int, int]] = {}
    for row in long.groupBy("column", "bucket").agg(F.count(F.lit(1)).alias("n")).collect():
        counts.setdefault(row["column"], {})[row["bucket"]] = row["n"]
    # (column, bucket, zero-based place inside it) of both neighbours of every wanted place.
    wanted: dict[str, dict[int, tuple[int, int]]] = {}
    for s in held:
        ends, before = [], 0
        for bucket, n in sorted(counts[s["column"]].items()):
            ends.append((before + n, before, bucket))
            before += n
        spots = {k for p in probs.values() for k in (math.floor((s["n"] - 1) * p), math.ceil((s["n"] - 1) * p))}
        wanted[s["column"]] = {k: next((b, k - first) for end, first, b in ends if k < end) for k in spots}
    needed = reduce(
        lambda a, b: a | b, [(F.col("column") == c) & F.col("bucket").isin(*{b for b, _ in w.values()}) for c, w in wanted.items()]
    )
    ranks = value_ranks(long.where(needed), ["column", "bucket"], "value", {"upto": F.lit(1)})
    spots = [(c, b, at, k) for c, w in wanted.items() for k, (b, at) in w.items()]
    table = df.sparkSession.createDataFrame(spots, "column string, bucket int, at long, place long")
    inside = (F.col("at") < F.col("upto")) & (F.col("at") >= F.col("upto") - F.col("_upto"))
    values = {(r["column"], r["place"]): r["value"] for r in ranks.join(F.broadcast(table), ["column", "bucket"]).where(inside).collect()}
    for s in held:
        for name, p in probs.items():
            spot = (s["n"] - 1) * p
            low, high = values[s["column"], math.floor(spot)], values[s["column"], math.ceil(spot)]
            found[s["column"]][name] = low + (high - low) * (spot - math.floor(spot))
    return found


def quantile_table(df: DataFrame, cols: list[str], probs: dict[str, float], stats: list[dict] | None = None) -> DataFrame:
    found = narrowed_quantiles(df, cols, probs, stats)
    schema = ", ".join(["column string", *[f"{n} double" for n in probs]])
    return df.sparkSession.createDataFrame([(c, *[found[c][n] for n in probs]) for c in cols], schema)


def quartile_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact quartiles of several columns."""
    return quantile_table(df, cols, QUARTILES)


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample std, min, quartiles and max, one row per column; one plain scan, then narrowed quartiles."""
    stats = plain_statistics(df, cols)
    quarts = narrowed_quantiles(df, cols, QUARTILES, stats)
    rows = [
        (s["column"], s["n"], s["mean"], s["std"], s["min"], s["max"], *[quarts[s["column"]][q] for q in QUARTILES]) for s in stats
    ]
    return df.sparkSession.createDataFrame(
        rows, "column string, n long, mean double, std double, min double, max double, q25 double, q50 double, q75 double"
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Null count of every column, long form, one pass."""
    counted = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in df.columns])
    return counted.select(
        F.explode(
            F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("nulls")) for c in df.columns])
        ).alias("_p")
    ).select("_p.*")


def cardinalities(df: DataFrame, cols: list[str]) -> DataFrame:
    """Exact distinct count per column: distinct pairs first, then a count."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    long = df.select(F.explode(F.array(*pairs)).alias("_p")).select("_p.*")
    return (
        long.where(F.col("value").isNotNull())
        .distinct()
        .groupBy("column")
        .agg(F.count(F.lit(1)).alias("cardinality"))
    )


def approximate_cardinalities(df: DataFrame, cols: list[str], error: float = 0.02) -> DataFrame:
    """Sketch form of :func:`cardinalities` without a shuffle of values."""
    return df.agg(*[F.approx_count_distinct(c, error).alias(c) for c in cols])


def embedding_size(cardinality: Column) -> Column:
    """Width rule: half the cardinality, rounded up, at most 50."""
    return F.least(F.lit(50), F.floor((cardinality + 1) / 2)).cast("long")


def histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width bins over the observed range; empty bins stay with a count of 0."""
    edge = df.agg(F.min(col).cast("double"), F.max(col).cast("double")).first()
    low, high = edge[0], edge[1]
    spark = df.sparkSession
    frame = spark.range(bins).select(F.col("id").alias("bin"))
    if low is None:
        return frame.select("bin", F.lit(None).cast("double").alias("low"), F.lit(0).cast("long").alias("n"))
    width = (high - low) / bins
    if width == 0:
        spot = F.lit(0)
    else:
        spot = F.least(F.floor((F.col(col) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    counted = (
        df.where(F.col(col).isNotNull())
        .groupBy(spot.cast("long").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return frame.join(counted, "bin", "left").select(
        "bin",
        (F.lit(low) + F.col("bin") * F.lit(width)).alias("low"),
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def facet_counts(df: DataFrame, col: str) -> DataFrame:
    """Count per category and the grand total in the row ``all``."""
    return (
        df.rollup(col)
        .agg(F.count(F.lit(1)).alias("n"), F.grouping(col).alias("_g"))
        .select(F.when(F.col("_g") == 1, F.lit("all")).otherwise(F.col(col)).alias(col), "n")
    )


def share_of_total(df: DataFrame, col: str) -> DataFrame:
    """Count and percentage of the total per value."""
    counted = value_counts(df, [col])
    whole = counted.agg(F.sum("n").alias("_all")).scalar()
    return counted.select(col, "n", (F.col("n") * 100.0 / whole).alias("percent"))


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """Class weight n / (classes * n_class)."""
    counted = value_counts(df, [label])
    facts = counted.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    return counted.select(
        label, "n", (facts["rows"] / (facts["classes"] * F.col("n"))).alias("weight")
    )


def date_extent(df: DataFrame, col: str) -> DataFrame:
    return df.agg(
        F.date_format(F.min(col), "yyyy-MM-dd").alias("first_day"),
        F.date_format(F.max(col), "yyyy-MM-dd").alias("last_day"),
        F.datediff(F.max(col), F.min(col)).cast("long").alias("days"),
    )


def corpus_profile(corpus: DataFrame, labels: DataFrame, key: str) -> DataFrame:
    """Row counts of both tables, distinct keys and the keys without a partner."""
    missing = labels.join(corpus.select(key), key, "left_anti")
    parts = [
        corpus.agg(F.lit("corpus_rows").alias("fact"), F.count(F.lit(1)).alias("n")),
        corpus.agg(F.lit("corpus_keys").alias("fact"), F.countDistinct(key).alias("n")),
        labels.agg(F.lit("label_rows").alias("fact"), F.count(F.lit(1)).alias("n")),
        missing.agg(F.lit("labels_without_text").alias("fact"), F.count(F.lit(1)).alias("n")),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def with_statistics(df: DataFrame, cols: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """Mean, std, min and max of each column of ``fit_on`` repeated on every row of ``df``."""
    source = df if fit_on is None else fit_on
    kinds = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    row = source.agg(*[f(c).alias(f"{c}_{k}") for c in cols for k, f in kinds.items()]).first()
    return df.select("*", *[F.lit(v).alias(k) for k, v in row.asDict().items()])


def code_by_first_seen(df: DataFrame, value: str, order: str) -> DataFrame:
    """Zero-based code per value in order of first appearance."""
    first = df.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias("_first"))
    codes = numbered(first, [], ["_first"], "_n")
    return codes.select(value, (F.col("_n") - 1).alias("code"))


def code_by_value(df: DataFrame, value: str) -> DataFrame:
    """Zero-based code per value in sorted order."""
    values = df.select(value).where(F.col(value).isNotNull()).distinct()
    return numbered(values, [], [value], "_n").select(value, (F.col("_n") - 1).alias("code"))


def encode_with(df: DataFrame, codes: DataFrame, value: str, name: str) -> DataFrame:
    return lookup(df, codes.withColumnRenamed("code", name), [value], "left")
