"""Parameter tables, sampled search points and run logs."""

from __future__ import annotations

import hashlib
from itertools import product

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RUN_SCHEMA = "run string, kind string, name string, value string"


def parameter_rows(spark: SparkSession, blocks: dict[str, dict]) -> DataFrame:
    """Named configuration blocks as (block, param, position, value) rows; lists give several rows."""
    rows = []
    for block, params in blocks.items():
        for name, value in params.items():
            values = value if isinstance(value, list) else [value]
            rows += [(block, name, i, str(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "block string, param string, position int, value string")


def grid_points(params: dict[str, list]) -> list[dict]:
    """Every combination of the listed values."""
    return [dict(zip(params, pick, strict=True)) for pick in product(*params.values())]


def hash_draw(run: int, name: str, seed: str) -> float:
    """A draw in [0, 1) that depends only on its arguments."""
    text = hashlib.md5(f"{run}-{name}-{seed}".encode()).hexdigest()
    return int(text[:8], 16) / 4294967296.0


def quantised(draw: float, low: float, high: float, step: float) -> float:
    """A uniform draw on [low, high] moved to the nearest multiple of ``step``."""
    return round((low + draw * (high - low)) / step) * step


def sampled_points(space: dict[str, tuple[float, float, float]], runs: int, seed: str) -> list[dict[str, float]]:
    """``runs`` points from quantised ranges (low, high, step)."""
    return [
        {n: quantised(hash_draw(run, n, seed), *bounds) for n, bounds in space.items()}
        for run in range(runs)
    ]


def ranked(summary: DataFrame, score: str, rising: bool) -> DataFrame:
    """Rank per configuration, equal scores sharing the better place. The summary is small."""
    order = F.col(score).asc() if rising else F.col(score).desc()
    return summary.withColumn("rank", F.rank().over(Window.partitionBy(F.lit(0)).orderBy(order)))


def run_rows(spark: SparkSession, run: str, params: dict, metrics: dict[str, float]) -> DataFrame:
    """Log rows of one run, every parameter and every metric."""
    rows = [(run, "param", k, str(v)) for k, v in params.items()]
    rows += [(run, "metric", k, repr(float(v))) for k, v in metrics.items()]
    return spark.createDataFrame(rows, RUN_SCHEMA)


def append_run(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").parquet(path)


def best_run(log: DataFrame, metric: str, rising: bool) -> DataFrame:
    """The run with the best value of ``metric`` and that value."""
    scores = log.where((F.col("kind") == "metric") & (F.col("name") == metric)).select(
        "run", F.col("value").cast("double").alias(metric)
    )
    pick = F.max_by if rising else F.min_by
    return scores.agg(pick("run", metric).alias("run"), (F.max if rising else F.min)(metric).alias(metric))
