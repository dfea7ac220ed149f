"""Seconds per headline query, one JSON line on stdout."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

from tabulark.plans import REGISTRY
from tabulark.session import local_session

HEADLINE = [
    "collapsed_to_minimum",
    "combination_counts",
    "described_columns",
    "mixed_encoding",
    "three_way_products",
    "stratified_bin_folds",
    "prediction_store_wide",
    "ridge_out_of_fold",
    "ridge_grid_search",
    "ridge_stack",
    "model_errors",
    "top_three_classes",
    "composite_loss",
    "roc_points",
    "percent_changes",
    "rolling_volatility",
    "barrier_average_payoffs",
    "early_stops",
    "option_prices",
    "option_greeks",
    "spot_price_grid",
    "tf_idf_weights",
    "naive_bayes_predictions",
    "bag_of_words",
    "entity_counts",
    "sliding_statistics",
    "boosted_out_of_fold",
    "topic_keywords",
    "kmeans_fit",
]


def timed(spark: SparkSession, names: list[str], folder: str, shown: bool = False) -> dict[str, float]:
    seconds = {}
    for name in names:
        begin = time.perf_counter()
        REGISTRY[name].build(spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begin, 3)
        if shown:
            print(name, seconds[name], file=sys.stderr, flush=True)
    return seconds


def run(names: list[str], folder: str, cores: str) -> dict[str, float]:
    spark = local_session(cores, memory=os.environ.get("BENCH_MEMORY", "16g"))
    # A first round on the smallest tables, so the timings are those of a warm JVM.
    small = Path(folder).parent / "sf0.001"
    timed(spark, names, str(small) if small.exists() else folder)
    seconds = timed(spark, names, folder, shown=True)
    spark.stop()
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = list(REGISTRY) if sys.argv[1:] == ["all"] else (sys.argv[1:] or HEADLINE)
    seconds = run(names, folder, cores)
    print(
        json.dumps(
            {
                "metric": "headline queries, total seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
