from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulark.operators import sampling


@pytest.fixture(scope="module")
def table(spark):
    return spark.range(500).select("id", F.when(F.col("id") % 10 == 0, 0).otherwise(1).alias("y"), (F.col("id") % 37 / 4).alias("v"))


def test_stratified_holdout_sizes(table, widths):
    got = sampling.stratified_holdout(table, "y", ["id"], "s").groupBy("y").agg(
        F.count_if("is_test").alias("t"), F.count(F.lit(1)).alias("n")
    )
    assert {r["y"]: (r["t"], r["n"]) for r in got.collect()} == {0: (10, 50), 1: (90, 450)}


def test_split_does_not_depend_on_partitions(table, spark):
    first = sampling.stratified_holdout(table, "y", ["id"], "s").where("is_test").select("id")
    again = sampling.stratified_holdout(table.repartition(13), "y", ["id"], "s", digits=4).where("is_test").select("id")
    assert {r[0] for r in first.collect()} == {r[0] for r in again.collect()}


def test_stratified_folds_are_even(table, widths):
    got = sampling.stratified_folds(table, "y", ["id"], "f", 5).groupBy("y", "fold").count().collect()
    assert len(got) == 10
    assert {r["count"] for r in got if r["y"] == 0} == {10}
    assert {r["count"] for r in got if r["y"] == 1} == {90}


def test_folds_cover_all_rows(table):
    folds = table.select("id", sampling.fold_number(["id"], "k", 7).alias("fold"))
    assert folds.where("fold BETWEEN 0 AND 6").count() == 500
    assert folds.select("fold").distinct().count() == 7


def test_upsampling_reaches_the_majority(table):
    up = sampling.upsample_minority(table.select("id", "y"), "y", 0, 1, "id", "d")
    counts = {r["y"]: r["count"] for r in up.groupBy("y").count().collect()}
    assert counts == {0: 450, 1: 450}
    assert up.where("y = 0").select("id").distinct().count() > 40
    assert up.where("y = 0 AND id % 10 <> 0").count() == 0


def test_upsampling_without_a_minority(table):
    up = sampling.upsample_minority(table.where("y = 1").select("id", "y"), "y", 0, 1, "id", "d")
    assert up.count() == 450


def test_quantile_bins_match_numpy(table, widths):
    values = np.array([r["v"] for r in table.select("v").collect()])
    edges = sampling.quantile_edges(table, "v", 10)
    want = np.unique(np.quantile(values, np.linspace(0, 1, 11)))
    assert np.allclose(edges, want[1:-1])
    got = table.select("v", sampling.quantile_bin("v", edges).alias("b")).collect()
    assert all(r["b"] == np.searchsorted(want[1:-1], r["v"], side="right") for r in got)


def test_constant_column_has_one_bin(spark):
    flat = spark.range(5).select(F.lit(2.0).alias("v"))
    assert sampling.quantile_edges(flat, "v", 10) == []
    assert flat.select(sampling.quantile_bin("v", []).alias("b")).distinct().count() == 1


def test_shuffle_is_a_permutation(table):
    got = sampling.shuffled_position(table.select("id"), ["id"], "x").collect()
    assert sorted(r["position"] for r in got) == list(range(1, 501))
    order = [r["id"] for r in sampling.shuffled(table.select("id"), ["id"], "x").collect()]
    assert order == [r["id"] for r in sorted(got, key=lambda r: r["position"])]
    assert order != sorted(order)
