from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulark.operators import classes, metrics
from tabulark.operators.aggregate import balanced_weights, histogram


def test_perfect_and_reversed_scores(spark):
    rows = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.2), (0, 0.1)], "y int, s double")
    assert metrics.roc_auc(rows, "y", "s").first()["auc"] == 1.0
    assert metrics.roc_auc(rows.withColumn("s", -F.col("s")), "y", "s").first()["auc"] == 0.0
    assert metrics.roc_auc(rows.withColumn("s", F.lit(0.5)), "y", "s").first()["auc"] == 0.5


def test_auc_against_all_pairs(spark, widths):
    rng = np.random.default_rng(5)
    y, s = rng.integers(0, 2, 200), rng.integers(0, 30, 200) / 10.0
    rows = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s, strict=True)], "y int, s double")
    wins = [(p > n) + 0.5 * (p == n) for p in s[y == 1] for n in s[y == 0]]
    assert math.isclose(metrics.roc_auc(rows, "y", "s").first()["auc"], float(np.mean(wins)))
    points = metrics.roc_points(rows, "y", "s").orderBy(F.desc("threshold")).collect()
    for r in points:
        assert math.isclose(r["tpr"], float(np.mean(s[y == 1] >= r["threshold"])))
        assert math.isclose(r["fpr"], float(np.mean(s[y == 0] >= r["threshold"])))


def test_one_class_only_gives_null(spark):
    rows = spark.createDataFrame([(1, 0.9), (1, 0.8)], "y int, s double")
    assert metrics.roc_auc(rows, "y", "s").first()["auc"] is None
    report = metrics.binary_report(rows.withColumn("g", F.lit(0)), "y", "g").first()
    assert report["precision"] is None
    assert report["recall"] == 0.0


def test_class_report_with_a_class_never_chosen(spark):
    rows = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), ("c", "b")], "t string, g string")
    got = {r["class"]: r for r in metrics.class_report(rows, "t", "g").collect()}
    assert got["a"]["precision"] == 1.0
    assert got["a"]["recall"] == 0.5
    assert got["c"]["f1"] == 0.0
    assert math.isclose(got["b"]["precision"], 1 / 3)
    assert math.isclose(got["macro avg"]["recall"], 0.5)
    assert math.isclose(got["weighted avg"]["recall"], 0.5)
    cells = {(r["truth"], r["guess"]): r["n"] for r in metrics.confusion(rows, "t", "g").collect()}
    assert len(cells) == 9
    assert cells["c", "b"] == 1
    assert cells["b", "a"] == 0


def test_cluster_agreement(spark):
    same = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y")], "l int, c string")
    assert metrics.cluster_agreement(same, "l", "c").first()["v_measure"] == pytest.approx(1.0)
    mixed = spark.createDataFrame([(1, "x"), (1, "y"), (2, "y"), (2, "y")], "l int, c string")
    row = metrics.cluster_agreement(mixed, "l", "c").first()
    h, c = row["homogeneity"], row["completeness"]
    assert row["v_measure"] == pytest.approx(2 * h * c / (h + c))
    assert 0 < h < 1


@pytest.mark.parametrize(("place", "value"), [(1, 1.0), (2, 0.5), (3, 1 / 3), (4, 0.0)])
def test_reciprocal_hit(spark, place, value):
    got = spark.range(1).select(metrics.reciprocal_hit(F.lit(place), 3).alias("v")).first()["v"]
    assert got == pytest.approx(value)


def test_ties_take_the_earlier_class(spark):
    row = spark.range(1).select(F.array(*[F.lit(p) for p in (0.2, 0.4, 0.4)]).alias("p"))
    top = row.select(classes.ranked_classes(F.col("p"), ["a", "b", "c"], 2).alias("t")).first()["t"]
    assert top == ["b", "c"]
    assert row.select(classes.true_rank(F.col("p"), F.lit(2)).alias("r")).first()["r"] == 2


def test_class_probabilities_match_numpy(spark):
    rng = np.random.default_rng(1)
    centers = {i: rng.normal(size=4).tolist() for i in range(3)}
    x = rng.normal(size=4)
    table = spark.createDataFrame([(x.tolist(),)], "x array<double>")
    got = table.select(classes.class_probabilities(F.col("x"), centers).alias("p")).first()["p"]
    scores = np.exp([-np.linalg.norm(x - np.array(c)) for c in centers.values()])
    assert np.allclose(got, scores / scores.sum())
    matrix = np.array(classes.class_distance_matrix(centers))
    assert matrix.max() == 1.0
    assert np.allclose(np.diag(matrix), 0)
    assert np.allclose(matrix, matrix.T)


def test_histogram_keeps_empty_bins(spark):
    table = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double")
    assert [r["n"] for r in histogram(table, "v", 5).orderBy("bin").collect()] == [2, 0, 0, 0, 1]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r["n"] for r in histogram(flat, "v", 2).orderBy("bin").collect()] == [2, 0]


def test_balanced_weights(spark):
    rows = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    got = {r["y"]: r["weight"] for r in balanced_weights(rows, "y").collect()}
    assert got == {0: pytest.approx(4 / 6), 1: pytest.approx(2.0)}
