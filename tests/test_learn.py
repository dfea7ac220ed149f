from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulark.operators import learn


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(2)
    x = rng.random((240, 2))
    y = np.where(x[:, 0] > 0.5, 3.0, 1.0) + 0.1 * x[:, 1]
    return spark.createDataFrame(
        [(i, float(a), float(b), float(t), i % 3, int(t > 2)) for i, ((a, b), t) in enumerate(zip(x, y, strict=True))],
        "id int, a double, b double, y double, fold int, label int",
    )


def test_every_row_is_scored_once_and_better_than_the_mean(table):
    models, scored = learn.boosted_folds(table, ["a", "b"], "y", "fold", 3, rounds=4, depth=2)
    assert len(models) == 3
    assert scored.count() == table.count() == scored.select("id").distinct().count()
    spread = table.agg(F.stddev_pop("y")).first()[0]
    error = scored.agg(F.sqrt(F.avg((F.col("y") - F.col("prediction")) ** 2))).first()[0]
    assert error < spread / 2
    mean = learn.mean_of_models(models, table, ["a", "b"], ["id"])
    one = table.where("id = 0")
    each = [m.transform(learn.assembled(one, ["a", "b"])).first()["prediction"] for m in models]
    assert mean.where("id = 0").first()["prediction"] == pytest.approx(np.mean(each))


def test_early_stop_curve_and_importances(spark, table):
    rows = table.withColumn("is_valid", F.col("fold") == 0)
    model = learn.boosted_early_stop(rows, ["a", "b"], "y", "is_valid", rounds=10)
    curve = learn.learning_curve(model, {"train": rows.where("NOT is_valid"), "test": rows.where("is_valid")}, ["a", "b"])
    errors = [r["mse"] for r in curve.where("part = 'train'").orderBy("iteration").collect()]
    assert 1 <= len(errors) <= 10
    weights = {r["feature"]: r["importance"] for r in learn.importances(spark, model, ["a", "b"]).collect()}
    assert sum(weights.values()) == pytest.approx(1.0)
    assert weights["a"] > weights["b"]


def test_classifiers_give_probabilities(table):
    scored = learn.binary_boosted(table, table, ["a", "b"], "label", rounds=3)
    assert scored.where("score < 0 OR score > 1").count() == 0
    assert learn.fold_accuracy(scored.withColumn("label", F.col("label").cast("double")), "label") > 0.95
    vectors = table.select("id", F.array("a", "b").alias("v"), "label")
    forest = learn.forest_probabilities(vectors, vectors, "v", "label", 5)
    sums = forest.select(F.aggregate("probabilities", F.lit(0.0), lambda s, p: s + p).alias("s"))
    assert all(r["s"] == pytest.approx(1.0) for r in sums.collect())


def test_grid_search_lists_every_point(table):
    found = learn.boosted_grid(table, ["a", "b"], "y", "fold", 3, [1, 2], [1, 3])
    assert found.count() == 4
    assert found.where("rmse > 0").count() == 4


def test_clusters(table):
    got = learn.kmeans_clusters(table.select("id", F.array("a", "b").alias("v")), "v", 3, rounds=5)
    assert got.select("cluster").distinct().count() == 3


def test_loaded_pipeline_equals_the_fitted_one(spark, tmp_path):
    rows = spark.createDataFrame([(1, "x", 2.0), (2, "y", 3.0)], "id int, k string, v double")
    fitted = learn.feature_pipeline(["k"], ["v"]).fit(rows)
    loaded = learn.saved_and_loaded(fitted, str(tmp_path / "pipe"))
    unseen = spark.createDataFrame([(3, "z", 1.0)], "id int, k string, v double").unionByName(rows)
    assert fitted.transform(unseen).select("features").collect() == loaded.transform(unseen).select("features").collect()
