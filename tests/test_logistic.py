from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulark.operators import learn, logistic, metrics


def data(n=400, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = (rng.random(n) < 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 1] + 0.3)))).astype(int)
    return x, y


@pytest.fixture(scope="module")
def table(spark):
    x, y = data()
    rows = [(i, float(a), float(b), int(t), i % 4) for i, ((a, b), t) in enumerate(zip(x, y, strict=True))]
    return spark.createDataFrame([*rows, (999, None, 1.0, 1, 0), (998, 1.0, 1.0, 1, None)], "id int, a double, b double, y int, fold int")


def newton(x, y, alpha, steps):
    full = np.column_stack([np.ones(len(x)), x])
    beta, penalty = np.zeros(3), alpha * np.diag([0, 1, 1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-full @ beta))
        w = p * (1 - p)
        beta = beta + np.linalg.solve(full.T @ (full * w[:, None]) + penalty, full.T @ (y - p) - penalty @ beta)
    return beta


def test_weights_against_newton_steps(table):
    x, y = data()
    models = logistic.fit_logistic(table, ["a", "b"], "y", "fold", 4, steps=6, alpha=0.5)
    fold = np.arange(400) % 4
    for i, m in models.items():
        seen = np.ones(400, bool) if i == logistic.WHOLE else fold != i
        assert np.allclose([m.intercept, *m.weights], newton(x[seen], y[seen], 0.5, 6), atol=1e-8)


def test_each_row_is_scored_by_the_model_that_did_not_see_it(table):
    models = logistic.fit_logistic(table, ["a", "b"], "y", "fold", 4)
    scored = table.where("id < 400").withColumn("p", logistic.held_out_probability(models, "fold")).where("id = 7").first()
    m = models[3]
    eta = m.intercept + m.weights[0] * scored["a"] + m.weights[1] * scored["b"]
    assert math.isclose(scored["p"], 1 / (1 + math.exp(-eta)))
    area = metrics.roc_auc(table.where("id < 400").withColumn("p", logistic.held_out_probability(models, "fold")), "y", "p").first()[0]
    assert area > 0.8


def test_separable_rows_and_empty_table(spark):
    rows = spark.createDataFrame([(float(i), int(i > 5), i % 2) for i in range(12)], "a double, y int, fold int")
    models = logistic.fit_logistic(rows, ["a"], "y", "fold", 2, steps=30, alpha=0.1)
    assert all(np.isfinite([m.intercept, *m.weights]).all() for m in models.values())
    assert logistic.fit_logistic(rows.limit(0), ["a"], "y", "fold", 2) == {}


def test_six_scores(spark):
    rows = [(0, 1, 0.9), (0, 0, 0.2), (0, 1, 0.4), (0, 0, 0.6), (0, 1, 0.7), (1, 1, 0.3), (1, 0, 0.1)]
    got = {r["fold"]: r.asDict() for r in metrics.six_scores(spark.createDataFrame(rows, "fold int, y int, s double"), "y", "s", ["fold"]).collect()}
    assert got[0]["accuracy"] == pytest.approx(0.6)
    assert got[0]["precision_macro"] == pytest.approx((2 / 3 + 1 / 2) / 2)
    assert got[0]["recall_macro"] == pytest.approx((2 / 3 + 1 / 2) / 2)
    assert got[0]["f1"] == pytest.approx(2 / 3) and got[0]["auc"] == pytest.approx(5 / 6)
    assert got[0]["log_loss"] == pytest.approx(-sum(map(math.log, (0.9, 0.8, 0.4, 0.4, 0.7))) / 5)
    # No row is guessed 1: that precision counts 0.
    assert got[1]["precision_macro"] == 0.25 and got[1]["f1"] == 0 and got[1]["auc"] == 1


def test_one_against_rest_shares(spark, table):
    three = table.where("id < 400 AND fold IS NOT NULL").withColumn("c", (F.col("a") > 0).cast("int") + (F.col("b") > 0).cast("int"))
    models = logistic.one_against_rest(three, ["a", "b"], "c", [0, 1, 2], "fold", 4)
    scores = [logistic.held_out_probability(m, "fold") for m in models.values()]
    rows = three.select("c", logistic.class_shares(scores).alias("p")).collect()
    assert all(math.isclose(sum(r["p"]), 1) for r in rows)
    assert sum(int(np.argmax(r["p"])) == r["c"] for r in rows) > 0.6 * len(rows)


def test_boosted_classes_of_unseen_rows(table):
    rows = table.where("id < 400").withColumn("c", F.when(F.col("a") > 0.3, "x").when(F.col("b") > 0, "y").otherwise("z"))
    models = learn.boosted_class_folds(rows, ["a", "b"], "c", ["x", "y", "z"], "fold", 2, rounds=2, depth=2)
    scored = learn.class_probabilities_out_of_fold(rows.where("fold < 2"), ["a", "b"], "fold", models).collect()
    assert len(scored) == 200 and all(math.isclose(sum(r["probs"]), 1) for r in scored)
    assert sum("xyz"[int(np.argmax(r["probs"]))] == r["c"] for r in scored) > 180
    mean = learn.mean_class_probabilities(rows.where("fold = 3"), ["a", "b"], models)
    assert all(math.isclose(sum(r["probs"]), 1) for r in mean.collect())
