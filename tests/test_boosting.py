from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from tabulark.operators import learn


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(4)
    a, b = rng.random(600), rng.random(600)
    kinds = rng.integers(0, 6, 600)
    y = 4 * (a > 0.5) + np.array([0, 5, 1, 9, 2, 7])[kinds] + 0.4 * rng.standard_normal(600)
    rows = [(i, float(p), float(q), f"k{k}", float(t), i % 3) for i, (p, q, k, t) in enumerate(zip(a, b, kinds, y, strict=True))]
    return spark.createDataFrame(rows, "id int, a double, b double, kind string, y double, fold int").cache()


def error(df, name):
    return df.agg(F.sqrt(F.avg((F.col("y") - F.col(name)) ** 2))).first()[0]


def test_stops_after_its_patience_and_goes_back_to_the_best_round(table):
    ready = learn.with_categories(table, ["a", "b"], ["kind"])
    train, valid = ready.where("fold > 0"), ready.where("fold = 0")
    model = learn.boosted_with_patience(train, valid, "y", rounds=60, patience=6, block=5, depth=5, step=0.5)
    tried = [e for _, _, e in model.curve]
    assert [n for n, _, _ in model.curve] == list(range(1, len(tried) + 1)) and len(tried) < 60
    assert model.best == 1 + int(np.argmin(tried)) and len(tried) - model.best >= 6
    # The cut model has the error of its best round, whichever block that lies in.
    assert error(model.scored(valid, "p"), "p") ** 2 == pytest.approx(min(tried))
    assert error(model.scored(train, "p"), "p") ** 2 == pytest.approx(model.curve[model.best - 1][1])


def test_no_validation_rows_take_all_rounds(table):
    ready = learn.with_categories(table, ["a"], ["kind"])
    model = learn.boosted_with_patience(ready, ready.where("false"), "y", rounds=7, patience=2, block=3, depth=2)
    assert model.best == len(model.curve) == 7 and math.isnan(model.curve[0][2])
    assert error(model.scored(ready, "p"), "p") ** 2 == pytest.approx(model.curve[-1][1])


def test_categories_are_split_as_sets(table):
    # The levels' means are out of order, so one split of the index as a number cannot part them.
    ready = learn.with_categories(table, [], ["kind"])
    model = learn.boosted_with_patience(ready, ready.where("false"), "y", rounds=1, depth=1)
    tree = model.blocks[0].trees[0].toDebugString
    assert "in {" in tree


def test_every_row_is_scored_once_by_a_model_of_its_fold(spark, table):
    models, scored = learn.patient_folds(table, ["a", "b"], ["kind"], "y", "fold", 3, rounds=12, patience=3, block=4, depth=4)
    assert scored.count() == 600 == scored.select("id").distinct().count() and set(models) == {0, 1, 2}
    assert error(scored, "prediction") < 0.4 * table.agg(F.stddev_pop("y")).first()[0]
    own = error(scored.where("fold = 1"), "prediction") ** 2
    assert own == pytest.approx(models[1].curve[models[1].best - 1][2])
    curves = learn.fold_curves(spark, models)
    assert curves.count() == 2 * sum(len(m.curve) for m in models.values())
    forest = learn.forest_regression_folds(table, ["a", "b"], ["kind"], "y", "fold", 3, trees=5, depth=5)
    assert forest.count() == 600 and error(forest, "prediction") < 0.5 * table.agg(F.stddev_pop("y")).first()[0]


def test_selection_with_trees_keeps_what_helps(table):
    rows = table.withColumn("noise", F.rand(3)).withColumn("index", F.substring("kind", 2, 1).cast("double"))
    train, valid = rows.where("fold > 0"), rows.where("fold = 0")
    one = learn.selected_with_trees(train, valid, ["a"], ["noise", "index", "b"], "y", rounds=6, parallelism=1)
    assert [c for _, c, _, _ in one] == ["", "noise", "index", "b"] and one[2][3]
    best = one[0][2]
    for _, _, e, kept in one[1:]:
        assert kept == (e < best)
        best = min(best, e)
    # Tried side by side, the trace is the same.
    assert learn.selected_with_trees(train, valid, ["a"], ["noise", "index", "b"], "y", rounds=6, parallelism=3) == one
    assert len(learn.selected_with_trees(train, valid, ["a"], [], "y", rounds=2)) == 1
    with pytest.raises(ValueError, match="twice"):
        learn.selected_with_trees(train, valid, ["a"], ["a"], "y")


def test_searched_classifiers_lose_less_with_deeper_trees(table):
    rows = table.withColumn("label", ((F.col("a") > 0.5) != (F.col("b") > 0.5)).cast("int"))
    points = [{"depth": d, "rounds": 4.0, "step": 0.3, "share": 1.0} for d in (1.0, 4.0)]
    weak, strong = learn.searched_classifiers(rows, ["a", "b"], "label", "fold", 3, points)
    assert strong < 0.15 < weak
    spoiled = rows.withColumn("a", F.when(F.col("id") > 20, F.col("a"))).withColumn("fold", F.when(F.col("id") > 30, F.col("fold")))
    assert 0 <= learn.searched_classifiers(spoiled, ["a", "b"], "label", "fold", 3, points[:1])[0] <= 1
    assert math.isnan(learn.searched_classifiers(rows.limit(0), ["a", "b"], "label", "fold", 3, points[:1])[0])


def test_fold_models_on_cells_are_those_of_the_rows(spark):
    """Features of few and of many values, rows that repeat, a fold that no model holds out."""
    rng = np.random.default_rng(8)
    n = 900
    a, b = rng.integers(0, 9, n), rng.random(n)
    y = 3.0 * (a > 4) + 2.0 * (b > 0.3) * (a > 2) + 0.3 * rng.standard_normal(n)
    rows = [(i, float(p), float(q), float(t), i % 4) for i, (p, q, t) in enumerate(zip(a, b, y, strict=True))]
    df = spark.createDataFrame([*rows, *rows[:300]], "id int, a double, b double, y double, fold int")
    models, scored = learn.boosted_folds(df, ["a", "b"], "y", "fold", 3, rounds=6, depth=3)
    mine = {r["id"]: r["prediction"] for r in scored.collect()}
    assert scored.count() == df.where("fold < 3").count() and scored.columns == [*df.columns, "prediction"]
    for i, model in enumerate(models):
        ready = learn.assembled(df, ["a", "b"])
        plain = GBTRegressor(labelCol="y", maxIter=6, maxDepth=3, seed=42).fit(ready.where(f"fold <> {i}"))
        want = {r["id"]: r["prediction"] for r in plain.transform(ready.where(f"fold = {i}")).collect()}
        assert model.model.getNumTrees == 6 and all(mine[k] == pytest.approx(v, abs=1e-9) for k, v in want.items())


def test_a_fit_goes_over_cells_and_not_over_rows(spark):
    df = spark.range(20_000).select(
        (F.rand(1) * 100).alias("a"), F.floor(F.rand(2) * 5).alias("b"), F.rand(3).alias("y"), F.pmod("id", F.lit(2)).cast("int").alias("fold")
    )
    cells = learn.cells_of_folds(df, ["a", "b"], "y", "fold", 2, learn.fold_counts(df, "fold", 2), held=True)
    assert set(cells.sizes) == {(i, h) for i in range(2) for h in (True, False)}
    assert max(cells.sizes.values()) <= (learn.TREE_BINS + 1) * 5
    totals = {(r["_model"], r["_held"]): r["n"] for r in cells.rows.groupBy("_model", "_held").agg(F.sum("_n").alias("n")).collect()}
    assert set(totals.values()) == {10_000.0}


def test_grid_on_cells_has_the_errors_of_the_rows(table):
    found = {(r["max_depth"], r["rounds"]): r for r in learn.boosted_grid(table, ["a", "b"], "y", "fold", 3, [1, 3], [2, 5]).collect()}
    ready = learn.assembled(table, ["a", "b"])
    for (depth, rounds), r in found.items():
        errors = []
        for i in range(3):
            model = GBTRegressor(labelCol="y", maxIter=rounds, maxDepth=depth, seed=42).fit(ready.where(f"fold <> {i}"))
            errors.append(error(model.transform(ready.where(f"fold = {i}")), "prediction"))
        assert r["rmse"] == pytest.approx(np.mean(errors)) and r["std"] == pytest.approx(np.std(errors))


def test_spoiled_rows_are_errors(table):
    for spoiled in (table.withColumn("y", F.lit(None).cast("double")), table.withColumn("a", F.when(F.col("id") > 5, F.col("a")))):
        with pytest.raises(Exception, match="null|invalid|numbers"):
            learn.boosted_folds(spoiled, ["a", "b"], "y", "fold", 3, rounds=2)[1].collect()
    with pytest.raises(ValueError, match="from 0 to 1"):
        learn.boosted_grid(table, ["a", "b"], "y", "fold", 2, [1], [1])
