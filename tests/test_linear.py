from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabulark.operators import ensemble, linear, scale, tuning


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(9)
    x = rng.normal(size=(300, 3))
    y = x @ [1.5, 0.0, -2.0] + 4 + rng.normal(scale=0.1, size=300)
    return x, y, np.arange(300) % 3


@pytest.fixture(scope="module")
def table(spark, data):
    x, y, fold = data
    return spark.createDataFrame(
        [(i, *map(float, x[i]), float(y[i]), int(fold[i])) for i in range(300)],
        "id int, a double, b double, c double, y double, fold int",
    )


def solved(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)
    return w, y.mean() - w @ x.mean(0)


def test_out_of_fold_ridge(table, data):
    x, y, fold = data
    by_fold = linear.moments_by_fold(table, ["a", "b", "c"], "y", "fold")
    models = linear.fold_models(by_fold, 2.0)
    got = {r["id"]: r["p"] for r in table.select("id", linear.out_of_fold(models, "fold").alias("p")).collect()}
    assert len(got) == 300
    for f in range(3):
        w, b = solved(x[fold != f], y[fold != f], 2.0)
        for i in np.flatnonzero(fold == f):
            assert np.isclose(got[int(i)], x[i] @ w + b)
    errors = linear.cross_validated_rmse(by_fold, 2.0)
    for f in range(3):
        part = fold == f
        assert np.isclose(errors[f], np.sqrt(np.mean((y[part] - [got[int(i)] for i in np.flatnonzero(part)]) ** 2)))


def test_mean_prediction(table, data):
    x, y, fold = data
    models = linear.fold_models(linear.moments_by_fold(table, ["a", "b", "c"], "y", "fold"))
    got = table.where("id = 0").select(linear.mean_prediction(models).alias("p")).first()["p"]
    each = [solved(x[fold != f], y[fold != f], 1.0) for f in range(3)]
    assert np.isclose(got, np.mean([x[0] @ w + b for w, b in each]))


def test_forward_selection(table, data):
    x, y, fold = data
    by_fold = linear.moments_by_fold(table, ["a", "b", "c"], "y", "fold")
    train = linear.all_moments(by_fold) - by_fold[0]
    trace = linear.forward_selection(train, by_fold[0], ["a"], ["b", "c"])
    kept, best = [0], None
    for step, candidate in [(0, None), (1, 1), (2, 2)]:
        names = kept if candidate is None else [*kept, candidate]
        w, b = solved(x[fold != 0][:, names], y[fold != 0], 1.0)
        error = np.sqrt(np.mean((y[fold == 0] - x[fold == 0][:, names] @ w - b) ** 2))
        assert np.isclose(trace[step][2], error)
        better = best is None or error < best
        assert trace[step][3] == better
        if better:
            best, kept = error, names


def test_fold_scaling(table, data):
    x, _, fold = data
    by_fold = linear.moments_by_fold(table, ["a"], "y", "fold")
    got = {r["id"]: r["a_scaled"] for r in table.select("id", *linear.scaled_out_of_fold(by_fold, "fold", ["a"])).collect()}
    for i in range(0, 300, 29):
        rest = x[fold != fold[i], 0]
        assert np.isclose(got[i], (x[i, 0] - rest.mean()) / rest.std(ddof=1))


def test_equal_column_scales_to_null(spark):
    flat = spark.createDataFrame([(1.0,), (1.0,)], "a double")
    for fitted in (scale.fit_z_score(flat, ["a"]), scale.fit_min_max(flat, ["a"]), scale.fit_robust(flat, ["a"])):
        assert [r["a"] for r in fitted.apply(flat).collect()] == [None, None]


def test_unseen_category_gives_zeros(spark):
    fitted = scale.fit_one_hot(spark.createDataFrame([("x",), ("y",)], "k string"), ["k"])
    row = fitted.apply(spark.createDataFrame([("z",), (None,)], "k string")).collect()
    assert [tuple(r) for r in row] == [(0, 0), (0, 0)]


def test_blends(spark):
    long = spark.createDataFrame([(1, "a", 2.0), (1, "b", 4.0)], "id int, model string, pred double")
    wide = ensemble.wide_predictions(long, ["id"], ["a", "b"])
    assert ensemble.blend(wide, ["id"], {"a": 3.0, "b": 1.0}).first()["pred"] == pytest.approx(2.5)
    assert ensemble.log_blend(wide, ["id"], ["a", "b"]).first()["pred"] == pytest.approx(np.sqrt(15) - 1)
    wide = ensemble.wide_predictions(long, ["id"], ["a", "b"])
    assert ensemble.long_predictions(wide, ["id"], ["a", "b"]).orderBy("model").collect() == long.orderBy("model").collect()


def test_parameter_rows_and_runs(spark, tmp_path):
    rows = tuning.parameter_rows(spark, {"wide": {"depth": [6, 9], "rate": 0.1}})
    assert sorted((r["param"], r["position"], r["value"]) for r in rows.collect()) == [
        ("depth", 0, "6"), ("depth", 1, "9"), ("rate", 0, "0.1"),
    ]
    assert len(tuning.grid_points({"depth": [6, 9], "rate": [0.1, 0.2, 0.3]})) == 6
    for name, score in (("one", 0.4), ("two", 0.2)):
        tuning.append_run(tuning.run_rows(spark, name, {"depth": 3}, {"rmse": score}), str(tmp_path / "log"))
    log = spark.read.parquet(str(tmp_path / "log"))
    assert log.count() == 4
    assert tuning.best_run(log, "rmse", rising=False).first()["run"] == "two"
    assert tuning.best_run(log, "rmse", rising=True).first()["run"] == "one"


def test_sampled_points_are_fixed_and_on_the_grid():
    space = {"rate": (0.025, 0.5, 0.025), "depth": (5, 20, 1)}
    points = tuning.sampled_points(space, 20, "s")
    assert points == tuning.sampled_points(space, 20, "s")
    for p in points:
        for name, (low, high, step) in space.items():
            assert low - step <= p[name] <= high + step
            assert abs(p[name] / step - round(p[name] / step)) < 1e-9


def test_equal_scores_share_the_better_rank(spark):
    summary = spark.createDataFrame([("a", 0.9), ("b", 0.9), ("c", 0.8)], "run string, score double")
    got = {r["run"]: r["rank"] for r in tuning.ranked(summary, "score", rising=False).collect()}
    assert got == {"a": 1, "b": 1, "c": 3}


def test_moments_refuse_unbounded_folds(spark):
    many = spark.range(300).select(F.col("id").alias("fold"), F.lit(1.0).alias("a"), F.lit(2.0).alias("y"))
    with pytest.raises(ValueError, match="more than 200"):
        linear.moments_by_fold(many, ["a"], "y", "fold")
