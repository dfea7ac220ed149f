"""Chunked series operators against plain pandas, with one series holding most rows."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabulark.operators import ordering, series


@pytest.fixture(scope="module")
def frame():
    rng = np.random.default_rng(3)
    user = np.where(rng.random(600) < 0.7, 1, rng.integers(2, 9, 600))
    data = pd.DataFrame({"user": user, "at": rng.permutation(600), "v": rng.integers(1, 40, 600) / 4.0})
    lone = pd.DataFrame({"user": [99], "at": [5], "v": [2.0]})
    return pd.concat([data, lone]).sort_values(["user", "at"]).reset_index(drop=True)


@pytest.fixture
def table(spark, frame, widths):
    return spark.createDataFrame(frame).repartition(5)


def by_key(df, *cols):
    return df.select("user", "at", *cols).toPandas().sort_values(["user", "at"]).reset_index(drop=True)


def test_running_sums(table, frame):
    placed = ordering.place(table, ["user"], ["at"])
    got = by_key(ordering.running_sums(placed, ["user"], ["at"], {"s": F.col("v"), "n": F.lit(1)}), "s", "n", "s_total")
    groups = frame.groupby("user")["v"]
    assert np.allclose(got["s"], groups.cumsum())
    assert (got["n"] == groups.cumcount() + 1).all()
    assert np.allclose(got["s_total"], groups.transform("sum"))


def test_neighbours(table, frame):
    placed = ordering.place(table, ["user"], ["at"])
    both = ordering.neighbour(placed, ["user"], ["at"], "v", "p")
    both = ordering.neighbour(both, ["user"], ["at"], "v", "q", ahead=True)
    got = by_key(both, "p", "q")
    groups = frame.groupby("user")["v"]
    assert np.allclose(got["p"], groups.shift(1), equal_nan=True)
    assert np.allclose(got["q"], groups.shift(-1), equal_nan=True)


def test_chunks_split_the_long_series(spark, frame):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = ordering.place(spark.createDataFrame(frame), ["user"], ["at"])
        assert placed.where("user = 1").select(ordering.CHUNK).distinct().count() > 3
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("size", [2, 20, 90])
def test_rolling_frames_cross_chunks(spark, table, frame, size):
    # Without merged partitions sixteen chunks hold about forty rows each, so the longest frame spans several.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        holes = table.withColumn("w", F.when(F.col("at") % 97 != 0, F.col("v")))
        got = by_key(series.rolling_volatility(holes, ["user"], ["at"], "w", size), "volatility")
        again = ordering.place(holes, ["user"], ["at"])
        kept = by_key(series.rolling_volatility(again, ["user"], ["at"], "w", size), "volatility")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    known = frame.assign(w=frame["v"].where(frame["at"] % 97 != 0))
    want = known.groupby("user")["w"].rolling(size).std().reset_index(drop=True) * np.sqrt(255)
    assert len(got) == len(frame) == len(kept)
    assert np.allclose(got["volatility"], want, equal_nan=True)
    assert np.allclose(kept["volatility"], want, equal_nan=True)


def test_one_placement_serves_returns_and_frames(spark, frame, monkeypatch):
    placed = []
    whole = ordering.place
    monkeypatch.setattr(ordering, "place", lambda *a: placed.append(1) or whole(*a))
    monkeypatch.setattr(series, "place", ordering.place)
    moved = series.log_return(spark.createDataFrame(frame), ["user"], ["at"], "v", chunks=True)
    for done in (series.rolling_volatility(moved, ["user"], ["at"], "log_return", 5), series.price_index(moved, ["user"], ["at"], "log_return")):
        assert done.count() == len(frame) and ordering.CHUNK not in done.columns
    assert len(placed) == 1


def test_quantiles_match_numpy(table, frame):
    probs = {"a": 0.0, "b": 0.1, "c": 0.25, "d": 0.5, "e": 0.9, "f": 1.0}
    got = ordering.quantiles(table, ["user"], "v", probs).toPandas().set_index("user")
    for user, part in frame.groupby("user"):
        assert np.allclose(got.loc[user, list(probs)].astype(float), np.quantile(part["v"], list(probs.values())))


def test_hash_ranks_are_dense(table, frame):
    got = ordering.hash_ranks(table, ["user"], ["at"], "s").toPandas()
    for _, part in got.groupby("user"):
        assert sorted(part["_rank"]) == list(range(1, len(part) + 1))
        assert (part["_rank_total"] == len(part)).all()


def walk(values, patience, margin):
    best, best_at, stop = values[0], 1, None
    for step, v in enumerate(values[1:], 2):
        if v < best - margin:
            best, best_at = v, step
        elif step - best_at >= patience:
            stop = step
            break
    return best_at, best, stop


@pytest.mark.parametrize(("patience", "margin"), [(3, 0.0), (8, 0.0), (5, 0.5), (400, 1.0)])
def test_early_stop(table, frame, patience, margin):
    got = series.early_stop(table, ["user"], ["at"], "v", patience, margin).toPandas().set_index("user")
    for user, part in frame.groupby("user"):
        best_at, best, stop = walk(part["v"].tolist(), patience, margin)
        row = got.loc[user]
        assert (row["best_step"], row["best_value"]) == (best_at, best)
        assert (None if pd.isna(row["stop_step"]) else int(row["stop_step"])) == stop


def test_early_stop_literal_vector(spark):
    losses = spark.createDataFrame([("r", i, v) for i, v in enumerate([5.0, 4.0, 4.0, 4.0])], "run string, e int, v double")
    row = series.early_stop(losses, ["run"], ["e"], "v", 2).first()
    assert (row["best_step"], row["best_value"], row["stop_step"]) == (2, 4.0, 4)


def test_barrier_average(table, frame):
    got = series.barrier_average(table, ["user"], ["at"], "v", 4.0, 4.5, 0.05, 1.0).toPandas().set_index("user")
    for user, part in frame.groupby("user"):
        average = part["v"].expanding().mean().to_numpy()
        hit = np.flatnonzero(average <= 4.0)
        final = average[hit[0]] if len(hit) else average[-1]
        assert np.isclose(got.loc[user, "average"], final)
        assert np.isclose(got.loc[user, "payoff"], max(final - 4.5, 0) * np.exp(-0.05))


def test_percent_change_after_zero_is_null(spark):
    rows = spark.createDataFrame([(1, 1, 0.0), (1, 2, 3.0), (1, 3, 6.0)], "u int, t int, p double")
    got = [r["change"] for r in series.percent_change(rows, ["u"], ["t"], "p").orderBy("t").collect()]
    assert got == [None, None, 1.0]
    logs = [r["log_return"] for r in series.log_return(rows, ["u"], ["t"], "p").orderBy("t").collect()]
    assert logs[:2] == [None, None]
    assert np.isclose(logs[2], np.log(2))


def test_differences_of_a_line(spark):
    rows = spark.createDataFrame([("a", x, 2.0 * x) for x in (1, 2, 4, 7)], "s string, x int, y double")
    got = series.differences(rows, ["s"], "x", "y").orderBy("x").collect()
    assert [r["forward"] for r in got] == [2.0, 2.0, 2.0, None]
    assert [r["backward"] for r in got] == [None, 2.0, 2.0, 2.0]
    assert [r["central"] for r in got] == [None, 2.0, 2.0, None]


def test_code_by_first_seen(spark, widths):
    from tabulark.operators.aggregate import code_by_first_seen, code_by_value

    rows = spark.createDataFrame([(3, "b"), (1, "c"), (2, "a"), (4, "c"), (5, None)], "i int, k string")
    assert {r["k"]: r["code"] for r in code_by_first_seen(rows, "k", "i").collect()} == {"c": 0, "a": 1, "b": 2}
    assert {r["k"]: r["code"] for r in code_by_value(rows, "k").collect()} == {"a": 0, "b": 1, "c": 2}


def test_pair_moments_of_many_series(spark):
    import numpy as np

    from tabulark.operators.series import pair_moments

    rng = np.random.default_rng(1)
    values = rng.normal(size=(40, 70))
    rows = [(f"s{j}", i, float(values[i, j])) for i in range(40) for j in range(70) if (i + j) % 5]
    rows += [("s0", 99, None)]
    got = {(r["first"], r["second"]): r for r in pair_moments(spark.createDataFrame(rows, "s string, t int, x double"), "s", "t", "x").collect()}
    assert len(got) == 70 * 70
    for a, b in ((0, 1), (5, 5), (69, 3)):
        days = [i for i in range(40) if (i + a) % 5 and (i + b) % 5]
        x, y = values[days, a], values[days, b]
        found = got[f"s{a}", f"s{b}"]
        assert found["n"] == len(days)
        assert abs(found["correlation"] - np.corrcoef(x, y)[0, 1]) < 1e-9 and abs(found["covariance"] - np.cov(x, y)[0, 1]) < 1e-9


def test_early_stop_takes_logarithmically_many_rounds(spark, monkeypatch):
    written = []
    pinned = series.pin
    monkeypatch.setattr(series, "pin", lambda df: written.append(1) or pinned(df))
    falling = spark.createDataFrame([(1, i, 1000.0 - 2 * i) for i in range(300)] + [(2, 0, 5.0), (2, 1, 4.5)], "user int, at int, v double")
    got = {r["user"]: tuple(r)[1:] for r in series.early_stop(falling, ["user"], ["at"], "v", 3, 1.0).collect()}
    assert got == {1: (300, 402.0, None), 2: (1, 5.0, None)}
    assert len(written) < 30
