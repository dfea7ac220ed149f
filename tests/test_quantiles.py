from __future__ import annotations

import math

import numpy as np
import pytest

from tabulark.operators import aggregate as agg

PROBS = {"lo": 0.0, "q10": 0.1, "q25": 0.25, "q50": 0.5, "q90": 0.9, "hi": 1.0}


def columns(n=701):
    rng = np.random.default_rng(8)
    return {
        "even": rng.random(n),
        "skew": np.exp(12 * rng.random(n)),
        "ties": rng.integers(0, 3, n).astype(float),
        "same": np.full(n, 7.25),
        "tiny": 1e9 + rng.random(n) * 1e-5,
    }


@pytest.mark.parametrize("buckets", [4096, 3, 1])
def test_quantiles_against_numpy(spark, monkeypatch, buckets):
    monkeypatch.setattr(agg, "BUCKETS", buckets)
    data = columns()
    df = spark.createDataFrame([tuple(float(x) for x in r) for r in zip(*data.values(), strict=True)], list(data))
    found = agg.narrowed_quantiles(df, list(data), PROBS)
    for name, values in data.items():
        want = np.quantile(values, list(PROBS.values()))
        assert np.allclose([found[name][p] for p in PROBS], want, rtol=1e-12), name


def test_nulls_and_values_that_are_not_finite(spark):
    rows = [(1.0, None, 1.0, float("inf")), (None, None, 2.0, 1.0), (3.0, None, float("nan"), 0.0)]
    df = spark.createDataFrame(rows, "a double, none double, nan double, inf double")
    found = agg.narrowed_quantiles(df, ["a", "none", "nan", "inf"], {"m": 0.5})
    assert found["a"]["m"] == 2.0 and found["none"]["m"] is None and found["nan"]["m"] == 2.0 and found["inf"]["m"] == 1.0
    row = {r["column"]: r for r in agg.describe(df, ["a", "none"]).collect()}
    assert row["none"]["n"] == 0 and row["none"]["q50"] is None and row["a"]["q25"] == 1.5
    assert math.isclose(row["a"]["std"], math.sqrt(2))
    assert agg.narrowed_quantiles(df.limit(0), ["a"], {"m": 0.5}) == {"a": {"m": None}}
