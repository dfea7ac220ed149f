from __future__ import annotations

import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from tabulark.functions.normal import distribution
from tabulark.operators import pricing

NORMAL = NormalDist()


def exact_call(s, k, t, r, v):
    d1 = (math.log(s / k) + (r + v * v / 2) * t) / (v * math.sqrt(t))
    return s * NORMAL.cdf(d1) - k * math.exp(-r * t) * NORMAL.cdf(d1 - v * math.sqrt(t))


CASES = [(857.29, 860.0, 18 / 365, 0.0014, 0.2076), (100.0, 100.0, 1.0, 0.1, 0.3), (60.0, 100.0, 2.0, 0.05, 0.4)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(CASES, "spot double, strike double, years double, rate double, vol double")


def test_distribution(spark):
    points = [-6.0, -1.5, 0.0, 0.3, 2.0, 6.0]
    rows = spark.createDataFrame([(x,) for x in points], "x double").select("x", distribution(F.col("x")).alias("p"))
    for r in rows.collect():
        assert abs(r["p"] - NORMAL.cdf(r["x"])) < 7.5e-8


def test_prices_and_parity(table):
    for r in pricing.priced(table).collect():
        case = (r["spot"], r["strike"], r["years"], r["rate"], r["vol"])
        assert r["call"] == pytest.approx(exact_call(*case), abs=1e-3)
        assert r["put"] - r["call"] == pytest.approx(r["strike"] * math.exp(-r["rate"] * r["years"]) - r["spot"], abs=1e-3)


def test_put_by_parity_is_the_direct_put(spark):
    from tabulark.operators.pricing import contract

    c = contract()
    rows = [(s, k, t, 0.05, v) for s in (1.0, 60.0, 857.0) for k in (2.0, 100.0, 900.0) for t in (0.02, 1.0, 30.0) for v in (0.05, 0.9)]
    df = spark.createDataFrame(rows, "spot double, strike double, years double, rate double, vol double")
    d1 = c.d1()
    direct = c.discounted_strike() * distribution(-(d1 - c.root())) - c.spot * distribution(-d1)
    worst = pricing.priced(df).select(F.max(F.abs(F.col("put") - direct))).first()[0]
    assert worst < 1e-9


def test_plan_names_the_distribution_argument_once(table):
    plan = pricing.priced(table)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("ln(") == 1 and len(plan) < 20_000


def test_greeks_against_bumps(table):
    for r in pricing.with_greeks(table).collect():
        s, k, t, rate, v = (r[c] for c in ("spot", "strike", "years", "rate", "vol"))
        h = 1e-4

        def slope(lo, hi):
            return (exact_call(*hi) - exact_call(*lo)) / (2 * h)

        assert r["delta_call"] == pytest.approx(slope((s - h, k, t, rate, v), (s + h, k, t, rate, v)), abs=1e-4)
        assert r["vega"] == pytest.approx(slope((s, k, t, rate, v - h), (s, k, t, rate, v + h)), rel=1e-3)
        assert r["rho_call"] == pytest.approx(slope((s, k, t, rate - h, v), (s, k, t, rate + h, v)), rel=1e-3)
        assert r["theta_call"] == pytest.approx(-slope((s, k, t - h, rate, v), (s, k, t + h, rate, v)), rel=1e-3)
        assert r["delta_call"] - r["delta_put"] == pytest.approx(1.0, abs=1e-6)


def test_grid_rises_and_falls(table):
    grid = pricing.priced(pricing.spot_grid(table.where("years = 1"), 60, 139)).orderBy("spot").collect()
    assert len(grid) == 80
    calls, puts = [r["call"] for r in grid], [r["put"] for r in grid]
    assert calls == sorted(calls)
    assert puts == sorted(puts, reverse=True)


def test_chain_mid(spark):
    quotes = spark.createDataFrame([(1, 2.0, 3.0, 4.0, 6.0)], "id int, call_bid double, call_ask double, put_bid double, put_ask double")
    assert {r["side"]: r["mid"] for r in pricing.option_chain(quotes).collect()} == {"call": 2.5, "put": 5.0}
