"""Closed-form option values, sensitivities and payoffs as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.functions.normal import density, distribution


@dataclass(frozen=True)
class Contract:
    """Columns of one European contract: spot, strike, years, rate and volatility."""

    spot: Column
    strike: Column
    years: Column
    rate: Column
    vol: Column

    def root(self) -> Column:
        return self.vol * F.sqrt(self.years)

    def d1(self) -> Column:
        drift = (self.rate + self.vol * self.vol / 2) * self.years
        return (F.log(self.spot / self.strike) + drift) / self.root()

    def discounted_strike(self) -> Column:
        return self.strike * F.exp(-self.rate * self.years)

    def call(self, up: Column, up2: Column) -> Column:
        """Value from the distribution at d1 and d2."""
        return self.spot * up - self.discounted_strike() * up2

    def put(self, call: Column) -> Column:
        """By parity with the call."""
        return call - self.spot + self.discounted_strike()


def contract(
    spot: str = "spot", strike: str = "strike", years: str = "years", rate: str = "rate", vol: str = "vol"
) -> Contract:
    return Contract(*[F.col(c) for c in (spot, strike, years, rate, vol)])


#: Columns that the steps below add and take away again.
D1, D2, UP1, UP2 = "_d1", "_d2", "_up1", "_up2"


def _with_distributions(df: DataFrame, c: Contract) -> DataFrame:
    """``df`` with d1, d2 and the distribution at both.

    Each is a column before the next one uses it: the distribution names its
    argument some twenty times, which would otherwise be spelled out each time.
    """
    placed = df.withColumn(D1, c.d1()).withColumn(D2, F.col(D1) - c.root())
    return placed.withColumns({UP1: distribution(F.col(D1)), UP2: distribution(F.col(D2))})


def _with_values(df: DataFrame, c: Contract, call: str, put: str) -> DataFrame:
    valued = _with_distributions(df, c).withColumn(call, c.call(F.col(UP1), F.col(UP2)))
    return valued.withColumn(put, c.put(F.col(call))).drop(D1, D2, UP1, UP2)


def priced(df: DataFrame, digits: int | None = None) -> DataFrame:
    """Call and put next to the contract columns, rounded when ``digits`` is given."""
    out = _with_values(df, contract(), "call", "put")
    return out if digits is None else out.withColumns({c: F.round(c, digits) for c in ("call", "put")})


def with_greeks(df: DataFrame) -> DataFrame:
    c, up = contract(), F.col(UP1)
    bump = density(F.col(D1))
    decay = -c.spot * bump * c.vol / (2 * F.sqrt(c.years))
    carry_call = c.discounted_strike() * F.col(UP2)
    carry_put = c.discounted_strike() * (1 - F.col(UP2))
    greeks = {
        "delta_call": up,
        "delta_put": up - 1,
        "gamma": bump / (c.spot * c.root()),
        "vega": c.spot * F.sqrt(c.years) * bump,
        "theta_call": decay - c.rate * carry_call,
        "theta_put": decay + c.rate * carry_put,
        "rho_call": c.years * carry_call,
        "rho_put": -c.years * carry_put,
    }
    return _with_distributions(df, c).select(*df.columns, *[v.alias(k) for k, v in greeks.items()])


def spot_grid(df: DataFrame, low: int, high: int) -> DataFrame:
    """Every contract at each whole spot from ``low`` to ``high``; grid cells are made in place."""
    spots = F.sequence(F.lit(low), F.lit(high)).cast("array<double>")
    return df.withColumn("spot", F.explode(spots))


def bump_sensitivity(df: DataFrame, bump: float) -> DataFrame:
    """(value at spot + bump - value at spot) / bump for call and put."""
    c = contract()
    moved = Contract(c.spot + F.lit(bump), c.strike, c.years, c.rate, c.vol)
    both = _with_values(_with_values(df, c, "_call", "_put"), moved, "_call_up", "_put_up")
    slopes = {f"{side}_slope": (F.col(f"_{side}_up") - F.col(f"_{side}")) / F.lit(bump) for side in ("call", "put")}
    return both.select(*df.columns, *[v.alias(k) for k, v in slopes.items()])


def call_payoff(level: Column, strike: Column) -> Column:
    return F.greatest(level - strike, F.lit(0.0))


def option_chain(quotes: DataFrame) -> DataFrame:
    """Flat call and put rows with the mid of bid and ask."""
    sides = [
        F.struct(F.lit("call").alias("side"), F.col("call_bid").alias("bid"), F.col("call_ask").alias("ask")),
        F.struct(F.lit("put").alias("side"), F.col("put_bid").alias("bid"), F.col("put_ask").alias("ask")),
    ]
    kept = [c for c in quotes.columns if c not in ("call_bid", "call_ask", "put_bid", "put_ask")]
    flat = quotes.select(*kept, F.explode(F.array(*sides)).alias("_q")).select(*kept, "_q.*")
    return flat.withColumn("mid", (F.col("bid") + F.col("ask")) / 2)
