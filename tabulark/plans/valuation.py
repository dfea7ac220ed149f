"""Queries on price series, option values and the two stream jobs."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tabulark.operators import pricing, series
from tabulark.plans.registry import query
from tabulark.plans.sqlbits import density, distribution
from tabulark.session import read_table
from tabulark.streaming import jobs

BY, ORDER = ["user_id"], ["ts", "event_id"]
W = "OVER (PARTITION BY user_id ORDER BY ts, event_id)"


def prices(spark, sf):
    return read_table(spark, sf, "events").select("user_id", "ts", "event_id", "value")


@query("W5", f"SELECT event_id, round(value / nullif(lag(value) {W}, 0) - 1, 6) AS change FROM events")
def percent_changes(spark, sf):
    moved = series.percent_change(prices(spark, sf), BY, ORDER, "value")
    return moved.select("event_id", F.round("change", 6).alias("change"))


@query("W6", f"SELECT event_id, round(ln(nullif(value, 0) / nullif(lag(value) {W}, 0)), 8) AS log_return FROM events")
def log_returns(spark, sf):
    moved = series.log_return(prices(spark, sf), BY, ORDER, "value")
    return moved.select("event_id", F.round("log_return", 8).alias("log_return"))


@query(
    "W7",
    f"""WITH c AS (SELECT event_id, user_id, ts, ln(nullif(value, 0) / nullif(lag(value) {W}, 0)) AS r FROM events)
    SELECT event_id, round(CASE WHEN count(r) OVER f = 20 THEN stddev_samp(r) OVER f * sqrt(255.0::DOUBLE) END, 6) AS volatility
    FROM c WINDOW f AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
)
def rolling_volatility(spark, sf):
    moved = series.log_return(prices(spark, sf), BY, ORDER, "value", chunks=True)
    rolled = series.rolling_volatility(moved, BY, ORDER, "log_return", 20)
    return rolled.select("event_id", F.round("volatility", 6).alias("volatility"))


@query(
    "W8",
    f"""WITH c AS (SELECT event_id, user_id, ts, coalesce(ln(nullif(value, 0) / nullif(lag(value) {W}, 0)), 0) / 100 AS r FROM events)
    SELECT event_id, round(exp(sum(r) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)), 8) AS price_index FROM c""",
)
def cumulative_price_index(spark, sf):
    moved = series.log_return(prices(spark, sf), BY, ORDER, "value", chunks=True).withColumn("log_return", F.col("log_return") / 100)
    indexed = series.price_index(moved, BY, ORDER, "log_return")
    return indexed.select("event_id", F.round("price_index", 8).alias("price_index"))


BARRIER = {"barrier": 40.0, "strike": 45.0, "rate": 0.05, "years": 1.0}


@query(
    "W9",
    f"""WITH a AS (SELECT user_id, row_number() {W} AS n, avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS av FROM events),
    b AS (SELECT user_id, min(n) FILTER (av <= 40) AS breach_step, max(n) AS steps FROM a GROUP BY user_id),
    e AS (SELECT b.*, av AS average FROM b JOIN a ON a.user_id = b.user_id AND a.n = coalesce(breach_step, steps))
    SELECT user_id, breach_step, steps, round(average, 6) AS average, round(greatest(average - 45, 0) * exp(-0.05::DOUBLE), 6) AS payoff FROM e""",
)
def barrier_average_payoffs(spark, sf):
    ended = series.barrier_average(prices(spark, sf), BY, ORDER, "value", **BARRIER)
    return ended.select(
        "user_id", "breach_step", "steps", F.round("average", 6).alias("average"), F.round("payoff", 6).alias("payoff")
    )


TAIL_SQL = f"""WITH c AS (SELECT event_id, user_id, ts, value, row_number() {W} AS step,
        count(*) OVER (PARTITION BY user_id) - row_number() {W} < 10 AS is_tail,
        ln(nullif(value, 0) / nullif(lag(value) {W}, 0)) AS r FROM events)"""


@query("W10", TAIL_SQL + " SELECT event_id, step, is_tail FROM c")
def tail_holdout(spark, sf):
    return series.tail_holdout(prices(spark, sf), BY, ORDER, 10).select("event_id", "step", "is_tail")


@query(
    "W11",
    TAIL_SQL
    + """, h AS (SELECT user_id, avg(r) AS slope FROM c WHERE NOT is_tail GROUP BY user_id),
    f AS (SELECT *, first_value(value) OVER w AS price, row_number() OVER w - 1 AS k FROM c WHERE is_tail
        WINDOW w AS (PARTITION BY user_id ORDER BY step))
    SELECT event_id, round(ln(nullif(price, 0)) + slope * k, 6) AS trend FROM f LEFT JOIN h USING (user_id)""",
)
def drift_trend(spark, sf):
    moved = series.log_return(prices(spark, sf), BY, ORDER, "value", chunks=True)
    held = series.tail_holdout(moved, BY, ORDER, 10)
    lined = series.drift_line(held, BY, "value", "log_return")
    return lined.select("event_id", F.round("trend", 6).alias("trend"))


@query(
    "W12",
    """WITH d AS (SELECT event_type, floor(epoch(ts))::BIGINT // 86400 AS day, sum(value) AS total FROM events GROUP BY ALL),
    n AS (SELECT *, lead(total) OVER w AS a, lag(total) OVER w AS b, lead(day) OVER w AS da, lag(day) OVER w AS db
        FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day))
    SELECT event_type, day, round((a - total) / (da - day), 4) AS forward, round((total - b) / (day - db), 4) AS backward,
        round((a - b) / (da - db) + 1e-7::DOUBLE, 4) AS central FROM n""",
)
def daily_differences(spark, sf):
    events = read_table(spark, sf, "events")
    daily = events.groupBy("event_type", F.unix_date(F.to_date("ts")).cast("long").alias("day")).agg(
        F.sum("value").alias("total")
    )
    out = series.differences(daily, ["event_type"], "day", "total")
    return out.select(
        "event_type",
        "day",
        F.round("forward", 4).alias("forward"),
        F.round("backward", 4).alias("backward"),
        F.round(F.col("central") + 1e-7, 4).alias("central"),
    )


@query(
    "W16",
    f"""WITH a AS (SELECT user_id, value, row_number() {W} AS n,
        min(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events),
    g AS (SELECT user_id, n, value, coalesce(lead(n) OVER (PARTITION BY user_id ORDER BY n) - 1, (SELECT max(n) FROM a x WHERE x.user_id = a.user_id)) - n AS wait
        FROM a WHERE before IS NULL OR value < before),
    s AS (SELECT user_id, min(n) FILTER (wait >= 5) AS best_at, max(n) AS last_at FROM g GROUP BY user_id)
    SELECT s.user_id, coalesce(best_at, last_at) AS best_step, g.value AS best_value, best_at + 5 AS stop_step
    FROM s JOIN g ON g.user_id = s.user_id AND g.n = coalesce(best_at, last_at)""",
)
def early_stops(spark, sf):
    return series.early_stop(prices(spark, sf), BY, ORDER, "value", patience=5)


@query(
    "W16",
    f"""WITH RECURSIVE a AS (SELECT user_id, value, row_number() {W} AS n, count(*) OVER (PARTITION BY user_id) AS steps FROM events),
    walk AS (SELECT user_id, n, value AS best, 1 AS best_at, steps FROM a WHERE n = 1
        UNION ALL SELECT a.user_id, a.n, CASE WHEN a.value < w.best - 1.0::DOUBLE THEN a.value ELSE w.best END,
            CASE WHEN a.value < w.best - 1.0::DOUBLE THEN a.n ELSE w.best_at END, a.steps
        FROM walk w JOIN a ON a.user_id = w.user_id AND a.n = w.n + 1 WHERE w.n - w.best_at < 5)
    SELECT user_id, max(best_at) AS best_step, min(best) AS best_value,
        CASE WHEN max(n) - max(best_at) >= 5 THEN max(n) END AS stop_step FROM walk GROUP BY user_id""",
)
def early_stops_with_margin(spark, sf):
    return series.early_stop(prices(spark, sf), BY, ORDER, "value", patience=5, min_delta=1.0)


# Contracts from the part table

RATE, VOL = 0.05, 0.25


def contracts(spark, sf):
    return contract_columns(read_table(spark, sf, "part"))


def contract_columns(part):
    return part.select(
        "p_partkey",
        F.col("p_retailprice").alias("spot"),
        (F.col("p_retailprice") * (0.75 + F.col("p_size") / 100)).alias("strike"),
        (1 + F.col("p_size") / 50).alias("years"),
        F.lit(RATE).alias("rate"),
        F.lit(VOL).alias("vol"),
    )


CONTRACT_SQL = """WITH c AS (SELECT p_partkey, p_retailprice AS s, p_retailprice * (0.75::DOUBLE + p_size / 100.0::DOUBLE) AS k,
        1 + p_size / 50.0::DOUBLE AS t, 0.05::DOUBLE AS r, 0.25::DOUBLE AS v FROM part)"""
D1_SQL = "(ln(s/k) + (r + v*v/2)*t) / (v*sqrt(t))"
D_SQL = CONTRACT_SQL + f", d AS (SELECT *, {D1_SQL} AS d1, {D1_SQL} - v*sqrt(t) AS d2 FROM c)"
CALL_SQL = f"(s*{distribution('d1')} - k*exp(-r*t)*{distribution('d2')})"
PUT_SQL = f"(k*exp(-r*t)*{distribution('-d2')} - s*{distribution('-d1')})"


@query("Q1", D_SQL + f" SELECT p_partkey, round({CALL_SQL}, 6) AS call, round({PUT_SQL}, 6) AS put FROM d")
def option_prices(spark, sf):
    out = pricing.priced(contracts(spark, sf))
    return out.select("p_partkey", F.round("call", 6).alias("call"), F.round("put", 6).alias("put"))


GREEKS_SQL = {
    "delta_call": distribution("d1"),
    "delta_put": f"-{distribution('-d1')}",
    "gamma": f"{density('d1')}/(s*v*sqrt(t))",
    "vega": f"s*sqrt(t)*{density('d1')}",
    "theta_call": f"-s*{density('d1')}*v/(2*sqrt(t)) - r*k*exp(-r*t)*{distribution('d2')}",
    "theta_put": f"-s*{density('d1')}*v/(2*sqrt(t)) + r*k*exp(-r*t)*{distribution('-d2')}",
    "rho_call": f"k*t*exp(-r*t)*{distribution('d2')}",
    "rho_put": f"-k*t*exp(-r*t)*{distribution('-d2')}",
}


@query("Q2", D_SQL + " SELECT p_partkey, " + ", ".join(f"round({e}, 6) AS {n}" for n, e in GREEKS_SQL.items()) + " FROM d")
def option_greeks(spark, sf):
    out = pricing.with_greeks(contracts(spark, sf))
    return out.select("p_partkey", *[F.round(n, 6).alias(n) for n in GREEKS_SQL])


@query(
    "Q3 J6",
    f"""WITH c AS (SELECT p_partkey, g.s::DOUBLE AS s, 100.0::DOUBLE AS k, 1 + p_size / 50.0::DOUBLE AS t, 0.1::DOUBLE AS r, 0.3::DOUBLE AS v
        FROM part, (SELECT unnest(range(60, 140)) AS s) g), d AS (SELECT *, {D1_SQL} AS d1, {D1_SQL} - v*sqrt(t) AS d2 FROM c)
    SELECT p_partkey, s::INTEGER AS spot, round({CALL_SQL}, 6) AS call, round({PUT_SQL}, 6) AS put FROM d""",
)
def spot_price_grid(spark, sf):
    base = read_table(spark, sf, "part").select(
        "p_partkey",
        F.lit(100.0).alias("strike"),
        (1 + F.col("p_size") / 50).alias("years"),
        F.lit(0.1).alias("rate"),
        F.lit(0.3).alias("vol"),
    )
    out = pricing.priced(pricing.spot_grid(base, 60, 139))
    return out.select(
        "p_partkey", F.col("spot").cast("int").alias("spot"), F.round("call", 6).alias("call"), F.round("put", 6).alias("put")
    )


@query(
    "Q4",
    CONTRACT_SQL
    + f""", x AS (SELECT p_partkey, s + b AS s, k, t, r, v, b FROM c, (VALUES (0.0::DOUBLE), (0.01::DOUBLE)) q(b)),
    d AS (SELECT *, {D1_SQL} AS d1, {D1_SQL} - v*sqrt(t) AS d2 FROM x), p AS (SELECT p_partkey, b, {CALL_SQL} AS call, {PUT_SQL} AS put FROM d)
    SELECT p_partkey, round((max(call) FILTER (b > 0) - max(call) FILTER (b = 0)) / 0.01::DOUBLE, 4) AS call_slope,
        round((max(put) FILTER (b > 0) - max(put) FILTER (b = 0)) / 0.01::DOUBLE, 4) AS put_slope FROM p GROUP BY p_partkey""",
)
def bump_sensitivities(spark, sf):
    out = pricing.bump_sensitivity(contracts(spark, sf), 0.01)
    return out.select("p_partkey", F.round("call_slope", 4).alias("call_slope"), F.round("put_slope", 4).alias("put_slope"))


@query(
    "Q5",
    f"""WITH r AS (SELECT user_id, ln(nullif(value, 0) / nullif(lag(value) {W}, 0)) / 10 AS x FROM events)
    SELECT user_id, count(*) AS scenarios, round(exp(-0.05::DOUBLE) * avg(greatest(100 * exp(x) - 100, 0)), 6) AS price FROM r WHERE x IS NOT NULL GROUP BY user_id""",
)
def scenario_prices(spark, sf):
    """Each series' own returns, scaled down, are its scenarios for a contract at 100."""
    moved = series.log_return(prices(spark, sf), BY, ORDER, "value").where("log_return IS NOT NULL")
    payoff = pricing.call_payoff(100 * F.exp(F.col("log_return") / 10), F.lit(100.0))
    return moved.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("scenarios"), F.round(math.exp(-0.05) * F.avg(payoff), 6).alias("price")
    )


DAILY_SQL = """WITH d AS (SELECT event_type, ts::DATE AS day, arg_max(value, (ts, event_id)) AS price FROM events GROUP BY ALL)"""


def daily_last(spark, sf):
    events = read_table(spark, sf, "events")
    return events.groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.max_by("value", F.struct("ts", "event_id")).alias("price")
    )


@query(
    "Q6",
    DAILY_SQL + " SELECT strftime(day, '%Y-%m-%d') AS day, round(greatest(avg(price) - 40, 0), 6) AS payoff FROM d GROUP BY day HAVING count(*) = 5",
)
def basket_payoffs(spark, sf):
    daily = daily_last(spark, sf)
    return (
        daily.groupBy("day")
        .agg(F.avg("price").alias("level"), F.count(F.lit(1)).alias("n"))
        .where("n = 5")
        .select(
            F.date_format("day", "yyyy-MM-dd").alias("day"),
            F.round(pricing.call_payoff(F.col("level"), F.lit(40.0)), 6).alias("payoff"),
        )
    )


RETURN_SQL = DAILY_SQL + ", r AS (SELECT event_type, day, ln(nullif(price, 0) / nullif(lag(price) OVER (PARTITION BY event_type ORDER BY day), 0)) AS x FROM d)"


@query(
    "Q7",
    RETURN_SQL
    + """ SELECT a.event_type AS first, b.event_type AS second, round(corr(a.x, b.x), 6) AS correlation, count(*) AS days
    FROM r a JOIN r b ON a.day = b.day WHERE a.x IS NOT NULL AND b.x IS NOT NULL GROUP BY a.event_type, b.event_type""",
)
def return_correlations(spark, sf):
    moved = series.log_return(daily_last(spark, sf), ["event_type"], ["day"], "price").where("log_return IS NOT NULL")
    pairs = series.pair_moments(moved, "event_type", "day", "log_return")
    return pairs.select("first", "second", F.round("correlation", 6).alias("correlation"), F.col("n").alias("days"))


@query("Q7", RETURN_SQL + " SELECT event_type, round(stddev_samp(x), 6) AS volatility FROM r GROUP BY event_type")
def return_volatilities(spark, sf):
    moved = series.log_return(daily_last(spark, sf), ["event_type"], ["day"], "price")
    return moved.groupBy("event_type").agg(F.round(F.stddev_samp("log_return"), 6).alias("volatility"))


@query(
    "Q8",
    D_SQL
    + f""", q AS (SELECT p_partkey, t, {CALL_SQL} AS call, {PUT_SQL} AS put FROM d WHERE t < 1.5)
    SELECT p_partkey, 'call' AS side, round(call*0.98::DOUBLE, 6) AS bid, round(call*1.02::DOUBLE, 6) AS ask, round((call*0.98::DOUBLE + call*1.02::DOUBLE)/2, 6) AS mid FROM q
    UNION ALL SELECT p_partkey, 'put', round(put*0.98::DOUBLE, 6), round(put*1.02::DOUBLE, 6), round((put*0.98::DOUBLE + put*1.02::DOUBLE)/2, 6) FROM q""",
)
def option_chain_mid(spark, sf):
    priced = pricing.priced(contracts(spark, sf).where("years < 1.5"))
    quotes = priced.select(
        "p_partkey",
        *[
            (F.col(side) * factor).alias(f"{side}_{name}")
            for side in ("call", "put")
            for name, factor in (("bid", 0.98), ("ask", 1.02))
        ],
    )
    chain = pricing.option_chain(quotes)
    return chain.select("p_partkey", "side", *[F.round(c, 6).alias(c) for c in ("bid", "ask", "mid")])


@query("Q9", D_SQL + f" SELECT p_partkey, round({CALL_SQL}, 4) AS call, round({PUT_SQL}, 4) AS put FROM d")
def rounded_quotes(spark, sf):
    return pricing.priced(contracts(spark, sf), digits=4).select("p_partkey", "call", "put")


# Streams: drained over all files, so they equal the batch


@query("L1", D_SQL + f" SELECT p_partkey, round({CALL_SQL}, 4) AS call, round({PUT_SQL}, 4) AS put FROM d")
def streamed_quotes(spark, sf):
    arriving = jobs.file_stream(spark, sf, "part")
    out = jobs.priced_stream(arriving, lambda df: pricing.priced(contract_columns(df), digits=4))
    return jobs.drained(out.select("p_partkey", "call", "put"), "quotes")


WINDOW_SQL = """SELECT strftime(w, '%Y-%m-%d %H:%M') AS window_start, count(*) AS n, round(avg(value), 6) AS mean_value,
    round(stddev_samp(value), 6) AS std_value FROM {source} GROUP BY w"""


def _shown(stats):
    return stats.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm").alias("window_start"),
        "n",
        F.round("mean_value", 6).alias("mean_value"),
        F.round("std_value", 6).alias("std_value"),
    )


@query("L2", WINDOW_SQL.format(source="(SELECT value, date_trunc('day', ts) AS w FROM events)"))
def tumbling_statistics(spark, sf):
    return _shown(jobs.window_statistics(read_table(spark, sf, "events"), "ts", "value", "1 day"))


@query(
    "L2",
    WINDOW_SQL.format(
        source="""(SELECT value, to_timestamp((floor(epoch(ts))::BIGINT // 21600) * 21600 - k * 21600)::TIMESTAMP AS w
            FROM events, (SELECT unnest(range(4)) AS k))"""
    ),
)
def sliding_statistics(spark, sf):
    return _shown(jobs.window_statistics(read_table(spark, sf, "events"), "ts", "value", "1 day", "6 hours"))


@query(
    "L2",
    WINDOW_SQL.format(source="(SELECT value, date_trunc('day', ts) AS w FROM events)")
    + " HAVING w + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)",
)
def streamed_statistics(spark, sf):
    """Append mode emits the windows the watermark has passed."""
    arriving = jobs.file_stream(spark, sf, "events").select("ts", "value")
    stats = jobs.window_statistics(arriving, "ts", "value", "1 day", late="1 hour")
    return _shown(jobs.drained(stats, "windows"))
