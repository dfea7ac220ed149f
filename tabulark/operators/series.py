"""Price-series operators on chunked series (see ``ordering``)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabulark.operators.joins import lookup, null_safe_join
from tabulark.operators.ordering import (
    CHUNK,
    neighbour,
    numbered,
    place,
    placed_once,
    running_sums,
    with_run_up,
)
from tabulark.session import pin

TRADING_DAYS = 255


def with_previous(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    return neighbour(place(df, by, order), by, order, value, "previous")


def percent_change(df: DataFrame, by: list[str], order: list[str], price: str) -> DataFrame:
    """``price / previous - 1``; null on the first row of a series and after a price of 0."""
    moved = with_previous(df, by, order, price)
    return moved.withColumn("change", F.try_divide(F.col(price), F.col("previous")) - 1).drop(
        "previous", CHUNK
    )


def log_return(df: DataFrame, by: list[str], order: list[str], price: str, chunks: bool = False) -> DataFrame:
    """Log of ``price / previous``; null on the first row of a series and where a price is not positive.

    With ``chunks`` the rows keep their chunk, and a later operator on the same
    series and order works on them without placing them again.
    """
    moved = with_previous(df, by, order, price)
    usable = (F.col(price) > 0) & (F.col("previous") > 0)
    found = moved.withColumn(
        "log_return", F.when(usable, F.log(F.col(price) / F.col("previous")))
    ).drop("previous")
    return found if chunks else found.drop(CHUNK)


def rolling_volatility(df: DataFrame, by: list[str], order: list[str], change: str, size: int = 20) -> DataFrame:
    """Sample std of the last ``size`` changes times the root of the trading days.

    Null until ``size`` non-null changes lie in the frame. A chunk works on its
    own rows and the ``size - 1`` changes before them.
    """
    if size < 2:
        raise ValueError("a deviation needs two changes")
    rows = with_run_up(placed_once(df, by, order), by, order, change, size - 1)
    frame = Window.partitionBy(*by, CHUNK).orderBy("_own", F.desc("_at"), *order).rowsBetween(1 - size, 0)
    return (
        rows.select(
            "*",
            F.when(
                F.count(change).over(frame) == size,
                F.stddev_samp(change).over(frame) * F.lit(math.sqrt(TRADING_DAYS)),
            ).alias("volatility"),
        )
        .where("_own")
        .drop("_at", "_own", CHUNK)
    )


def price_index(df: DataFrame, by: list[str], order: list[str], log_step: str) -> DataFrame:
    """``exp`` of the running sum of log steps; the first step counts as 0."""
    step = F.coalesce(F.col(log_step), F.lit(0.0))
    summed = running_sums(placed_once(df, by, order), by, order, {"_level": step})
    return summed.withColumn("price_index", F.exp("_level")).drop("_level", "_level_total", CHUNK)


def barrier_average(
    df: DataFrame,
    by: list[str],
    order: list[str],
    price: str,
    barrier: float,
    strike: float,
    rate: float,
    years: float,
) -> DataFrame:
    """Path average that stops at the first step where it is at or below the barrier.

    The payoff uses the average at that step, or at the last step when the
    barrier is never reached.
    """
    summed = running_sums(
        place(df, by, order), by, order, {"_steps": F.lit(1), "_sum": F.col(price)}
    )
    average = F.col("_sum") / F.col("_steps")
    breach = F.when(average <= barrier, F.col("_steps"))
    ended = summed.groupBy(*by).agg(
        F.min(breach).alias("breach_step"),
        F.coalesce(F.min_by(average, breach), F.max_by(average, F.col("_steps"))).alias("average"),
        F.max("_steps").alias("steps"),
    )
    payoff = F.greatest(F.col("average") - F.lit(strike), F.lit(0.0)) * math.exp(-rate * years)
    return ended.withColumn("payoff", payoff)


def tail_holdout(df: DataFrame, by: list[str], order: list[str], tail: int) -> DataFrame:
    """Adds the row number and ``is_tail`` for the last ``tail`` rows of each series."""
    rows = numbered(df, by, order, "step")
    return rows.withColumn("is_tail", F.col("step") > F.col("step_total") - tail).drop(
        "step_total", CHUNK
    )


def drift_line(
    held_out: DataFrame, by: list[str], price: str, log_step: str
) -> DataFrame:
    """Straight line in log price over the tail, with the mean head return as its slope.

    Starts at the log price of the first tail row, where the offset is 0; needs
    ``step`` and ``is_tail``.
    """
    head, tail = ~F.col("is_tail"), F.col("is_tail")
    fitted = held_out.groupBy(*by).agg(
        F.avg(F.when(head, F.col(log_step))).alias("slope"),
        F.min_by(F.log(F.col(price)), F.when(tail, F.col("step"))).alias("_start"),
        F.min(F.when(tail, F.col("step"))).alias("_first"),
    )
    return (
        lookup(held_out.where("is_tail"), fitted, by)
        .withColumn("trend", F.col("_start") + F.col("slope") * (F.col("step") - F.col("_first")))
        .drop("_start", "_first")
    )


def differences(df: DataFrame, by: list[str], at: str, value: str) -> DataFrame:
    """Forward, backward and central difference quotient along ``at`` per series."""
    placed = place(df, by, [at])
    spots = df.columns
    paired = placed.withColumn("_xy", F.struct(F.col(at).cast("double").alias("x"), F.col(value).alias("y")))
    both = neighbour(paired, by, [at], "_xy", "_b")
    both = neighbour(both, by, [at], "_xy", "_a", ahead=True)
    here, before, after = F.col("_xy"), F.col("_b"), F.col("_a")
    return both.select(
        *spots,
        ((after["y"] - here["y"]) / (after["x"] - here["x"])).alias("forward"),
        ((here["y"] - before["y"]) / (here["x"] - before["x"])).alias("backward"),
        ((after["y"] - before["y"]) / (after["x"] - before["x"])).alias("central"),
    )


def _records(df: DataFrame, by: list[str], order: list[str], value: str) -> DataFrame:
    """Rows that beat every earlier row of their series, with step and series length."""
    rows = numbered(df, by, order, "step")
    inside = (
        Window.partitionBy(*by, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    across = Window.partitionBy(*by).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    chunk_best = (
        rows.groupBy(*by, CHUNK)
        .agg(F.min(value).alias("_low"))
        .select(*by, CHUNK, F.min("_low").over(across).alias("_before"))
    )
    local = rows.select("*", F.min(value).over(inside).alias("_inside"))
    earlier = F.least("_inside", "_before")
    return (
        null_safe_join(local, chunk_best, [*by, CHUNK])
        .where(earlier.isNull() | (F.col(value) < earlier))
        .select(*by, "step", F.col("step_total").alias("steps"), F.col(value).alias("_v"))
    )


def _accepted(records: DataFrame, by: list[str], min_delta: float) -> DataFrame:
    """Records that beat the last accepted one by more than ``min_delta``.

    Records fall, so the next one that may follow is found by one merge of two
    orders: the records, and what each of them asks for. Pointer doubling then
    marks what the first record leads to; its rounds grow with the logarithm of
    the accepted records of a series.
    """
    keys = ["_v", "_kind"]
    numbers = [F.col(c) for c in by]
    # Falling values with a record before a demand of the same size: only smaller ones answer it.
    sides = [F.struct((-F.col("_v")).alias("_v"), F.lit(0).alias("_kind")), F.struct((F.lit(min_delta) - F.col("_v")).alias("_v"), F.lit(1).alias("_kind"))]
    merged = records.select(*numbers, "step", "steps", F.col("_v").alias("_value"), F.explode(F.array(*sides)).alias("_s")).select(
        *by, "step", "steps", "_value", "_s._v", "_s._kind"
    )
    order = [*keys, "step"]
    counted = running_sums(place(merged, by, order), by, order, {"_upto": (F.col("_kind") == 0).cast("long")})
    own = counted.where("_kind = 0").select(*by, "step", "steps", F.col("_value").alias("_v"), F.col("_upto").alias("_at"))
    after = counted.where((F.col("_kind") == 1) & (F.col("_upto") < F.col("_upto_total"))).select(
        *by, "step", (F.col("_upto") + 1).alias("_next")
    )
    nodes = pin(null_safe_join(own, after, [*by, "step"], "left"))
    reached = nodes.where("_at = 1").select(*by, "_at")
    jump = nodes.where("_next IS NOT NULL").select(*by, "_at", "_next")
    while not jump.isEmpty():
        further = null_safe_join(reached, jump, [*by, "_at"]).select(*by, F.col("_next").alias("_at"))
        reached = pin(reached.unionByName(further))
        onward = jump.select(*by, F.col("_at").alias("_next"), F.col("_next").alias("_then"))
        jump = pin(null_safe_join(jump, onward, [*by, "_next"]).select(*by, "_at", F.col("_then").alias("_next")))
    return null_safe_join(nodes, reached, [*by, "_at"], "left_semi").select(*by, "step", "steps", "_v")


def early_stop(
    df: DataFrame, by: list[str], order: list[str], value: str, patience: int, min_delta: float = 0.0
) -> DataFrame:
    """Best step and stopping step of each run (``stop_step`` null when it never stops)."""
    good = _records(df, by, order, value)
    if min_delta > 0:
        good = _accepted(good, by, min_delta)
    following = neighbour(place(good, by, ["step"]), by, ["step"], "step", "_next", ahead=True)
    wait = F.coalesce(F.col("_next") - 1, F.col("steps")) - F.col("step")
    stops = F.when(wait >= patience, F.col("step"))
    return following.groupBy(*by).agg(
        F.coalesce(F.min(stops), F.max("step")).alias("best_step"),
        F.coalesce(F.min_by("_v", stops), F.max_by("_v", "step")).alias("best_value"),
        (F.min(stops) + patience).alias("stop_step"),
    )


def pair_moments(df: DataFrame, series: str, at: str, value: str) -> DataFrame:
    """(first, second, correlation, covariance, n) of every two series over the times that both have.

    The values of a time form one block; its outer product is added up per
    pair, map-side first. There is no limit on the number of series, and a
    block is as large as the number of series. A series has one value per time.
    """
    block = F.collect_list(F.struct(F.col(series).alias("s"), F.col(value).cast("double").alias("x")))
    blocks = df.where(F.col(value).isNotNull()).groupBy(at).agg(block.alias("_v"))
    outer = F.flatten(
        F.transform("_v", lambda a: F.transform("_v", lambda b: F.struct(a["s"].alias("first"), b["s"].alias("second"), a["x"].alias("x"), b["x"].alias("y"))))
    )
    return blocks.select(F.explode(outer).alias("_p")).select("_p.*").groupBy("first", "second").agg(
        F.corr("x", "y").alias("correlation"), F.covar_samp("x", "y").alias("covariance"), F.count(F.lit(1)).alias("n")
    )
