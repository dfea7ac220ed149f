"""Pieces of the SQL twins."""

from __future__ import annotations

import math

# The four keys alone repeat now and then; the price in cents tells such rows apart.
ROW_ID = (
    "concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber, floor(l_extendedprice * 100 + 0.5::DOUBLE)::BIGINT)"
)


def tidy(expr: str, digits: int) -> str:
    """Rounded after a nudge far below the last digit, so that exact halves round alike everywhere."""
    return f"round({expr} + 1e-{digits + 3}::DOUBLE, {digits})"


def bucket32(key: str, seed: str) -> str:
    return f"('0x' || substr(md5(concat_ws('-', {key}, '{seed}')), 1, 8))::UBIGINT::BIGINT"


def digest(key: str, seed: str) -> str:
    return f"md5(concat_ws('-', {key}, '{seed}'))"


def density(x: str) -> str:
    return f"(exp(-(({x})*({x}))/2.0::DOUBLE)/{math.sqrt(2.0 * math.pi)!r}::DOUBLE)"


#: 1 / (1 * 3 * 5 * ... * (2k + 1)), the coefficients of the power series of the distribution.
ODD_FACTORS = [1.0 / math.prod(range(1, 2 * k + 2, 2)) for k in range(80)]


def distribution(x: str) -> str:
    """Half plus the density times the series of x^(2k+1) / (2k+1)!!; beyond six and a half it is 0 or 1 to 1e-10."""
    factors = "[" + ", ".join(f"{c!r}::DOUBLE" for c in ODD_FACTORS) + "]"
    clamped = f"greatest(least(({x}), 6.5::DOUBLE), -6.5::DOUBLE)"
    terms = f"list_transform({factors}, lambda c, k: c * pow({clamped}, 2*k - 1))"
    return f"(0.5::DOUBLE + {density(clamped)} * list_sum({terms}))"


def ridge_solution(source: str, features: int, keep: list[str], alpha: str, label: str = "") -> str:
    """CTE list that solves the ridge system of every row of ``source``.

    ``source`` holds n, s_i (feature sums), sy, q_i_j (i <= j) and c_i (feature
    times target). The final CTE ``<label>fitted`` holds w_1 .. w_p and w_0.
    """
    cols = ", ".join(keep)
    p = features
    start = [f"q_{i}_{j} - s_{i}*s_{j}/n{f' + {alpha}' if i == j else ''} AS g_{i}_{j}" for i in range(1, p + 1) for j in range(i, p + 1)]
    start += [f"c_{i} - s_{i}*sy/n AS b_{i}" for i in range(1, p + 1)]
    means = ", ".join([*[f"s_{i}/n AS x_{i}" for i in range(1, p + 1)], "sy/n AS y_0"])
    carried = ", ".join([*[f"x_{i}" for i in range(1, p + 1)], "y_0"])
    ctes = [f"{label}elim_0 AS (SELECT {cols}, {means}, {', '.join(start)} FROM {source})"]
    for k in range(1, p + 1):
        parts = []
        for i in range(1, p + 1):
            for j in range(i, p + 1):
                if i <= k:
                    parts.append(f"g_{i}_{j}")
                else:
                    parts.append(f"g_{i}_{j} - g_{k}_{i}*g_{k}_{j}/g_{k}_{k} AS g_{i}_{j}")
            parts.append(f"b_{i}" if i <= k else f"b_{i} - g_{k}_{i}*b_{k}/g_{k}_{k} AS b_{i}")
        ctes.append(f"{label}elim_{k} AS (SELECT {cols}, {carried}, {', '.join(parts)} FROM {label}elim_{k - 1})")
    previous = f"{label}elim_{p}"
    for i in range(p, 0, -1):
        rest = "".join(f" - g_{i}_{j}*w_{j}" for j in range(i + 1, p + 1))
        ctes.append(f"{label}back_{i} AS (SELECT *, (b_{i}{rest})/g_{i}_{i} AS w_{i} FROM {previous})")
        previous = f"{label}back_{i}"
    intercept = "y_0" + "".join(f" - w_{i}*x_{i}" for i in range(1, p + 1))
    weights = ", ".join(f"w_{i}" for i in range(1, p + 1))
    ctes.append(f"{label}fitted AS (SELECT {cols}, {weights}, {intercept} AS w_0 FROM {label}back_1)")
    return ",\n".join(ctes)


def moment_sums(features: list[str], target: str) -> str:
    """Aggregates in the form :func:`ridge_solution` reads, plus ``qy`` for the squared target."""
    parts = ["count(*)::DOUBLE AS n"]
    parts += [f"sum({f}) AS s_{i}" for i, f in enumerate(features, 1)]
    parts.append(f"sum({target}) AS sy")
    for i, a in enumerate(features, 1):
        parts += [f"sum({a}*{b}) AS q_{i}_{j}" for j, b in enumerate(features, 1) if j >= i]
    parts += [f"sum({f}*{target}) AS c_{i}" for i, f in enumerate(features, 1)]
    parts.append(f"sum({target}*{target}) AS qy")
    return ", ".join(parts)


def moment_names(features: int) -> list[str]:
    names = ["n", *[f"s_{i}" for i in range(1, features + 1)], "sy"]
    names += [f"q_{i}_{j}" for i in range(1, features + 1) for j in range(i, features + 1)]
    return [*names, *[f"c_{i}" for i in range(1, features + 1)], "qy"]


def others(source: str, whole: str, features: int, key: str) -> str:
    """Moments of every other fold: the total minus the fold's own."""
    diffs = ", ".join(f"t.{m} - f.{m} AS {m}" for m in moment_names(features))
    return f"SELECT f.{key}, {diffs} FROM {source} f, {whole} t"


def total_of(source: str, features: int) -> str:
    return "SELECT " + ", ".join(f"sum({m}) AS {m}" for m in moment_names(features)) + f" FROM {source}"


def logistic_solution(source: str, features: list[str], label: str, fold: str, folds: int, steps: int, alpha: str) -> str:
    """CTE list that fits a logistic model per fold on the other folds, and model -1 on all rows, from zero.

    Each step is a weighted least-squares problem, solved as a ridge system.
    The final CTE ``logistic`` holds model, w_1 .. w_p and w_0.
    """
    p = len(features)
    score = " + ".join(f"w_{i}*{f}" for i, f in enumerate(features, 1)) + " + w_0"
    zeros = ", ".join(f"0.0::DOUBLE AS w_{i}" for i in range(p + 1))
    ctes = [f"step_0 AS (SELECT unnest(range(-1, {folds})) AS model, {zeros})"]
    for k in range(1, steps + 1):
        names = ", ".join(features)
        ctes.append(
            f"""eta_{k} AS (SELECT model, {names}, {label}::DOUBLE AS y, greatest(least({score}, 30.0::DOUBLE), -30.0::DOUBLE) AS eta
        FROM {source} r JOIN step_{k - 1} m ON r.{fold} <> m.model),
    p_{k} AS (SELECT *, 1 / (1 + exp(-eta)) AS p FROM eta_{k}),
    z_{k} AS (SELECT *, p * (1 - p) AS w, eta + (y - p) / (p * (1 - p)) AS z FROM p_{k})"""
        )
        sums = ["sum(w) AS n", "sum(w*z) AS sy"]
        sums += [f"sum(w*{f}) AS s_{i}" for i, f in enumerate(features, 1)]
        sums += [f"sum(w*{f}*z) AS c_{i}" for i, f in enumerate(features, 1)]
        sums += [f"sum(w*{a}*{b}) AS q_{i}_{j}" for i, a in enumerate(features, 1) for j, b in enumerate(features, 1) if j >= i]
        ctes.append(f"sums_{k} AS MATERIALIZED (SELECT model, {', '.join(sums)} FROM z_{k} GROUP BY model)")
        ctes.append(ridge_solution(f"sums_{k}", p, ["model"], alpha, f"it{k}_"))
        ctes.append(f"step_{k} AS MATERIALIZED (SELECT * FROM it{k}_fitted)")
    return ",\n".join([*ctes, f"logistic AS (SELECT * FROM step_{steps})"])
