"""Queries on fold models, ensembles, searches and run tables."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabulark.functions.numeric import tidy
from tabulark.operators import ensemble, features, learn, linear, metrics, sampling, tuning
from tabulark.operators.scale import LinearScale
from tabulark.plans.preparation import STORE_SQL
from tabulark.plans.registry import query
from tabulark.plans.shared import FEATURES, FOLDS, LINE_SQL, line_items, wide_store
from tabulark.plans.sqlbits import digest as digest_sql
from tabulark.plans.sqlbits import moment_sums, others, ridge_solution, total_of
from tabulark.plans.sqlbits import tidy as tidy_sql
from tabulark.session import fresh_folder, pin, read_table

P = len(FEATURES)
Z = [f"z_{c}" for c in FEATURES]


def scaled_lines(spark, sf):
    """Line items scaled by the training rows, and the training moments per fold.

    One pass over the raw columns gives mean, std and every product; the
    scaled moments follow from them on the driver.
    """
    li = line_items(spark, sf)
    origin = linear.origin_of(line_items(spark, sf, whole=False), [*FEATURES, "target"])
    train = li.withColumn("train_fold", F.when(~F.col("is_test"), F.col("fold")))
    raw = linear.moments_by_fold(train, FEATURES, "target", "train_fold", origin=origin)
    whole = linear.all_moments(raw)
    stats = {c: whole.mean_std(c) for c in FEATURES}
    by_fold = {i: m.scaled(stats).renamed(Z) for i, m in raw.items()}
    fitted = LinearScale({c: m for c, (m, _) in stats.items()}, {c: s for c, (_, s) in stats.items()})
    return li.select("*", *[fitted.column(c).alias(f"z_{c}") for c in FEATURES]), by_fold


SCALED_SQL = (
    LINE_SQL
    + ", stat AS (SELECT "
    + ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in FEATURES)
    + " FROM line WHERE NOT is_test), scaled AS (SELECT row_id, fold, is_test, target, price, "
    + ", ".join(f"({c} - {c}_m) / {c}_s AS z_{c}" for c in FEATURES)
    + " FROM line, stat), "
    + f"own AS (SELECT fold, {moment_sums(Z, 'target')} FROM scaled WHERE NOT is_test GROUP BY fold), "
    + f"whole AS ({total_of('own', P)}), train AS ({others('own', 'whole', P, 'fold')})"
)
FOLD_MODEL_SQL = SCALED_SQL + ", " + ridge_solution("train", P, ["fold"], "1.0::DOUBLE")
SCORE_SQL = " + ".join(f"w_{i}*{c}" for i, c in enumerate(Z, 1)) + " + w_0"


@query(
    "F9 B2",
    FOLD_MODEL_SQL
    + f""" SELECT row_id, s.fold::INTEGER AS fold, round({SCORE_SQL}, 8) AS prediction
    FROM scaled s JOIN fitted f ON s.fold = f.fold WHERE NOT is_test""",
)
def ridge_out_of_fold(spark, sf):
    rows, by_fold = scaled_lines(spark, sf)
    models = linear.fold_models(by_fold)
    return rows.where("NOT is_test").select(
        "row_id", "fold", F.round(linear.out_of_fold(models, "fold"), 8).alias("prediction")
    )


@query(
    "F10 B2",
    FOLD_MODEL_SQL
    + f""" SELECT row_id, round(avg({SCORE_SQL}), 8) AS prediction FROM scaled, fitted WHERE is_test GROUP BY row_id""",
)
def ridge_test_mean(spark, sf):
    rows, by_fold = scaled_lines(spark, sf)
    models = linear.fold_models(by_fold)
    return rows.where("is_test").select("row_id", F.round(linear.mean_prediction(models), 8).alias("prediction"))


@query(
    "F12 B2",
    SCALED_SQL
    + ", "
    + ridge_solution("whole", P, ["n"], "1.0::DOUBLE")
    + f" SELECT row_id, round(exp({SCORE_SQL}) - 1, 4) AS prediction FROM scaled, fitted WHERE is_test",
)
def ridge_final_refit(spark, sf):
    rows, by_fold = scaled_lines(spark, sf)
    model = linear.fit_ridge(linear.all_moments(by_fold))
    return rows.where("is_test").select("row_id", F.round(F.expm1(model.column()), 4).alias("prediction"))


@query(
    "F11",
    LINE_SQL
    + """, own AS (SELECT fold, count(*)::DOUBLE AS n, sum(quantity) AS s, sum(quantity*quantity) AS q FROM line GROUP BY fold),
    t AS (SELECT sum(n) AS n, sum(s) AS s, sum(q) AS q FROM own),
    r AS (SELECT fold, t.n - own.n AS n, t.s - own.s AS s, t.q - own.q AS q FROM own, t),
    st AS (SELECT fold, s / n AS m, sqrt((q - s*s/n) / (n - 1)) AS sd FROM r)
    SELECT row_id, round((quantity - m) / sd, 6) AS quantity_scaled FROM line JOIN st USING (fold)""",
)
def fold_wise_scaling(spark, sf):
    li = line_items(spark, sf)
    by_fold = linear.moments_by_fold(li, ["quantity"], "target", "fold")
    scaled = li.select("row_id", *linear.scaled_out_of_fold(by_fold, "fold", ["quantity"]))
    return scaled.withColumn("quantity_scaled", F.round("quantity_scaled", 6))


FOLD_ERROR_SQL = FOLD_MODEL_SQL + f""", err AS (SELECT s.fold, sqrt(avg((target - ({SCORE_SQL}))*(target - ({SCORE_SQL})))) AS rmse
    FROM scaled s JOIN fitted f ON s.fold = f.fold WHERE NOT is_test GROUP BY s.fold)"""


@query("K14", FOLD_ERROR_SQL + " SELECT fold::INTEGER AS fold, round(rmse, 8) AS rmse FROM err")
def fold_errors(spark, sf):
    rows, by_fold = scaled_lines(spark, sf)
    models = linear.fold_models(by_fold)
    scored = rows.where("NOT is_test").select("fold", "target", linear.out_of_fold(models, "fold").alias("guess"))
    errors = scored.groupBy("fold").agg(metrics.rmse(F.col("target"), F.col("guess")).alias("rmse"))
    return errors.select("fold", F.round("rmse", 8).alias("rmse"))


ALPHAS = [0.1, 1.0, 10.0, 100.0, 1000.0]


def alpha_sql(alphas: list[float], name: str = "alpha") -> str:
    values = ", ".join(f"({i}, {a!r}::DOUBLE)" for i, a in enumerate(alphas))
    grid = f", grid(run, {name}) AS (VALUES {values}), tried AS (SELECT * FROM train, grid)"
    solved = ridge_solution("tried", P, ["fold", "run", name], name)
    return (
        SCALED_SQL
        + grid
        + ", "
        + solved
        + f""", err AS (SELECT f.run, f.{name}, f.fold, sqrt(avg((target - ({SCORE_SQL}))*(target - ({SCORE_SQL})))) AS rmse
        FROM scaled s JOIN fitted f ON s.fold = f.fold WHERE NOT is_test GROUP BY f.run, f.{name}, f.fold)"""
    )


@query("B6", alpha_sql(ALPHAS) + " SELECT alpha, fold::INTEGER AS fold, round(rmse, 8) AS rmse FROM err")
def ridge_grid_search(spark, sf):
    _, by_fold = scaled_lines(spark, sf)
    rows = linear.alpha_grid(by_fold, ALPHAS)
    table = spark.createDataFrame(rows, "alpha double, fold int, rmse double")
    return table.withColumn("rmse", F.round("rmse", 8))


@query(
    "A19 W15",
    alpha_sql(ALPHAS)
    + """, summary AS (SELECT alpha, round(avg(rmse), 8) AS mean_score, round(stddev_pop(rmse), 8) AS std_score,
        round(max(rmse) - min(rmse), 8) AS spread, count(*) AS folds FROM err GROUP BY alpha)
    SELECT *, rank() OVER (ORDER BY mean_score) AS rank FROM summary""",
)
def ranked_configurations(spark, sf):
    _, by_fold = scaled_lines(spark, sf)
    table = spark.createDataFrame(linear.alpha_grid(by_fold, ALPHAS), "alpha double, fold int, rmse double")
    summary = metrics.score_summary(table, ["alpha"], "rmse")
    rounded = summary.select(
        "alpha", *[F.round(c, 8).alias(c) for c in ("mean_score", "std_score", "spread")], "folds"
    )
    return tuning.ranked(rounded, "mean_score", rising=True)


SPACE = {"alpha": (0.5, 200.0, 0.5)}
POINTS = tuning.sampled_points(SPACE, 10, "search")


@query(
    "B7",
    alpha_sql([p["alpha"] for p in POINTS])
    + " SELECT run, alpha, round(avg(rmse), 8) AS loss FROM err GROUP BY run, alpha",
)
def ridge_random_search(spark, sf):
    _, by_fold = scaled_lines(spark, sf)
    rows = [
        (run, p["alpha"], sum(e for _, _, e in linear.alpha_grid(by_fold, [p["alpha"]])) / FOLDS)
        for run, p in enumerate(POINTS)
    ]
    return spark.createDataFrame(rows, "run int, alpha double, loss double").withColumn("loss", F.round("loss", 8))


BLOCKS = {
    "ridge_wide": {"alpha": [0.5, 5.0, 50.0], "seed": 42},
    "ridge_single": {"alpha": 1.0, "seed": 42},
}
LISTED = [(b, i, a) for b, p in BLOCKS.items() for i, a in enumerate(p["alpha"] if isinstance(p["alpha"], list) else [p["alpha"]])]


@query(
    "B14 B6",
    alpha_sql([a for _, _, a in LISTED])
    + ", blocks(run, block, position) AS (VALUES "
    + ", ".join(f"({run}, '{b}', {i})" for run, (b, i, _) in enumerate(LISTED))
    + """) SELECT block, position, alpha, round(avg(rmse), 8) AS rmse FROM err JOIN blocks USING (run)
    GROUP BY block, position, alpha""",
)
def configured_search(spark, sf):
    """Named configuration blocks become parameter rows; each listed alpha is evaluated."""
    rows = tuning.parameter_rows(spark, BLOCKS).where("param = 'alpha'").collect()
    _, by_fold = scaled_lines(spark, sf)
    alphas = sorted({float(r["value"]) for r in rows})
    errors = metrics.score_summary(
        spark.createDataFrame(linear.alpha_grid(by_fold, alphas), "alpha double, fold int, rmse double"), ["alpha"], "rmse"
    )
    listed = spark.createDataFrame(
        [(r["block"], r["position"], float(r["value"])) for r in rows], "block string, position int, alpha double"
    )
    return listed.join(errors, "alpha").select("block", "position", "alpha", F.round("mean_score", 8).alias("rmse"))


def _selection_sql(moments: str, names: list[str], first: int) -> str:
    """Unrolled forward selection: each step solves a masked system on the shared moments.

    The first ``first`` of ``names`` are the starting set.
    """
    count = len(names)
    start, candidates = list(range(1, first + 1)), list(range(first + 1, count + 1))
    base = moments + (
        ", valid AS (SELECT * FROM own WHERE fold = 0), fit_on AS (SELECT * FROM train WHERE fold = 0)"
    )
    ctes = [base]
    masks = {i: "1.0::DOUBLE" if i in start else "0.0::DOUBLE" for i in range(1, count + 1)}

    def step(label: str, state: str) -> str:
        flags = [f"k_{i}" for i in range(1, count + 1)]
        cols = ["n"]
        cols += [f"s_{i}*k_{i} AS s_{i}" for i in range(1, count + 1)]
        cols.append("sy")
        cols += [
            f"q_{i}_{j}*k_{i}*k_{j}{f' + (1 - k_{i})' if i == j else ''} AS q_{i}_{j}"
            for i in range(1, count + 1)
            for j in range(i, count + 1)
        ]
        cols += [f"c_{i}*k_{i} AS c_{i}" for i in range(1, count + 1)]
        masked = f"{label}_masked AS (SELECT {', '.join(flags)}, {', '.join(cols)} FROM fit_on, {state})"
        solved = ridge_solution(f"{label}_masked", count, flags, "1.0::DOUBLE", f"{label}_")
        w = [f"w_{i}" for i in range(1, count + 1)]
        sse = "qy + n*w_0*w_0 - 2*w_0*sy"
        for i in range(1, count + 1):
            sse += f" - 2*{w[i - 1]}*c_{i} + 2*w_0*{w[i - 1]}*s_{i}"
            for j in range(i, count + 1):
                sse += f" + {1 if i == j else 2}*{w[i - 1]}*{w[j - 1]}*q_{i}_{j}"
        return f"{masked}, {solved}, {label}_err AS (SELECT sqrt(({sse})/n) AS rmse FROM valid, {label}_fitted)"

    flags0 = ", ".join(f"{m} AS k_{i}" for i, m in masks.items())
    ctes.append(
        f"state_{first} AS (SELECT {flags0}), {step(f'st{first}', f'state_{first}')}, "
        f"best_{first} AS (SELECT rmse AS best FROM st{first}_err)"
    )
    rows = [f"SELECT 0 AS step, '' AS candidate, round(best, 8) AS rmse, true AS kept FROM best_{first}"]
    for c in candidates:
        tried = ", ".join("1.0::DOUBLE AS k_%d" % i if i == c else f"k_{i}" for i in range(1, count + 1))
        kept = ", ".join(
            f"CASE WHEN rmse < best THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS k_{i}" if i == c else f"k_{i}"
            for i in range(1, count + 1)
        )
        ctes.append(
            f"try_{c} AS (SELECT {tried} FROM state_{c - 1}), {step(f'st{c}', f'try_{c}')}, "
            f"state_{c} AS (SELECT {kept} FROM state_{c - 1}, best_{c - 1}, st{c}_err), "
            f"best_{c} AS (SELECT least(best, rmse) AS best FROM best_{c - 1}, st{c}_err)"
        )
        rows.append(
            f"SELECT {c - first}, '{names[c - 1]}', round(rmse, 8), rmse < best FROM st{c}_err, best_{c - 1}"
        )
    return ", ".join(ctes) + " " + " UNION ALL ".join(rows)


TRACE = "step int, candidate string, rmse double, kept boolean"


@query("E14", _selection_sql(SCALED_SQL, Z, 1))
def forward_selection(spark, sf):
    _, by_fold = scaled_lines(spark, sf)
    train = linear.all_moments(by_fold) - by_fold[0]
    trace = linear.forward_selection(train, by_fold[0], Z[:1], Z[1:])
    return spark.createDataFrame(trace, TRACE).withColumn("rmse", F.round("rmse", 8))


PAIRS = list(combinations_with_replacement(Z, 2))
GENERATED = [*Z, *["_x_".join(p) for p in PAIRS]]
GENERATED_SQL = (
    LINE_SQL
    + SCALED_SQL.removeprefix(LINE_SQL).split(", own AS", 1)[0]
    + f", wide AS (SELECT fold, target, {', '.join(Z)}, "
    + ", ".join(f"{a}*{b} AS {a}_x_{b}" for a, b in PAIRS)
    + " FROM scaled WHERE NOT is_test), "
    + f"own AS (SELECT fold, {moment_sums(GENERATED, 'target')} FROM wide GROUP BY fold), "
    + f"whole AS ({total_of('own', len(GENERATED))}), train AS ({others('own', 'whole', len(GENERATED), 'fold')})"
)


@query("E14 E7", _selection_sql(GENERATED_SQL, GENERATED, P))
def forward_selection_of_products(spark, sf):
    """Every two-way product tried once on top of the plain columns; one pass gives the moments of all subsets."""
    li, _ = scaled_lines(spark, sf)
    rows = li.where("NOT is_test").select("fold", "target", *Z, *features.products(Z, 2))
    by_fold = linear.moments_by_fold(rows, GENERATED, "target", "fold")
    train = linear.all_moments(by_fold) - by_fold[0]
    trace = linear.forward_selection(train, by_fold[0], Z, GENERATED[P:])
    return spark.createDataFrame(trace, TRACE).withColumn("rmse", F.round("rmse", 8))


# Ensembles

MODELS = ["by_line", "by_quantity", "by_discount"]
CENTER = 50_000.0
WEIGHTS = {"by_line": 0.5, "by_quantity": 0.3, "by_discount": 0.2}


@query(
    "B11",
    STORE_SQL + f" SELECT row_id, {tidy_sql('0.5::DOUBLE*by_line + 0.3::DOUBLE*by_quantity + 0.2::DOUBLE*by_discount', 4)} AS pred FROM m",
)
def weighted_blend(spark, sf):
    blended = ensemble.blend(wide_store(line_items(spark, sf)), ["row_id"], WEIGHTS)
    return blended.withColumn("pred", tidy(F.col("pred"), 4))


@query(
    "B12",
    STORE_SQL
    + " SELECT row_id, round(exp((ln(1+by_line) + ln(1+by_quantity) + ln(1+by_discount)) / 3) - 1, 4) AS pred FROM m",
)
def log_space_blend(spark, sf):
    blended = ensemble.log_blend(wide_store(line_items(spark, sf)), ["row_id"], MODELS)
    return blended.withColumn("pred", F.round("pred", 4))


@query(
    "B10 S6",
    STORE_SQL
    + ", near AS (SELECT row_id, y - 50000 AS y, "
    + ", ".join(f"{m} - 50000 AS {m}" for m in MODELS)
    + " FROM m), st AS (SELECT "
    + moment_sums(MODELS, "y")
    + " FROM near), "
    + ridge_solution("st", 3, ["n"], "1.0::DOUBLE")
    + " SELECT row_id, round("
    + " + ".join(f"w_{i}*{m}" for i, m in enumerate(MODELS, 1))
    + " + w_0 + 50000, 2) AS pred FROM near, fitted",
)
def ridge_stack(spark, sf):
    """Ridge on the stored predictions of several models.

    Everything is moved near zero first: the predictions differ little from
    each other, and their squares would drown the differences.
    """
    joined = wide_store(line_items(spark, sf)).withColumn("one", F.lit(0))
    near = pin(joined.withColumns({c: F.col(c) - CENTER for c in [*MODELS, "price"]}))
    model = linear.fit_ridge(linear.moments_by_fold(near, MODELS, "price", "one")[0])
    return near.select("row_id", F.round(model.column() + CENTER, 2).alias("pred"))


@query(
    "K1 J4",
    STORE_SQL
    + ", l AS (UNPIVOT (SELECT row_id, y, by_line, by_quantity, by_discount FROM m) ON by_line, by_quantity, by_discount INTO NAME model VALUE pred)"
    + """ SELECT model, round(sqrt(avg((y-pred)*(y-pred))), 4) AS rmse,
        round(sqrt(avg((ln(1+y)-ln(1+pred))*(ln(1+y)-ln(1+pred)))), 8) AS rmsle, count(*) AS n FROM l GROUP BY model""",
)
def model_errors(spark, sf):
    scored = ensemble.long_predictions(wide_store(line_items(spark, sf)), ["price"], MODELS)
    table = metrics.regression_errors(scored, "price", "pred", ["model"])
    return table.select("model", F.round("rmse", 4).alias("rmse"), F.round("rmsle", 8).alias("rmsle"), "n")


@query(
    "B13",
    STORE_SQL
    + """, r AS (SELECT 'by_line' AS run, round(sqrt(avg((y-by_line)*(y-by_line))), 4) AS rmse FROM m
        UNION ALL SELECT 'by_quantity', round(sqrt(avg((y-by_quantity)*(y-by_quantity))), 4) FROM m
        UNION ALL SELECT 'by_discount', round(sqrt(avg((y-by_discount)*(y-by_discount))), 4) FROM m)
    SELECT run, rmse FROM r ORDER BY rmse LIMIT 1""",
)
def best_logged_run(spark, sf):
    """Every model's error is appended to a run log; the best run is read back from it."""
    scored = ensemble.long_predictions(wide_store(line_items(spark, sf)), ["price"], MODELS)
    errors = metrics.regression_errors(scored, "price", "pred", ["model"]).collect()
    path = fresh_folder(spark, "runs")
    for row in errors:
        logged = tuning.run_rows(spark, row["model"], {"rows": row["n"]}, {"rmse": round(row["rmse"], 4)})
        tuning.append_run(logged, path)
    return tuning.best_run(spark.read.schema(tuning.RUN_SCHEMA).parquet(path), "rmse", rising=False)


# Spark ML models: row and range checks only


TREE_FEATURES = ["quantity", "discount", "tax", "line"]
BOOST_ROUNDS = 20


@query("B1 F9")
def boosted_out_of_fold(spark, sf):
    rows = line_items(spark, sf).where("NOT is_test")
    _, scored = learn.boosted_folds(rows, TREE_FEATURES, "target", "fold", FOLDS, rounds=BOOST_ROUNDS)
    return scored.select("row_id", "fold", F.expm1("prediction").alias("prediction"))


@query("B1 F10")
def boosted_test_mean(spark, sf):
    rows = line_items(spark, sf)
    models, _ = learn.boosted_folds(rows.where("NOT is_test"), TREE_FEATURES, "target", "fold", FOLDS, rounds=BOOST_ROUNDS)
    scored = learn.mean_of_models(models, rows.where("is_test"), TREE_FEATURES, ["row_id"])
    return scored.withColumn("prediction", F.expm1("prediction"))


def _early_stopped(spark, sf):
    rows = line_items(spark, sf).withColumn("is_valid", F.col("fold") == 0)
    return rows, learn.boosted_early_stop(rows.where("NOT is_test"), TREE_FEATURES, "target", "is_valid", rounds=BOOST_ROUNDS)


@query("B5 K15")
def boosted_learning_curve(spark, sf):
    """Error after every round on training and test rows of an early-stopped model."""
    rows, model = _early_stopped(spark, sf)
    parts = {"train": rows.where("NOT is_test AND NOT is_valid"), "test": rows.where("is_test")}
    return learn.learning_curve(model, parts, TREE_FEATURES)


@query("B9")
def boosted_importances(spark, sf):
    _, model = _early_stopped(spark, sf)
    return learn.importances(spark, model, TREE_FEATURES)


@query("B6")
def boosted_grid_search(spark, sf):
    rows = line_items(spark, sf).where("NOT is_test").select(*TREE_FEATURES, "target", "fold")
    found = learn.boosted_grid(rows, TREE_FEATURES, "target", "fold", FOLDS, depths=[2, 4], rounds=[5, 10])
    return tuning.ranked(found, "rmse", rising=True)


# Boosting with patience on a target with signal: the size of a text, from its words and its language


SIZE_NUMBERS, SIZE_CATEGORIES = ["words", "lines", "distinct"], ["lang"]
SIZE_ROUNDS, SIZE_PATIENCE = 120, 20


def sized_documents(spark, sf):
    """Documents with the log of their size, and folds that are even over ten quantile bins of the word count."""
    words = F.split("text", " ", -1)
    docs = read_table(spark, sf, "documents").where("text IS NOT NULL AND n_chars IS NOT NULL").select(
        "doc_id",
        F.size(words).cast("double").alias("words"),
        F.size(F.split("text", "\\n", -1)).cast("double").alias("lines"),
        (F.size(F.array_distinct(words)) / F.size(words)).alias("distinct"),
        F.coalesce("lang", F.lit("und")).alias("lang"),
        F.log1p("n_chars").alias("target"),
    )
    edges = sampling.quantile_edges(docs, "words", 10)
    binned = docs.withColumn("bin", sampling.quantile_bin("words", edges))
    return pin(sampling.stratified_folds(binned, "bin", ["doc_id"], "sizes", FOLDS))


def patient_models(spark, sf):
    rows = sized_documents(spark, sf)
    return learn.patient_folds(
        rows, SIZE_NUMBERS, SIZE_CATEGORIES, "target", "fold", FOLDS, rounds=SIZE_ROUNDS, patience=SIZE_PATIENCE, depth=4
    )


@query("B1 B5 F6 F9")
def patient_out_of_fold(spark, sf):
    """Every document scored by a model that did not see it and stopped at its best round."""
    _, scored = patient_models(spark, sf)
    return scored.select("doc_id", "fold", "target", "prediction")


@query("B5 K15")
def patient_curves(spark, sf):
    models, _ = patient_models(spark, sf)
    return learn.fold_curves(spark, models)


@query("B5")
def patient_rounds(spark, sf):
    """Per fold the best round, the rounds tried, and the validation error of the best."""
    models, _ = patient_models(spark, sf)
    rows = [(i, m.best, len(m.curve), m.curve[m.best - 1][2]) for i, m in models.items()]
    return spark.createDataFrame(rows, "fold int, best_round int, rounds int, mse double")


@query("B1 F6 B11")
def two_family_blend(spark, sf):
    """Boosted trees and a random forest on the same bin folds, and half of each."""
    rows = sized_documents(spark, sf)
    _, boosted = learn.patient_folds(
        rows, SIZE_NUMBERS, SIZE_CATEGORIES, "target", "fold", FOLDS, rounds=SIZE_ROUNDS, patience=SIZE_PATIENCE, depth=4
    )
    forest = learn.forest_regression_folds(rows, SIZE_NUMBERS, SIZE_CATEGORIES, "target", "fold", FOLDS)
    both = boosted.select("doc_id", "fold", "target", F.col("prediction").alias("boosted")).join(
        forest.select("doc_id", F.col("prediction").alias("forest")), "doc_id"
    )
    return both.withColumn("blend", 0.5 * F.col("boosted") + 0.5 * F.col("forest"))


SIZE_PRODUCTS = ["_x_".join(p) for p in combinations_with_replacement(SIZE_NUMBERS, 2)]


@query("E14 B1")
def forward_selection_with_trees(spark, sf):
    """Two-way products of the counts of a text, tried on top of the counts with boosted trees; fold 0 judges."""
    rows = sized_documents(spark, sf).select("fold", "target", *SIZE_NUMBERS, *features.products(SIZE_NUMBERS, 2))
    trace = learn.selected_with_trees(
        rows.where("fold <> 0"), rows.where("fold = 0"), SIZE_NUMBERS, SIZE_PRODUCTS, "target", rounds=BOOST_ROUNDS
    )
    return spark.createDataFrame(trace, TRACE)


SIZE_BIN_SQL = """WITH w AS (SELECT doc_id, len(string_split(text, ' '))::DOUBLE AS words FROM documents WHERE text IS NOT NULL AND n_chars IS NOT NULL),
    q AS (SELECT quantile_cont(words, [0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0]) AS edges FROM w),
    e AS (SELECT DISTINCT unnest(edges) AS edge FROM q),
    inner_edges AS (SELECT edge FROM e WHERE edge > (SELECT min(edge) FROM e) AND edge < (SELECT max(edge) FROM e)),
    b AS (SELECT doc_id, (SELECT count(*) FROM inner_edges WHERE edge <= words) AS bin FROM w),"""


@query(
    "F6",
    SIZE_BIN_SQL + f""" f AS (SELECT doc_id, bin, ((row_number() OVER (PARTITION BY bin ORDER BY {digest_sql('doc_id', 'sizes')}, doc_id) - 1) % {FOLDS})::INTEGER AS fold FROM b)
    SELECT doc_id, bin::INTEGER AS bin, fold FROM f""",
)
def size_bin_folds(spark, sf):
    """The folds of the models above."""
    return sized_documents(spark, sf).select("doc_id", "bin", "fold")


@query(
    "S7 E6",
    """WITH seg AS (SELECT c_mktsegment, row_number() OVER (ORDER BY count(*) DESC, c_mktsegment) - 1 AS slot
        FROM customer GROUP BY c_mktsegment)
    SELECT c_custkey, c_acctbal AS balance, slot FROM customer JOIN seg USING (c_mktsegment)""",
)
def saved_pipeline(spark, sf):
    """Fitted on customers, saved, loaded and applied; the loaded model gives the vectors."""
    customer = read_table(spark, sf, "customer")
    fitted = learn.feature_pipeline(["c_mktsegment"], ["c_acctbal"]).fit(customer)
    loaded = learn.saved_and_loaded(fitted, fresh_folder(spark, "pipeline"))
    parts = loaded.transform(customer).select("c_custkey", vector_to_array("features").alias("f"))
    hot = F.slice("f", 2, F.size("f") - 1)
    return parts.select("c_custkey", F.col("f")[0].alias("balance"), (F.array_position(hot, 1.0) - 1).alias("slot"))
