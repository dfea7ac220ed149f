"""Queries on class probabilities, ranking and evaluation measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tabulark.functions.numeric import array_sum
from tabulark.operators import classes as cls
from tabulark.operators import learn, logistic, metrics, sampling, tuning
from tabulark.operators.aggregate import balanced_weights, share_of_total
from tabulark.operators.project import distinct_values
from tabulark.plans.registry import query
from tabulark.plans.shared import CENTER_SQL
from tabulark.plans.sqlbits import bucket32 as bucket32_sql
from tabulark.plans.sqlbits import digest as digest_sql
from tabulark.plans.sqlbits import logistic_solution
from tabulark.session import pin, read_table


def probability_rows(spark, sf):
    """Embeddings with nearest-centroid class probabilities; the centers are a bounded model."""
    emb = read_table(spark, sf, "embeddings")
    centers = cls.centroids(emb, "label", "embedding")
    names = list(centers)
    rows = emb.select(
        "vec_id",
        "label",
        cls.class_position(F.col("label"), names).alias("position"),
        cls.class_probabilities(F.col("embedding"), centers).alias("probs"),
    )
    return rows, centers


RANKED_SQL = CENTER_SQL + (
    ", ranked AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) AS k FROM probs)"
)


@query("K13 B4", CENTER_SQL + " SELECT vec_id, class, round(p, 8) AS p FROM probs")
def class_probability_table(spark, sf):
    rows, centers = probability_rows(spark, sf)
    names = F.array(*[F.lit(c) for c in centers])
    return rows.select("vec_id", F.posexplode("probs").alias("i", "p")).select(
        "vec_id", names[F.col("i")].alias("class"), F.round("p", 8).alias("p")
    )


@query("W1", RANKED_SQL + " SELECT vec_id, k::INTEGER AS place, class FROM ranked WHERE k <= 3")
def top_three_classes(spark, sf):
    rows, centers = probability_rows(spark, sf)
    top = cls.ranked_classes(F.col("probs"), list(centers), 3)
    return rows.select("vec_id", F.posexplode(top).alias("place", "class")).select(
        "vec_id", (F.col("place") + 1).alias("place"), "class"
    )


@query(
    "A14",
    RANKED_SQL + """, t AS (SELECT class, count(*) AS n FROM ranked WHERE k = 1 GROUP BY class)
    SELECT class, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS percent FROM t""",
)
def top_class_shares(spark, sf):
    rows, centers = probability_rows(spark, sf)
    top = rows.select(cls.ranked_classes(F.col("probs"), list(centers), 1)[0].alias("class"))
    return share_of_total(top, "class").withColumn("percent", F.round("percent", 6))


@query(
    "A14",
    RANKED_SQL + """, t AS (SELECT class, count(*) AS n FROM ranked WHERE k <= 3 GROUP BY class)
    SELECT class, n, round(n * 100.0::DOUBLE / sum(n) OVER (), 6) AS percent FROM t""",
)
def mentioned_class_shares(spark, sf):
    rows, centers = probability_rows(spark, sf)
    top = rows.select(F.explode(cls.ranked_classes(F.col("probs"), list(centers), 3)).alias("class"))
    return share_of_total(top, "class").withColumn("percent", F.round("percent", 6))


@query(
    "K6",
    CENTER_SQL + " SELECT round(-avg(ln(greatest(least(p, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE))), 8) AS log_loss FROM probs WHERE class = label",
)
def class_log_loss(spark, sf):
    rows, _ = probability_rows(spark, sf)
    p = F.element_at("probs", F.col("position") + 1)
    return rows.agg(F.round(metrics.log_loss(p), 8).alias("log_loss"))


@query(
    "K9",
    RANKED_SQL + " SELECT round(avg(CASE WHEN k <= 3 THEN 1.0::DOUBLE / k ELSE 0 END), 8) AS map_3, count(*) AS n FROM ranked WHERE class = label",
)
def mean_precision_at_three(spark, sf):
    rows, _ = probability_rows(spark, sf)
    place = cls.true_rank(F.col("probs"), F.col("position"))
    return rows.agg(
        F.round(F.avg(metrics.reciprocal_hit(place, 3)), 8).alias("map_3"), F.count(F.lit(1)).alias("n")
    )


SMOOTH_SQL = CENTER_SQL + """, w AS (SELECT label, (SELECT count(*) FROM embeddings)::DOUBLE
        / ((SELECT count(DISTINCT label) FROM embeddings) * count(*)) AS weight FROM embeddings GROUP BY label),
    per AS (SELECT vec_id, probs.label, max(CASE WHEN class = probs.label THEN ln(p) END) AS lt, avg(ln(p)) AS ml FROM probs GROUP BY vec_id, probs.label),
    ce AS (SELECT avg(0.9::DOUBLE * weight * -lt - 0.1::DOUBLE * ml) AS loss FROM per JOIN w USING (label))"""
DIST_SQL = """, pd AS (SELECT a.class AS ca, b.class AS cb, sqrt(sum((a.m-b.m)*(a.m-b.m))) AS dd FROM centers a JOIN centers b ON a.i = b.i
        GROUP BY a.class, b.class), dn AS (SELECT ca, cb, dd / (SELECT max(dd) FROM pd) AS dd FROM pd),
    ed AS (SELECT vec_id, sum(p * dd) AS expected FROM probs JOIN dn ON ca = label AND cb = class GROUP BY vec_id)"""


def _weighted(rows, label):
    """Class weights joined on; one row per class of a bounded model."""
    weights = balanced_weights(rows, label).select(label, "weight")
    return rows.join(F.broadcast(weights), label)


def _cross_entropy(rows):
    mean_log = array_sum(F.transform("probs", lambda p: F.log(p))) / F.size("probs")
    return metrics.smoothed_cross_entropy(
        F.element_at("probs", F.col("position") + 1), mean_log, F.col("weight")
    )


@query("K11", SMOOTH_SQL + " SELECT round(loss, 8) AS loss FROM ce")
def smoothed_weighted_loss(spark, sf):
    rows, _ = probability_rows(spark, sf)
    weighted = _weighted(rows, "label")
    return weighted.agg(F.round(_cross_entropy(weighted), 8).alias("loss"))


@query("J8", CENTER_SQL + DIST_SQL + " SELECT vec_id, round(expected, 8) AS expected FROM ed")
def expected_class_distance(spark, sf):
    rows, centers = probability_rows(spark, sf)
    matrix = cls.class_distance_matrix(centers)
    return rows.select(
        "vec_id",
        F.round(cls.expected_distance(F.col("probs"), F.col("position"), matrix), 8).alias("expected"),
    )


@query(
    "K12",
    SMOOTH_SQL + DIST_SQL + " SELECT round((SELECT loss FROM ce) + 0.5::DOUBLE * (SELECT avg(expected) FROM ed), 8) AS loss",
)
def composite_loss(spark, sf):
    rows, centers = probability_rows(spark, sf)
    weighted = _weighted(rows, "label")
    penalty = cls.expected_distance(F.col("probs"), F.col("position"), cls.class_distance_matrix(centers))
    return weighted.agg(F.round(_cross_entropy(weighted) + 0.5 * F.avg(penalty), 8).alias("loss"))


@query(
    "T13",
    CENTER_SQL + """, near AS (SELECT vec_id, arg_min(class, (d, class)) AS c FROM probs GROUP BY vec_id)
    SELECT c AS class, i - 1 AS position, round(avg(v), 6) AS mean FROM flat JOIN near USING (vec_id) GROUP BY c, i""",
)
def kmeans_step(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    step = cls.lloyd_step(emb, "embedding", cls.centroids(emb, "label", "embedding"))
    return step.select("class", F.col("position").cast("long").alias("position"), F.round("mean", 6).alias("mean"))


@query("T13")
def kmeans_fit(spark, sf):
    return learn.kmeans_clusters(read_table(spark, sf, "embeddings"), "embedding", 10, rounds=100).select(
        "vec_id", "label", "cluster"
    )


AGREE_SQL = """, near AS (SELECT vec_id, label, arg_min(class, (d, class)) AS c FROM probs GROUP BY vec_id, label),
    cells AS (SELECT label, c, count(*)::DOUBLE AS n FROM near GROUP BY label, c),
    marked AS (SELECT n, sum(n) OVER (PARTITION BY label) AS a, sum(n) OVER (PARTITION BY c) AS b, sum(n) OVER () AS t FROM cells),
    ent AS (SELECT -sum(n/t * ln(n/b)) AS h_lc, -sum(n/t * ln(n/a)) AS h_cl, -sum(n/t * ln(a/t)) AS h_l, -sum(n/t * ln(b/t)) AS h_c FROM marked),
    sc AS (SELECT 1 - h_lc/h_l AS h, 1 - h_cl/h_c AS c FROM ent)"""


@query(
    "K10",
    CENTER_SQL + AGREE_SQL + " SELECT round(h, 8) AS homogeneity, round(c, 8) AS completeness, round(2*h*c/(h+c), 8) AS v_measure FROM sc",
)
def cluster_agreement(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    centers = cls.centroids(emb, "label", "embedding")
    assigned = emb.select("label", cls.nearest_class(F.col("embedding"), centers).alias("cluster"))
    scored = metrics.cluster_agreement(assigned, "label", "cluster")
    return scored.select(*[F.round(c, 8).alias(c) for c in scored.columns])


# Binary scores: text length over the longest labelled text

SCORE_SQL = """WITH j AS (SELECT l.doc_id, l.quality, d.n_chars FROM labels l JOIN documents d USING (doc_id)),
    s AS (SELECT doc_id, quality, n_chars::DOUBLE / (SELECT max(n_chars) FROM j) AS score FROM j)"""


def scored_labels(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    joined = read_table(spark, sf, "labels").select("doc_id", "quality").join(docs, "doc_id")
    longest = joined.agg(F.max("n_chars")).first()[0]
    return joined.select("doc_id", "quality", (F.col("n_chars") / F.lit(float(longest or 1))).alias("score"))


BINARY_SQL = """tp, fp, fn, tn, round((tp+tn)::DOUBLE/(tp+fp+fn+tn), 8) AS accuracy,
    round(CASE WHEN tp+fp > 0 THEN tp::DOUBLE/(tp+fp) END, 8) AS precision, round(CASE WHEN tp+fn > 0 THEN tp::DOUBLE/(tp+fn) END, 8) AS recall,
    round(CASE WHEN 2*tp+fp+fn > 0 THEN 2.0::DOUBLE*tp/(2*tp+fp+fn) END, 8) AS f1"""
COUNT_SQL = """count(*) FILTER (quality = 1 AND guess = 1) AS tp, count(*) FILTER (quality = 0 AND guess = 1) AS fp,
    count(*) FILTER (quality = 1 AND guess = 0) AS fn, count(*) FILTER (quality = 0 AND guess = 0) AS tn"""


def _guessed(spark, sf, cut=0.05):
    return scored_labels(spark, sf).withColumn("guess", (F.col("score") >= cut).cast("int"))


def _rounded_report(df, by=()):
    shown = ["accuracy", "precision", "recall", "f1"]
    return df.select(*by, "tp", "fp", "fn", "tn", *[F.round(c, 8).alias(c) for c in shown])


@query(
    "K2",
    SCORE_SQL + f", g AS (SELECT *, (score >= 0.05::DOUBLE)::INTEGER AS guess FROM s), c AS (SELECT {COUNT_SQL} FROM g) SELECT {BINARY_SQL} FROM c",
)
def binary_scores(spark, sf):
    return _rounded_report(metrics.binary_report(_guessed(spark, sf), "quality", "guess"))


@query(
    "K3",
    SCORE_SQL + f""", g AS (SELECT *, (score >= 0.05::DOUBLE)::INTEGER AS guess FROM s), c AS (SELECT {COUNT_SQL} FROM g)
    SELECT round((tp::DOUBLE/(tp+fp) + tn::DOUBLE/(tn+fn))/2, 8) AS precision_macro, round((tp::DOUBLE/(tp+fn) + tn::DOUBLE/(tn+fp))/2, 8) AS recall_macro FROM c""",
)
def macro_scores(spark, sf):
    rows = metrics.class_scores(_guessed(spark, sf), "quality", "guess")
    return rows.agg(
        F.round(F.avg("precision"), 8).alias("precision_macro"), F.round(F.avg("recall"), 8).alias("recall_macro")
    )


@query(
    "K7",
    SCORE_SQL + """, p AS (SELECT score AS threshold, sum(quality) AS h, count(*) - sum(quality) AS m FROM s GROUP BY score)
    SELECT round(threshold, 8) AS threshold, round(sum(m) OVER w / sum(m) OVER ()::DOUBLE, 8) AS fpr, round(sum(h) OVER w / sum(h) OVER ()::DOUBLE, 8) AS tpr
    FROM p WINDOW w AS (ORDER BY threshold DESC)""",
)
def roc_points(spark, sf):
    points = metrics.roc_points(scored_labels(spark, sf), "quality", "score")
    return points.select(*[F.round(c, 8).alias(c) for c in points.columns])


AUC_SQL = """, p AS (SELECT {by} {score} AS sc, sum(quality)::DOUBLE AS h, (count(*) - sum(quality))::DOUBLE AS m FROM {src} GROUP BY ALL),
    r AS (SELECT *, sum(m) OVER ({part} ORDER BY sc) AS below FROM p)
    SELECT {by} round(sum(h * (below - m/2)) / (sum(h) * sum(m)), 8) AS auc FROM r {group}"""


@query("K8", SCORE_SQL + AUC_SQL.format(by="", score="score", src="s", part="", group=""))
def roc_area(spark, sf):
    return metrics.roc_auc(scored_labels(spark, sf), "quality", "score").select(F.round("auc", 8).alias("auc"))


@query(
    "K8",
    SCORE_SQL + ", g AS (SELECT *, (score >= 0.05::DOUBLE)::INTEGER AS guess FROM s)" + AUC_SQL.format(by="", score="guess", src="g", part="", group=""),
)
def roc_area_of_hard_labels(spark, sf):
    return metrics.roc_auc(_guessed(spark, sf), "quality", "guess").select(F.round("auc", 8).alias("auc"))


FOLD_SQL = SCORE_SQL + f""", g AS (SELECT *, (score >= 0.05::DOUBLE)::INTEGER AS guess,
        ((row_number() OVER (PARTITION BY quality ORDER BY {digest_sql('doc_id', 'fold')}, doc_id) - 1) % 5)::INTEGER AS fold FROM s),
    c AS (SELECT fold, {COUNT_SQL}, round(-avg(ln(greatest(least(CASE WHEN quality = 1 THEN score ELSE 1 - score END, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE))), 8) AS log_loss
        FROM g GROUP BY fold),
    p AS (SELECT fold, score AS sc, sum(quality)::DOUBLE AS h, (count(*) - sum(quality))::DOUBLE AS m FROM g GROUP BY fold, score),
    r AS (SELECT *, sum(m) OVER (PARTITION BY fold ORDER BY sc) AS below FROM p),
    a AS (SELECT fold, round(sum(h * (below - m/2)) / (sum(h) * sum(m)), 8) AS auc FROM r GROUP BY fold)"""


@query("B8 F4", FOLD_SQL + f" SELECT fold, {BINARY_SQL}, log_loss, auc FROM c JOIN a USING (fold)")
def scores_per_fold(spark, sf):
    rows = sampling.stratified_folds(_guessed(spark, sf), "quality", ["doc_id"], "fold", 5)
    report = _rounded_report(metrics.binary_report(rows, "quality", "guess", ["fold"]), ["fold"])
    p_true = F.when(F.col("quality") == 1, F.col("score")).otherwise(1 - F.col("score"))
    losses = rows.groupBy("fold").agg(F.round(metrics.log_loss(p_true), 8).alias("log_loss"))
    areas = metrics.roc_auc(rows, "quality", "score", ["fold"]).select("fold", F.round("auc", 8).alias("auc"))
    return report.join(losses, "fold").join(areas, "fold")


# Quality of texts from what the text shows, by logistic regression and by boosted trees

QUALITY = ["distinct", "odd", "length"]
QUALITY_SQL = f"""WITH shown AS (SELECT l.doc_id, l.quality, len(list_distinct(string_split(d.text, ' '))) / len(string_split(d.text, ' '))::DOUBLE AS distinct_,
        len(regexp_extract_all(d.text, '[^a-zA-Z \\n]')) / (1.0::DOUBLE + length(d.text)) AS odd, ln(1.0::DOUBLE + d.n_chars) / 10 AS length
        FROM labels l JOIN documents d USING (doc_id)),
    quality AS (SELECT doc_id, quality, distinct_ AS "distinct", odd, length, ((row_number() OVER (PARTITION BY quality ORDER BY {digest_sql('doc_id', 'fold')}, doc_id) - 1) % 5)::INTEGER AS fold FROM shown)"""


def quality_rows(spark, sf):
    """Labelled documents with the share of distinct words, of characters other than letters, and the length."""
    docs = read_table(spark, sf, "documents")
    words = F.split("text", " ", -1)
    shown = docs.select(
        "doc_id",
        (F.size(F.array_distinct(words)) / F.size(words)).alias("distinct"),
        (F.regexp_count("text", F.lit("[^a-zA-Z \\n]")) / (1.0 + F.length("text"))).alias("odd"),
        (F.log(1.0 + F.col("n_chars")) / 10).alias("length"),
    )
    rows = read_table(spark, sf, "labels").select("doc_id", "quality").join(shown, "doc_id")
    return pin(sampling.stratified_folds(rows, "quality", ["doc_id"], "fold", 5))


LOGISTIC_STEPS = 8
QUALITY_NAMES = ['"distinct"', "odd", "length"]
LOGISTIC_SQL = (
    QUALITY_SQL
    + ", "
    + logistic_solution("quality", QUALITY_NAMES, "quality", "fold", 5, LOGISTIC_STEPS, "0.01::DOUBLE")
    + """, s AS (SELECT doc_id, quality, fold, 1 / (1 + exp(-greatest(least(w_1*"distinct" + w_2*odd + w_3*length + w_0, 30.0::DOUBLE), -30.0::DOUBLE))) AS score
        FROM quality q JOIN logistic m ON q.fold = m.model)"""
)


def logistic_scored(spark, sf):
    rows = quality_rows(spark, sf)
    models = logistic.fit_logistic(rows, QUALITY, "quality", "fold", 5, LOGISTIC_STEPS, alpha=0.01)
    return rows.withColumn("score", logistic.held_out_probability(models, "fold")), models


@query("B3 F9", LOGISTIC_SQL + " SELECT doc_id, fold, round(score, 6) AS score FROM s")
def logistic_out_of_fold(spark, sf):
    scored, _ = logistic_scored(spark, sf)
    return scored.select("doc_id", "fold", F.round("score", 6).alias("score"))


@query(
    "B3",
    LOGISTIC_SQL + " SELECT model::INTEGER AS model, round(w_0, 5) AS intercept, round(w_1, 5) AS \"distinct\", round(w_2, 5) AS odd, round(w_3, 5) AS length FROM logistic",
)
def logistic_weights(spark, sf):
    _, models = logistic_scored(spark, sf)
    rows = [(i, round(m.intercept, 5), *[round(w, 5) for w in m.weights]) for i, m in models.items()]
    return spark.createDataFrame(rows, "model int, intercept double, distinct double, odd double, length double")


SIX = ["accuracy", "precision_macro", "recall_macro", "f1", "auc", "log_loss"]
SIX_SQL = LOGISTIC_SQL + """, g AS (SELECT *, (score >= 0.5::DOUBLE)::INTEGER AS guess FROM s),
    c AS (SELECT fold, count(*) FILTER (quality = 1 AND guess = 1)::DOUBLE AS tp, count(*) FILTER (quality = 0 AND guess = 1)::DOUBLE AS fp,
        count(*) FILTER (quality = 1 AND guess = 0)::DOUBLE AS fn, count(*) FILTER (quality = 0 AND guess = 0)::DOUBLE AS tn,
        -avg(ln(greatest(least(CASE WHEN quality = 1 THEN score ELSE 1 - score END, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE))) AS log_loss FROM g GROUP BY fold),
    p AS (SELECT fold, score AS sc, sum(quality)::DOUBLE AS h, (count(*) - sum(quality))::DOUBLE AS m FROM g GROUP BY fold, score),
    r AS (SELECT *, sum(m) OVER (PARTITION BY fold ORDER BY sc) AS below FROM p),
    a AS (SELECT fold, sum(h * (below - m/2)) / (sum(h) * sum(m)) AS auc FROM r GROUP BY fold),
    six AS (SELECT fold, (tp+tn)/(tp+fp+fn+tn) AS accuracy, (coalesce(tp/nullif(tp+fp, 0), 0) + coalesce(tn/nullif(tn+fn, 0), 0))/2 AS precision_macro,
        (coalesce(tp/nullif(tp+fn, 0), 0) + coalesce(tn/nullif(tn+fp, 0), 0))/2 AS recall_macro, coalesce(2*tp/nullif(2*tp+fp+fn, 0), 0) AS f1, auc, log_loss
        FROM c JOIN a USING (fold))"""


@query("B8 K14", SIX_SQL + " SELECT fold, " + ", ".join(f"round({c}, 6) AS {c}" for c in SIX) + " FROM six")
def six_scores_per_fold(spark, sf):
    """A model per fold, judged on the fold by the six scorers."""
    scored, _ = logistic_scored(spark, sf)
    found = metrics.six_scores(scored, "quality", "score", ["fold"])
    return found.select("fold", *[F.round(c, 6).alias(c) for c in SIX])


@query("B8 A19", SIX_SQL + " SELECT " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in SIX) + " FROM six")
def six_mean_scores(spark, sf):
    scored, _ = logistic_scored(spark, sf)
    found = metrics.six_scores(scored, "quality", "score", ["fold"])
    return found.agg(*[F.round(F.avg(c), 6).alias(c) for c in SIX])


@query("B3")
def boosted_binary_scores(spark, sf):
    """Every labelled text scored by boosted trees that did not see it."""
    rows = quality_rows(spark, sf).withColumn("quality", F.col("quality").cast("double"))
    scored = learn.binary_boosted_folds(rows, QUALITY, "quality", "fold", 5)
    return scored.select("doc_id", "fold", "quality", "score", "prediction")


SEARCH_SPACE = {"depth": (2.0, 4.0, 1.0), "rounds": (4.0, 12.0, 2.0), "step": (0.05, 0.5, 0.05), "share": (0.6, 1.0, 0.1)}
SEARCH_RUNS = 6
SEARCH_POINTS = tuning.sampled_points(SEARCH_SPACE, SEARCH_RUNS, "classifier")


@query("B7 B3")
def classifier_random_search(spark, sf):
    """Points from quantised ranges of four parameters; the loss of a point is 1 - accuracy over the folds."""
    losses = learn.searched_classifiers(quality_rows(spark, sf), QUALITY, "quality", "fold", 5, SEARCH_POINTS)
    rows = [(run, *[float(p[n]) for n in SEARCH_SPACE], loss) for run, (p, loss) in enumerate(zip(SEARCH_POINTS, losses, strict=True))]
    found = spark.createDataFrame(rows, "run int, " + ", ".join(f"{n} double" for n in SEARCH_SPACE) + ", loss double")
    return tuning.ranked(found, "loss", rising=True)


# Several classes: models per fold, probabilities of unseen rows, log loss and MAP@3 per fold, decoded top three


def embedding_folds(spark, sf):
    """Embeddings with a fold for training rows; test rows have none."""
    emb = read_table(spark, sf, "embeddings").where("label IS NOT NULL")
    test = sampling.holdout_flag(["vec_id"], "classes")
    fold = sampling.fold_number(["vec_id"], "class folds", 5)
    return emb.select("vec_id", "label", "embedding", test.alias("is_test"), F.when(~test, fold).alias("fold"))


CLASS_FOLD_SQL = f"""WITH e AS (SELECT vec_id, label, embedding, {bucket32_sql('vec_id', 'classes')} / 4294967296.0::DOUBLE < 0.2::DOUBLE AS is_test,
        {bucket32_sql('vec_id', 'class folds')} % 5 AS f FROM embeddings WHERE label IS NOT NULL),
    flat AS (SELECT vec_id, label, is_test, f, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM e),
    parts AS (SELECT f, label AS class, i, sum(v) AS s, count(*) AS n FROM flat WHERE NOT is_test GROUP BY ALL),
    cen AS (SELECT g.f, class, i, sum(s) / sum(n) AS m FROM (SELECT DISTINCT f FROM parts) g JOIN parts p ON p.f <> g.f GROUP BY ALL),
    d AS (SELECT vec_id, label, is_test, c.f, class, -sqrt(sum((v - m)*(v - m))) AS d FROM flat x JOIN cen c ON x.i = c.i AND (x.is_test OR x.f = c.f) GROUP BY ALL),
    ex AS (SELECT *, exp(d - max(d) OVER (PARTITION BY vec_id, f)) AS e FROM d),
    pr AS (SELECT vec_id, label, is_test, f, class, e / sum(e) OVER (PARTITION BY vec_id, f) AS p FROM ex)"""


def centroid_models(spark, sf):
    rows = embedding_folds(spark, sf)
    return rows, cls.fold_centroids(rows, "label", "embedding", "fold")


def centroid_probabilities(rows, models):
    """Each training row by the centroids of the other folds."""
    own = [F.when(F.col("fold") == i, cls.class_probabilities(F.col("embedding"), c)) for i, c in models.items()]
    return rows.where("NOT is_test").withColumn("probs", F.coalesce(*own))


@query("B4 F9", CLASS_FOLD_SQL + " SELECT vec_id, f::INTEGER AS fold, class, round(p, 8) AS p FROM pr WHERE NOT is_test")
def centroid_out_of_fold(spark, sf):
    rows, models = centroid_models(spark, sf)
    names = F.array(*[F.lit(c) for c in next(iter(models.values()))])
    long = centroid_probabilities(rows, models).select("vec_id", "fold", F.posexplode("probs").alias("i", "p"))
    return long.select("vec_id", "fold", names[F.col("i")].alias("class"), F.round("p", 8).alias("p"))


def class_fold_scores(rows, names):
    """Log loss and MAP@3 per fold of rows with ``fold``, ``label`` and ``probs``."""
    place = cls.class_position(F.col("label"), names)
    marked = rows.select("fold", F.element_at("probs", place + 1).alias("p"), cls.true_rank(F.col("probs"), place).alias("rank"))
    return marked.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        metrics.log_loss(F.col("p")).alias("log_loss"),
        F.avg(metrics.reciprocal_hit(F.col("rank"), 3)).alias("map_3"),
    )


@query(
    "B4 K6 K9",
    CLASS_FOLD_SQL + """, rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) AS k FROM pr WHERE NOT is_test)
    SELECT f::INTEGER AS fold, count(*) AS n, round(-avg(ln(greatest(least(p, 1 - 1e-15::DOUBLE), 1e-15::DOUBLE))), 8) AS log_loss,
        round(avg(CASE WHEN k <= 3 THEN 1.0::DOUBLE / k ELSE 0 END), 8) AS map_3 FROM rk WHERE class = label GROUP BY f""",
)
def centroid_fold_scores(spark, sf):
    rows, models = centroid_models(spark, sf)
    found = class_fold_scores(centroid_probabilities(rows, models), list(next(iter(models.values()))))
    return found.select("fold", "n", *[F.round(c, 8).alias(c) for c in ("log_loss", "map_3")])


@query(
    "B4 F10 P18",
    CLASS_FOLD_SQL + """, mean AS (SELECT vec_id, class, avg(p) AS p FROM pr WHERE is_test GROUP BY vec_id, class),
    rk AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) AS k FROM mean)
    SELECT vec_id, string_agg(class::VARCHAR, ' ' ORDER BY k) AS labels FROM rk WHERE k <= 3 GROUP BY vec_id""",
)
def centroid_test_labels(spark, sf):
    """Test rows: mean of the fold models, the three most probable labels in one string."""
    rows, models = centroid_models(spark, sf)
    each = [cls.class_probabilities(F.col("embedding"), c) for c in models.values()]
    mean = F.transform(reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), each), lambda x: x / len(each))
    top = cls.ranked_classes(mean, list(next(iter(models.values()))), 3)
    return rows.where("is_test").select("vec_id", F.array_join(F.transform(top, lambda c: c.cast("string")), " ").alias("labels"))


#: What tells the languages of the texts apart, as shares of all characters.
MARKS = {"acute": "[áéíóú]", "grave": "[àèù]", "umlaut": "[äöüß]", "tilde": "ñ", "th": "th", "ei": "ei", "k": "k", "qu": "qu"}
LANGUAGE_ROUNDS = 5


def language_folds(spark, sf):
    docs = read_table(spark, sf, "documents").where("lang IS NOT NULL")
    shares = [
        (F.regexp_count(F.lower("text"), F.lit(p)) / (1.0 + F.length("text"))).cast("double").alias(n) for n, p in MARKS.items()
    ]
    test = sampling.holdout_flag(["doc_id"], "languages")
    fold = F.when(~test, sampling.fold_number(["doc_id"], "language folds", 5))
    return pin(docs.select("doc_id", F.col("lang").alias("label"), test.alias("is_test"), fold.alias("fold"), *shares).na.fill(0.0, list(MARKS)))


def boosted_languages(spark, sf, rounds=LANGUAGE_ROUNDS):
    rows = language_folds(spark, sf)
    names = distinct_values(rows, "label", cls.MOST_CLASSES)
    train = rows.where("NOT is_test")
    return rows, names, learn.boosted_class_folds(train, list(MARKS), "label", names, "fold", 5, rounds)


@query("B4 F9")
def boosted_class_probabilities(spark, sf):
    """One boosted model per class and fold; every training row scored by models that did not see it."""
    rows, names, models = boosted_languages(spark, sf)
    scored = learn.class_probabilities_out_of_fold(rows.where("NOT is_test"), list(MARKS), "fold", models)
    listed = F.array(*[F.lit(c) for c in names])
    return scored.select("doc_id", "fold", "label", F.posexplode("probs").alias("i", "p")).select(
        "doc_id", "fold", "label", listed[F.col("i")].alias("class"), "p"
    )


@query("B4 K6 K9")
def boosted_class_fold_scores(spark, sf):
    rows, names, models = boosted_languages(spark, sf)
    scored = learn.class_probabilities_out_of_fold(rows.where("NOT is_test"), list(MARKS), "fold", models)
    return class_fold_scores(scored, names)


@query("B4 F10 P18")
def boosted_test_labels(spark, sf):
    rows, names, models = boosted_languages(spark, sf)
    scored = learn.mean_class_probabilities(rows.where("is_test"), list(MARKS), models)
    top = cls.ranked_classes(F.col("probs"), names, 3)
    return scored.select("doc_id", "label", F.array_join(top, " ").alias("labels"))


@query("B4")
def forest_class_probabilities(spark, sf):
    """Every embedding with the class shares of a random forest that did not see it."""
    rows = read_table(spark, sf, "embeddings").withColumn("fold", sampling.fold_number(["vec_id"], "class folds", 5))
    scored = learn.forest_folds(rows, "embedding", "label", "fold", 5)
    return scored.select("vec_id", "fold", "label", "prediction", "probabilities")
