"""What must hold of every fitted model's output, against figures that SQL takes from the tables alone."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tabulark.operators import metrics
from tabulark.plans import modelling, scoring, text_mining
from tabulark.plans.registry import query
from tabulark.plans.shared import FOLDS, LINE_SQL, line_items
from tabulark.plans.sqlbits import bucket32, digest
from tabulark.session import pin, read_table


def _scored_once(scored, truth, key):
    """Rows, rows scored exactly once, and whether the squared error is at most half above that of the mean.

    The prices of the test tables do not depend on the features, so no model beats the mean by much.
    """
    met = scored.join(truth, key)
    error, spread = F.avg((F.col("prediction") - F.col("truth")) ** 2), F.var_pop("truth")
    return met.groupBy().agg(
        F.count(F.lit(1)).alias("scored"), F.countDistinct(key).alias("rows"), (error < 1.5 * spread).alias("near_truth")
    )


@query(
    "B1 F9",
    LINE_SQL + """ SELECT count(*) AS scored, count(*) AS rows, true AS near_truth,
        count(DISTINCT fold) AS folds FROM line WHERE NOT is_test""",
)
def boosted_out_of_fold_facts(spark, sf):
    # The models are fitted by now; the folds are counted without their scores.
    scored = modelling.boosted_out_of_fold(spark, sf)
    truth = line_items(spark, sf).select("row_id", F.col("price").alias("truth"))
    folds = scored.agg(F.countDistinct("fold").alias("folds"))
    return _scored_once(scored.select("row_id", "prediction"), truth, "row_id").crossJoin(folds)


@query("B1 F10", LINE_SQL + " SELECT count(*) AS scored, count(*) AS rows, true AS near_truth FROM line WHERE is_test")
def boosted_test_mean_facts(spark, sf):
    truth = line_items(spark, sf).select("row_id", F.col("price").alias("truth"))
    return _scored_once(modelling.boosted_test_mean(spark, sf), truth, "row_id")


@query("K15 B5", "SELECT 1 AS first, true AS gapless, true AS improved")
def boosted_learning_curve_facts(spark, sf):
    """Both parts have every round from 1 on, and the training error ends below its start."""
    return plain_curve_facts(modelling.boosted_learning_curve(spark, sf))


def plain_curve_facts(curve):
    train = F.when(F.col("part") == "train", F.col("mse"))
    rounds, at = F.max("iteration"), F.when(train.isNotNull(), F.col("iteration"))
    return curve.agg(
        F.min("iteration").alias("first"),
        F.coalesce(
            (F.count_if(F.col("part") == "train") == rounds) & (F.count_if(F.col("part") == "test") == rounds), F.lit(False)
        ).alias("gapless"),
        # A model that stopped at once has one round to show.
        F.coalesce((rounds == 1) | (F.max_by(train, at) < F.min_by(train, at)), F.lit(False)).alias("improved"),
    )


@query("B9", f"SELECT {len(modelling.TREE_FEATURES)} AS features, 1.0::DOUBLE AS total, true AS in_range")
def boosted_importances_facts(spark, sf):
    return modelling.boosted_importances(spark, sf).agg(
        F.count(F.lit(1)).alias("features"),
        F.round(F.sum("importance"), 9).alias("total"),
        F.bool_and(F.col("importance").between(0, 1)).alias("in_range"),
    )


SIZED_SQL = "FROM documents WHERE text IS NOT NULL AND n_chars IS NOT NULL"


@query("B1 B5 F6 F9", f"SELECT count(*) AS rows, count(DISTINCT doc_id) AS documents, {FOLDS} AS folds, round(sum(ln(1.0::DOUBLE + n_chars)), 3) AS targets, true AS tells {SIZED_SQL}")
def patient_facts(spark, sf):
    """Every document is scored once; the error is below a third of that of the best constant."""
    return error_facts(modelling.patient_out_of_fold(spark, sf))


def error_facts(found, share=1 / 3):
    error, spread = F.sqrt(F.avg((F.col("prediction") - F.col("target")) ** 2)), F.stddev_pop("target")
    return found.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("doc_id").alias("documents"),
        F.countDistinct("fold").cast("int").alias("folds"),
        F.round(F.sum("target"), 3).alias("targets"),
        F.coalesce(error < share * spread, F.lit(False)).alias("tells"),
    )


@query("K15 B5", f"SELECT unnest(range({FOLDS}))::INTEGER AS fold, true AS gapless, true AS falls, true AS waited")
def patient_curve_facts(spark, sf):
    """Rounds without a gap, training errors that fall, and an end once the patience is over."""
    return curve_facts(modelling.patient_curves(spark, sf), modelling.SIZE_ROUNDS, modelling.SIZE_PATIENCE)


def curve_facts(curves, rounds, patience):
    sides = curves.groupBy("fold", "iteration").agg(
        F.max(F.when(F.col("part") == "train", F.col("mse"))).alias("train"),
        F.max(F.when(F.col("part") == "valid", F.col("mse"))).alias("valid"),
    )
    best, last = F.min_by("iteration", F.struct("valid", "iteration")), F.max("iteration")
    return sides.groupBy("fold").agg(
        ((F.count("train") == last) & (F.count("valid") == last)).alias("gapless"),
        (F.max_by("train", "iteration") < F.min_by("train", "iteration")).alias("falls"),
        ((last == rounds) | (last - best >= patience)).alias("waited"),
    )


@query(
    "E14 B1",
    modelling.SIZE_BIN_SQL + f""" f AS (SELECT doc_id, ((row_number() OVER (PARTITION BY bin ORDER BY {digest('doc_id', 'sizes')}, doc_id) - 1) % {FOLDS}) AS fold FROM b)
    SELECT {len(modelling.SIZE_PRODUCTS)} AS tried, true AS in_order, true AS greedy, true AS tells,
        round(stddev_pop(ln(1.0::DOUBLE + n_chars)), 6) AS spread FROM f JOIN documents USING (doc_id) WHERE fold = 0""",
)
def tree_selection_facts(spark, sf):
    """Each product is tried once and kept exactly if it lowers the error, which stays below a third of the judge's spread."""
    judge = modelling.sized_documents(spark, sf).where("fold = 0").agg(F.stddev_pop("target").alias("spread"))
    return selection_facts(modelling.forward_selection_with_trees(spark, sf), modelling.SIZE_PRODUCTS, judge)


def selection_facts(trace, candidates, judge):
    """``trace`` is short: one row per candidate and the start; ``judge`` is one row, the spread of the target."""
    steps = F.sort_array(F.collect_list(F.struct("step", "candidate", "rmse", "kept")))
    found = trace.agg(steps.alias("s")).crossJoin(F.broadcast(judge))
    before = lambda i: F.array_min(F.transform(F.slice("s", 1, i), lambda r: r["rmse"]))
    greedy = F.forall(
        F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.get("s", i)["kept"] == (F.get("s", i)["rmse"] < before(i))
    )
    several = F.size("s") > 1
    return found.select(
        (F.size("s") - 1).alias("tried"),
        (F.transform("s", lambda r: r["candidate"]) == F.array(F.lit(""), *[F.lit(c) for c in candidates])).alias("in_order"),
        F.coalesce(F.when(several, greedy), F.lit(False)).alias("greedy"),
        F.coalesce(F.array_min(F.transform("s", lambda r: r["rmse"])) < F.col("spread") / 3, F.lit(False)).alias("tells"),
        F.round("spread", 6).alias("spread"),
    )


def _drawn(name: str) -> str:
    low, high, step = (f"{x!r}::DOUBLE" for x in scoring.SEARCH_SPACE[name])
    draw = f"('0x' || substr(md5(concat(run, '-{name}-classifier')), 1, 8))::UBIGINT / 4294967296.0::DOUBLE"
    return f"round(round(({low} + {draw} * ({high} - {low})) / {step}) * {step}, 9) AS {name}"


@query(
    "B7 B3",
    f"""SELECT run::INTEGER AS run, {', '.join(_drawn(n) for n in scoring.SEARCH_SPACE)}, true AS placed, true AS tells
    FROM (SELECT unnest(range({scoring.SEARCH_RUNS})) AS run), (SELECT count(*) AS n FROM labels) WHERE n > 0""",
)
def classifier_search_facts(spark, sf):
    """The points are those of the seeded draws; ranks follow the loss, which is below that of the more frequent class."""
    rare = read_table(spark, sf, "labels").agg(F.least(F.avg("quality"), 1 - F.avg("quality")).alias("rare"))
    return search_facts(pin(scoring.classifier_random_search(spark, sf)), list(scoring.SEARCH_SPACE), rare)


def search_facts(found, names, rare):
    other = found.select(F.col("loss").alias("_loss"))
    below = found.join(other, F.col("_loss") < F.col("loss"), "left").groupBy("run").agg(F.count("_loss").alias("_below"))
    return found.join(below, "run").crossJoin(F.broadcast(rare)).select(
        "run",
        *[F.round(n, 9).alias(n) for n in names],
        (F.col("rank") == F.col("_below") + 1).alias("placed"),
        F.coalesce(F.col("loss").between(0, F.col("rare")), F.lit(False)).alias("tells"),
    )


@query("B3", "SELECT count(*) AS rows, count(DISTINCT doc_id) AS documents, true AS in_range, true AS tells FROM labels JOIN documents USING (doc_id)")
def boosted_binary_facts(spark, sf):
    """Every labelled text is scored once, and good ones score higher."""
    return binary_facts(pin(scoring.boosted_binary_scores(spark, sf)))


def binary_facts(found):
    facts = found.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("doc_id").alias("documents"),
        F.coalesce(
            F.bool_and(F.col("score").between(0, 1) & ((F.col("score") > 0.5) == (F.col("prediction") == 1))), F.lit(False)
        ).alias("in_range"),
    )
    area = metrics.roc_auc(found.withColumn("quality", F.col("quality").cast("int")), "quality", "score")
    return facts.crossJoin(F.broadcast(area.agg(F.coalesce(F.max("auc") > 0.6, F.lit(False)).alias("tells"))))


LANGUAGE_SQL = f"WITH d AS (SELECT *, {bucket32('doc_id', 'languages')} / 4294967296.0::DOUBLE < 0.2::DOUBLE AS is_test FROM documents WHERE lang IS NOT NULL)"


@query(
    "B4 F9",
    LANGUAGE_SQL + " SELECT count(*) AS documents, count(*) * (SELECT count(DISTINCT lang) FROM d) AS rows, true AS whole, true AS tells FROM d WHERE NOT is_test",
)
def boosted_class_facts(spark, sf):
    """Probabilities of every training row add up to one and put the true class first more often than not."""
    return class_facts(pin(scoring.boosted_class_probabilities(spark, sf)))


def class_facts(found):
    each = found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("p").alias("s"), F.max_by(F.col("class") == F.col("label"), "p").alias("hit")
    )
    return each.agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("n").alias("rows"),
        F.coalesce(F.bool_and(F.abs(F.col("s") - 1) < 1e-9), F.lit(False)).alias("whole"),
        F.coalesce(F.avg(F.col("hit").cast("double")) > 0.7, F.lit(False)).alias("tells"),
    )


@query("B4 K6 K9", "SELECT unnest(range(5))::INTEGER AS fold, true AS low_loss, true AS high_map")
def boosted_class_score_facts(spark, sf):
    """Log loss below that of equal shares among four classes, MAP@3 above one half, in every fold."""
    return scoring.boosted_class_fold_scores(spark, sf).select(
        "fold", (F.col("log_loss") < 1.2).alias("low_loss"), (F.col("map_3") > 0.7).alias("high_map")
    )


@query("B4 F10", LANGUAGE_SQL + " SELECT count(*) AS rows, 3 AS labels, true AS tells FROM d WHERE is_test")
def boosted_test_label_facts(spark, sf):
    """Test rows have three labels each, the first mostly the true one."""
    found = scoring.boosted_test_labels(spark, sf).withColumn("_l", F.split("labels", " "))
    return found.agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.size("_l")).alias("labels"),
        F.coalesce(F.avg((F.col("_l")[0] == F.col("label")).cast("double")) > 0.7, F.lit(False)).alias("tells"),
    )


@query("B4", "SELECT count(*) AS rows, count(DISTINCT label) AS classes, true AS whole, true AS chosen FROM embeddings")
def forest_facts(spark, sf):
    """Every embedding is scored once; its shares add up to one and the largest is the prediction.

    The labels of the test tables do not depend on the vectors, so no model tells them apart.
    """
    found = scoring.forest_class_probabilities(spark, sf)
    whole = F.aggregate("probabilities", F.lit(0.0), lambda a, b: a + b)
    return found.agg(
        F.countDistinct("vec_id").alias("rows"),
        F.max(F.size("probabilities")).cast("long").alias("classes"),
        F.coalesce(F.bool_and(F.abs(whole - 1) < 1e-9), F.lit(False)).alias("whole"),
        F.coalesce(
            F.bool_and(F.element_at("probabilities", F.col("prediction").cast("int") + 1) == F.array_max("probabilities")), F.lit(False)
        ).alias("chosen"),
    )


KEPT_WORDS_SQL = (
    text_mining.CLASS_SQL
    + """ nd AS (SELECT count(*) AS nd FROM documents), df AS (SELECT term, count(DISTINCT doc_id) AS df FROM tok GROUP BY term),
    worded AS (SELECT DISTINCT doc_id FROM tok JOIN df USING (term), nd WHERE df >= 2 AND df <= nd * 0.5::DOUBLE),
    kept AS (SELECT term FROM df, nd WHERE df >= 2 AND df <= nd * 0.5::DOUBLE)"""
)


@query("T12", KEPT_WORDS_SQL + " SELECT count(*) AS documents, sum(doc_id)::BIGINT AS ids, true AS unit_length FROM worded")
def reduced_documents_facts(spark, sf):
    """Every document with a kept word has a vector of length one."""
    return length_facts(text_mining.reduced_documents(spark, sf))


def length_facts(placed):
    lengths = placed.groupBy("doc_id").agg(F.sum(F.col("value") ** 2).alias("n"))
    return lengths.agg(
        F.count(F.lit(1)).alias("documents"),
        F.sum("doc_id").alias("ids"),
        F.coalesce(F.bool_and(F.col("n").between(1 - 1e-9, 1 + 1e-9)), F.lit(False)).alias("unit_length"),
    )


@query("T12", "SELECT true AS dimensions, true AS falling, true AS within")
def singular_value_facts(spark, sf):
    """At most as many as asked for, falling, and together not above the squared lengths, which are ones."""
    docs = read_table(spark, sf, "documents").count()
    return value_facts(text_mining.singular_values(spark, sf), text_mining.DIMENSIONS, docs)


def value_facts(values, most, docs):
    falls = F.coalesce(F.lag("value").over(Window.orderBy("dimension")) >= F.col("value"), F.lit(True))
    checked = values.withColumn("falls", falls)
    total = F.sum(F.col("value") ** 2)
    return checked.agg(
        F.count(F.lit(1)).between(1, most).alias("dimensions"),
        F.coalesce(F.bool_and("falls"), F.lit(False)).alias("falling"),
        # 300 dimensions hold a fair share of the length of all documents.
        F.coalesce(total.between(0.2 * docs, docs * (1 + 1e-9)), F.lit(False)).alias("within"),
    )


@query("T14", KEPT_WORDS_SQL + f" SELECT count(*) AS documents, {text_mining.CLUSTERS} AS clusters, true AS agree FROM worded")
def document_cluster_facts(spark, sf):
    """Every document with a kept word has a cluster, and the clusters say something of the language."""
    langs = read_table(spark, sf, "documents").select("doc_id", "lang")
    return cluster_facts(pin(text_mining.document_clusters(spark, sf).join(langs, "doc_id")))


def cluster_facts(found):
    counts = found.agg(F.count(F.lit(1)).alias("documents"), F.countDistinct("cluster").cast("int").alias("clusters"))
    agreement = metrics.cluster_agreement(found, "lang", "cluster").select((F.col("v_measure") > 0.5).alias("agree"))
    return counts.crossJoin(F.broadcast(agreement))


@query(
    "T14",
    KEPT_WORDS_SQL + f" SELECT {text_mining.CLUSTERS} AS clusters, {text_mining.CLUSTERS} * least(50, count(*)) AS rows, true AS ranked, true AS known FROM kept",
)
def cluster_term_facts(spark, sf):
    """Fifty kept terms per cluster, by falling weight."""
    docs = text_mining.documents(spark, sf).select(F.explode(text_mining.class_tokens()).alias("term")).distinct()
    return term_facts(pin(text_mining.cluster_terms(spark, sf)), docs)


def term_facts(found, known):
    in_order = F.row_number().over(Window.partitionBy("cluster").orderBy(F.desc("weight"), "term")) == F.col("rank")
    checked = found.withColumn("in_order", in_order).join(known.withColumn("known", F.lit(True)), "term", "left")
    return checked.agg(
        F.countDistinct("cluster").cast("int").alias("clusters"),
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.bool_and("in_order"), F.lit(False)).alias("ranked"),
        F.coalesce(F.bool_and(F.col("known").isNotNull()), F.lit(False)).alias("known"),
    )


@query("T15", "SELECT topic, 10 AS terms, true AS ranked FROM (SELECT unnest(range(10))::INTEGER AS topic)")
def topic_keywords_facts(spark, sf):
    """Ten terms a topic, ranked by falling weight."""
    return topic_facts(pin(text_mining.topic_keywords(spark, sf)))


def topic_facts(found):
    falls = F.coalesce(F.lag("weight").over(Window.partitionBy("topic").orderBy("rank")) >= F.col("weight"), F.col("rank") == 1)
    return found.withColumn("falls", falls & (F.col("weight") > 0)).groupBy(F.col("topic").cast("int").alias("topic")).agg(
        F.countDistinct("term").alias("terms"), (F.bool_and("falls") & (F.max("rank") == F.count(F.lit(1)))).alias("ranked")
    )


@query("T16", "SELECT count(*) AS documents, 10 AS topics, true AS whole FROM documents")
def topic_shares_facts(spark, sf):
    each = text_mining.topic_shares(spark, sf).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("share").alias("s"))
    return each.agg(
        F.count(F.lit(1)).alias("documents"),
        F.max("n").alias("topics"),
        F.bool_and((F.abs(F.col("s") - 1) < 1e-6) | (F.col("s") == 0)).alias("whole"),
    )


@query(
    "W3",
    """SELECT count(*) AS rows, count(DISTINCT doc_id) AS documents, 5 AS keywords, true AS strongest,
        sum(doc_id)::BIGINT AS ids FROM documents""",
)
def main_topics_facts(spark, sf):
    """One topic per document, no weaker than an equal share, with five keywords."""
    return main_topic_facts(text_mining.main_topics(spark, sf))


def main_topic_facts(found):
    return found.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("doc_id").alias("documents"),
        F.max(F.size(F.split("keywords", ", "))).alias("keywords"),
        # A document without a known word has no share at all.
        F.coalesce(F.bool_and((F.col("share") >= 0.0999) & (F.col("share") <= 1) | (F.col("share") == 0)), F.lit(False)).alias("strongest"),
        F.sum("doc_id").alias("ids"),
    )


@query("F4", LINE_SQL + f" SELECT {FOLDS} AS folds, true AS even FROM line LIMIT 1")
def boosted_fold_sizes(spark, sf):
    """The folds that the boosted models use are of like size."""
    sizes = line_items(spark, sf).where("NOT is_test").groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.count(F.lit(1)).alias("folds"), (F.max("n") < 1.2 * F.min("n")).alias("even"))
