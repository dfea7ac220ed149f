"""Evaluation measures as grouped aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabulark.functions.numeric import clip
from tabulark.operators.ordering import value_ranks
from tabulark.operators.project import distinct_values

LEAST_PROBABILITY = 1e-15


def rmse(truth: Column, guess: Column) -> Column:
    return F.sqrt(F.avg((truth - guess) * (truth - guess)))


def rmsle(truth: Column, guess: Column) -> Column:
    return rmse(F.log1p(truth), F.log1p(guess))


def regression_errors(df: DataFrame, truth: str, guess: str, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(
        rmse(F.col(truth), F.col(guess)).alias("rmse"),
        rmsle(F.col(truth), F.col(guess)).alias("rmsle"),
        F.count(F.lit(1)).alias("n"),
    )


def binary_report(df: DataFrame, truth: str, guess: str, by: list[str] | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 of 0/1 guesses; an empty denominator gives null."""
    t, g = F.col(truth) == 1, F.col(guess) == 1
    counted = df.groupBy(*(by or [])).agg(
        F.count_if(t & g).alias("tp"),
        F.count_if(~t & g).alias("fp"),
        F.count_if(t & ~g).alias("fn"),
        F.count_if(~t & ~g).alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counted.select(
        "*",
        F.try_divide(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, tp + fn).alias("recall"),
        F.try_divide(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def pair_counts(df: DataFrame, truth: str, guess: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("truth"), F.col(guess).alias("guess")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion(df: DataFrame, truth: str, guess: str, most_classes: int = 200) -> DataFrame:
    """Count for every (true, predicted) class pair, zeros kept."""
    counts = pair_counts(df, truth, guess)
    both = counts.select(F.col("truth").alias("c")).unionByName(counts.select(F.col("guess").alias("c")))
    classes = distinct_values(both, "c", most_classes)
    levels = F.array(*[F.lit(c) for c in classes])
    frame = (
        df.sparkSession.range(1)
        .select(F.explode(levels).alias("truth"))
        .select("truth", F.explode(levels).alias("guess"))
    )
    return frame.join(counts, ["truth", "guess"], "left").select(
        "truth", "guess", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def class_scores(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Precision, recall, F1 and support per class."""
    counts = pair_counts(df, truth, guess)
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("truth").alias("class"), F.col("n").alias("support"), F.lit(0).cast("long").alias("chosen")),
                F.struct(F.col("guess").alias("class"), F.lit(0).cast("long").alias("support"), F.col("n").alias("chosen")),
            )
        ).alias("s"),
        F.when(F.col("truth") == F.col("guess"), F.col("n")).otherwise(0).alias("hit"),
    )
    summed = sides.groupBy("s.class").agg(
        F.sum("s.support").alias("support"),
        F.sum("s.chosen").alias("chosen"),
        (F.sum("hit") / 2).alias("hits"),
    )
    zero = F.lit(0.0)
    return summed.select(
        "class",
        F.coalesce(F.try_divide("hits", "chosen"), zero).alias("precision"),
        F.coalesce(F.try_divide("hits", "support"), zero).alias("recall"),
        F.coalesce(F.try_divide(2 * F.col("hits"), F.col("chosen") + F.col("support")), zero).alias("f1"),
        "support",
    )


def class_report(df: DataFrame, truth: str, guess: str) -> DataFrame:
    """Class rows followed by their plain and their support-weighted mean."""
    rows = class_scores(df, truth, guess).withColumn("class", F.col("class").cast("string"))
    kinds = ("precision", "recall", "f1")
    plain = rows.agg(F.lit("macro avg").alias("class"), *[F.avg(k).alias(k) for k in kinds], F.sum("support").alias("support"))
    weighted = rows.agg(
        F.lit("weighted avg").alias("class"),
        *[(F.sum(F.col(k) * F.col("support")) / F.sum("support")).alias(k) for k in kinds],
        F.sum("support").alias("support"),
    )
    return rows.unionByName(plain).unionByName(weighted)


def six_scores(df: DataFrame, label: str, score: str, by: list[str], cut: float = 0.5) -> DataFrame:
    """Accuracy, macro precision and recall, F1, area under the curve and log loss of 0/1 scores, per group.

    A class that nobody has or that is never guessed counts 0 in its mean.
    """
    guessed = df.withColumn("_guess", (F.col(score) >= cut).cast("int"))
    counts = binary_report(guessed, label, "_guess", by)
    zero = F.lit(0.0)
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def mean(a: Column, b: Column) -> Column:
        return (F.coalesce(a, zero) + F.coalesce(b, zero)) / 2

    shown = counts.select(
        *by,
        "accuracy",
        mean(F.try_divide(tp, tp + fp), F.try_divide(tn, tn + fn)).alias("precision_macro"),
        mean(F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)).alias("recall_macro"),
        F.coalesce("f1", zero).alias("f1"),
    )
    p_true = F.when(F.col(label) == 1, F.col(score)).otherwise(1 - F.col(score))
    losses = df.groupBy(*by).agg(log_loss(p_true).alias("log_loss"))
    return shown.join(roc_auc(df, label, score, by), by).join(losses, by)


def log_loss(true_probability: Column) -> Column:
    """Aggregate: mean of -ln p with p held away from 0 and 1."""
    return -F.avg(F.log(clip(true_probability, LEAST_PROBABILITY, 1 - LEAST_PROBABILITY)))


def roc_points(df: DataFrame, label: str, score: str) -> DataFrame:
    """One point per distinct score, from the highest score down."""
    falling = df.select((-F.col(score)).alias("_fall"), F.col(label).alias("_y"))
    ranks = value_ranks(falling, [], "_fall", {"hits": F.col("_y"), "misses": 1 - F.col("_y")})
    return ranks.select(
        (-F.col("_fall")).alias("threshold"),
        F.try_divide("misses", "misses_total").alias("fpr"),
        F.try_divide("hits", "hits_total").alias("tpr"),
    )


def roc_auc(df: DataFrame, label: str, score: str, by: list[str] | None = None) -> DataFrame:
    """Area under the curve; equal scores count half. Distinct scores are ranked, not rows."""
    by = by or []
    slim = df.select(*by, F.col(score).alias("_s"), F.col(label).alias("_y"))
    ranks = value_ranks(slim, by, "_s", {"pos": F.col("_y"), "neg": 1 - F.col("_y")})
    won = F.col("_pos") * (F.col("neg") - F.col("_neg") / 2)
    return ranks.groupBy(*by).agg(
        F.try_divide(F.sum(won), F.max("pos_total") * F.max("neg_total")).alias("auc")
    )


def reciprocal_hit(rank: Column, k: int) -> Column:
    """1/rank for a hit within the first ``k`` places, else 0."""
    return F.when(rank <= k, 1.0 / rank).otherwise(0.0)


def cluster_agreement(df: DataFrame, label: str, cluster: str) -> DataFrame:
    """Homogeneity, completeness and V-measure from the contingency counts."""
    cells = pair_counts(df, label, cluster)
    marked = cells.select(
        "n",
        F.sum("n").over(Window.partitionBy("truth")).alias("in_truth"),
        F.sum("n").over(Window.partitionBy("guess")).alias("in_guess"),
    )
    rows = F.sum("n")
    # Each cell carries its share of the marginal entropies, so one aggregate is enough.
    facts = marked.agg(
        rows.alias("rows"),
        F.sum(F.col("n") * F.log(F.col("n"))).alias("joint"),
        F.sum(F.col("n") * F.log(F.col("in_truth"))).alias("truth"),
        F.sum(F.col("n") * F.log(F.col("in_guess"))).alias("guess"),
    )
    whole = F.col("rows") * F.log(F.col("rows"))
    given_cluster = F.col("guess") - F.col("joint")
    given_label = F.col("truth") - F.col("joint")
    scored = facts.select(
        F.coalesce(1 - F.try_divide(given_cluster, whole - F.col("truth")), F.lit(1.0)).alias("homogeneity"),
        F.coalesce(1 - F.try_divide(given_label, whole - F.col("guess")), F.lit(1.0)).alias("completeness"),
    )
    h, c = F.col("homogeneity"), F.col("completeness")
    return scored.select("*", F.coalesce(F.try_divide(2 * h * c, h + c), F.lit(0.0)).alias("v_measure"))


def smoothed_cross_entropy(
    true_probability: Column, mean_log: Column, weight: Column, smoothing: float = 0.1
) -> Column:
    """Aggregate: class-weighted -ln p of the true class, smoothed by the mean -ln p of all."""
    return F.avg(
        F.lit(1 - smoothing) * weight * -F.log(true_probability) - F.lit(smoothing) * mean_log
    )


def score_summary(df: DataFrame, config: list[str], score: str) -> DataFrame:
    """Mean, population std and spread of fold scores per configuration."""
    return df.groupBy(*config).agg(
        F.avg(score).alias("mean_score"),
        F.stddev_pop(score).alias("std_score"),
        (F.max(score) - F.min(score)).alias("spread"),
        F.count(F.lit(1)).alias("folds"),
    )
