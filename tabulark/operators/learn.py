"""Spark ML models inside folds, and the tables that describe them."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.clustering import LDA, KMeans
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import (
    Bucketizer,
    CountVectorizerModel,
    OneHotEncoder,
    StringIndexer,
    VectorAssembler,
    VectorSlicer,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabulark.operators.logistic import class_shares
from tabulark.session import pin


def assembled(df: DataFrame, features: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol="features").transform(df)


#: Bins that tree learners cut a number into, and rows from which they take the cuts at least.
TREE_BINS, CUT_ROWS = 32, 10_000


def learner_cuts(values: np.ndarray, bins: int = TREE_BINS) -> tuple[float, ...]:
    """The cuts that Spark's tree learners take from these values: between all if they are few, else at even shares."""
    found, counts = np.unique(values, return_counts=True)
    middles = (found[:-1] + found[1:]) / 2
    if len(found) <= bins:
        return tuple(middles.tolist())
    stride = len(values) / bins
    wanted, reached, cuts = stride, counts[0], []
    for i in range(1, len(found)):
        before, reached = reached, reached + counts[i]
        if abs(before - wanted) < abs(reached - wanted):
            cuts.append(float(middles[i - 1]))
            wanted += stride
    return tuple(cuts)


def with_bins(df: DataFrame, names: list[str], cuts: list[tuple[float, ...]], made: list[str]) -> DataFrame:
    """Columns ``made``: how many of its cuts lie below the value of each of ``names``; NaN is an error."""
    cut = [i for i, c in enumerate(cuts) if c]
    out = df.withColumns({made[i]: F.col(names[i]) * 0.0 for i in range(len(names)) if not cuts[i]})
    if not cut:
        return out
    # A value that equals a cut belongs below it, to Bucketizer's left.
    edges = [[-math.inf, *np.nextafter(cuts[i], math.inf).tolist(), math.inf] for i in cut]
    return Bucketizer(splitsArray=edges, inputCols=[names[i] for i in cut], outputCols=[made[i] for i in cut]).transform(out)


@dataclass(frozen=True)
class BinnedTrees:
    """Boosted trees over the bins of the features, and the cuts of each feature."""

    model: GBTRegressionModel
    cuts: tuple[tuple[float, ...], ...]

    def scored(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, which has the vector ``features``, with one more column."""
        values, bins = ([f"_{kind}{k}" for k in range(len(self.cuts))] for kind in ("value", "bin"))
        plain = df.withColumn("_values", vector_to_array("features"))
        plain = plain.withColumns({v: F.col("_values")[k] for k, v in enumerate(values)})
        ready = VectorAssembler(inputCols=bins, outputCol="_bins").transform(with_bins(plain, values, list(self.cuts), bins))
        own = self.model.copy({self.model.featuresCol: "_bins", self.model.predictionCol: name})
        return own.transform(ready).select(*df.columns, name)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.scored(df, "prediction")


@dataclass(frozen=True)
class Cells:
    """Rows summed up by fold model, by whether the model may see them, and by the bins of their features.

    A tree learner sees a row only as its bins, its weight and its label, and
    the squared error takes equal bins together: their count and mean give the
    trees that the rows give. So a fit goes over at most ``bins`` to the power of
    the features cells, however many rows there are, and never over more cells than rows.
    """

    rows: DataFrame
    cuts: tuple[tuple[tuple[float, ...], ...], ...]
    sizes: dict[tuple[int, bool], int]

    def of(self, i: int, held: bool) -> DataFrame:
        bins = [f"_bin{k}" for k in range(len(self.cuts[i]))]
        own = self.rows.where((F.col("_model") == i) & (F.col("_held") == held))
        return VectorAssembler(inputCols=bins, outputCol="features").transform(own).select("features", "_n", "_mean", "_spread")

    def fitted(self, i: int, rounds: int, depth: int) -> BinnedTrees:
        """Boosted trees of the rows outside fold ``i``."""
        # So many bins are allowed that the learner looks at every cell for its cuts, which are those between the bins.
        bins = max(TREE_BINS, math.isqrt(self.sizes.get((i, False), 0)) + 1)
        learner = GBTRegressor(labelCol="_mean", weightCol="_n", maxIter=rounds, maxDepth=depth, maxBins=bins, seed=42)
        return BinnedTrees(learner.fit(self.of(i, False)), self.cuts[i])


def cells_of_folds(df: DataFrame, features: list[str], target: str, fold: str, folds: int, counts: dict, held: bool = False) -> Cells:
    """The :class:`Cells` of ``folds`` models in one pass over the rows; ``held`` adds those of each fold's own rows.

    ``counts`` has the rows of each fold, and at None of all. Each model has
    cuts of its own, taken as the learner takes them: from all its rows, or from
    so many drawn ones as it draws. Rows are read three times in all and not written.
    """
    values = [f"_value{k}" for k in range(len(features))]
    given = df.where(F.col(fold).isNotNull())
    numbers = [F.col(f).cast("double").alias(v) for f, v in zip(features, values, strict=True)]
    least = min([counts[None] - counts[i] for i in range(folds) if counts[None] > counts[i]], default=0)
    share = max(TREE_BINS**2, CUT_ROWS) / max(least, 1)
    drawn = given.select(F.col(fold).alias("_fold"), *numbers)
    seen = (drawn.sample(share, seed=42) if share < 1 else drawn).toPandas()
    cuts = tuple(tuple(learner_cuts(seen.loc[seen["_fold"] != i, v].dropna().to_numpy(float)) for v in values) for i in range(folds))
    # Folds mostly have some cuts in common; each list is looked up once a row.
    lists = list(dict.fromkeys((v, c) for own in cuts for v, c in zip(values, own, strict=True)))
    names = {x: f"_cut{j}" for j, x in enumerate(lists)}
    label = F.col(target).cast("double")
    good = label.isNotNull() & ~F.isnan(label) & (F.abs(label) < math.inf)
    checked = F.when(good, label).otherwise(F.raise_error(F.lit("labels must be numbers, neither null nor NaN nor infinite")))
    binned = with_bins(
        given.select(F.col(fold).alias("_fold"), checked.alias("_label"), *numbers), [v for v, _ in lists], [c for _, c in lists], list(names.values())
    )

    def cell(i: int):
        own = F.struct(
            F.lit(i).alias("_model"), (F.col("_fold") == i).alias("_held"),
            *[F.col(names[v, c]).alias(f"_bin{k}") for k, (v, c) in enumerate(zip(values, cuts[i], strict=True))],
        )
        return own if held else F.when(F.col("_fold") != i, own)

    each = binned.select("_label", F.explode(F.array(*[cell(i) for i in range(folds)])).alias("_c")).where(F.col("_c").isNotNull())
    keys = ["_model", "_held", *[f"_bin{k}" for k in range(len(features))]]
    summed = each.select("_label", *[F.col(f"_c.{k}").alias(k) for k in keys]).groupBy(*keys).agg(
        F.count(F.lit(1)).cast("double").alias("_n"), F.avg("_label").alias("_mean"), F.var_pop("_label").alias("_spread")
    )
    rows = pin(summed)
    sizes = {(r["_model"], r["_held"]): r["n"] for r in rows.groupBy("_model", "_held").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Cells(rows, cuts, sizes)


def fold_counts(df: DataFrame, fold: str, folds: int) -> dict:
    """Rows of each fold, and at None of all rows that have one."""
    found = df.agg(F.count(fold).alias("n"), *[F.count_if(F.col(fold) == i).alias(f"n{i}") for i in range(folds)]).first()
    return {None: found["n"]} | {i: found[f"n{i}"] for i in range(folds)}


def boosted_folds(
    df: DataFrame, features: list[str], target: str, fold: str, folds: int, rounds: int = 10, depth: int = 4
) -> tuple[list[BinnedTrees], DataFrame]:
    """One boosted-tree model per fold and the predictions for the rows it did not see.

    The models are fitted side by side on :class:`Cells`; ``df`` is read again
    for the scores and has to give the same rows each time.
    """
    cells = cells_of_folds(df, features, target, fold, folds, fold_counts(df, fold, folds))
    models = _fitted_in_parallel([lambda i=i: cells.fitted(i, rounds, depth) for i in range(folds)], folds)
    ready = assembled(df, features)
    scored = [m.scored(ready.where(F.col(fold) == i), "prediction") for i, m in enumerate(models)]
    return models, reduce(lambda a, b: a.unionByName(b), scored).drop("features")


def with_categories(df: DataFrame, numbers: list[str], categories: list[str]) -> DataFrame:
    """``df`` with ``features``: numbers, and categories as indices that tree learners split as sets.

    A value without an index, such as null, has an index of its own.
    """
    indexed = [f"_{c}_index" for c in categories]
    stages = [StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep")] if categories else []
    stages.append(VectorAssembler(inputCols=[*numbers, *indexed], outputCol="features"))
    return Pipeline(stages=stages).fit(df).transform(df).drop(*indexed)


@dataclass(frozen=True)
class Boosted:
    """Boosting in blocks of rounds; of each block the first ``used`` rounds count.

    ``curve`` lists (round, training error, validation error) of every round tried.
    """

    blocks: tuple[GBTRegressionModel, ...]
    used: tuple[int, ...]
    curve: tuple[tuple[int, float, float], ...]

    @property
    def best(self) -> int:
        return sum(self.used)

    def scored(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, which has ``features``, with one more column."""
        made, parts = df, []
        for k, (block, used) in enumerate(zip(self.blocks, self.used, strict=True)):
            if used == block.getNumTrees:
                made = block.copy({block.predictionCol: f"_b{k}"}).transform(made)
                parts.append(F.col(f"_b{k}"))
                continue
            for i, (tree, weight) in enumerate(zip(block.trees[:used], block.treeWeights[:used], strict=True)):
                made = tree.copy({tree.predictionCol: f"_b{k}_{i}"}).transform(made)
                parts.append(F.col(f"_b{k}_{i}") * weight)
        total = reduce(lambda a, b: a + b, parts, F.lit(0.0))
        return made.withColumn(name, total).select(*df.columns, name)


def boosted_with_patience(
    train: DataFrame, valid: DataFrame, target: str, rounds: int = 1000, patience: int = 100, block: int = 25,
    depth: int = 6, step: float = 0.1, bins: int = 64,
) -> Boosted:
    """Boosted trees until the error on ``valid`` has not fallen for ``patience`` rounds, cut back to the best one.

    ``block`` rounds are fitted at a time, on what the earlier blocks left; the
    rests are written, so no round goes through earlier trees again. Without
    validation rows all rounds are taken. Both tables have ``features``.
    """
    left, right = ([df.select("features", F.col(target).cast("double").alias("_rest"))] for df in (train, valid))
    judged = not valid.isEmpty()
    blocks: list[GBTRegressionModel] = []
    curve: list[tuple[int, float, float]] = []
    best, least = 0, math.inf
    while len(curve) < rounds:
        n = min(block, rounds - len(curve))
        model = GBTRegressor(labelCol="_rest", maxIter=n, maxDepth=depth, stepSize=step, maxBins=bins, seed=42 + len(curve)).fit(left[0])
        seen = model.evaluateEachIteration(left[0], "squared")
        errors = model.evaluateEachIteration(right[0], "squared") if judged else [math.nan] * len(seen)
        for here, there in zip(seen, errors, strict=True):
            curve.append((len(curve) + 1, float(here), float(there)))
            if not judged or there < least:
                best, least = len(curve), there
        blocks.append(model)
        if len(curve) - best >= patience or len(curve) >= rounds:
            break
        for side in (left, right):
            rest = F.col("_rest") - F.col("prediction")
            side[0] = pin(model.transform(side[0]).select("features", rest.alias("_rest")))
    used, start = [], 0
    for model in blocks:
        used.append(max(0, min(model.getNumTrees, best - start)))
        start += model.getNumTrees
    kept = [(m, u) for m, u in zip(blocks, used, strict=True) if u]
    return Boosted(tuple(m for m, _ in kept), tuple(u for _, u in kept), tuple(curve))


def patient_folds(
    df: DataFrame, numbers: list[str], categories: list[str], target: str, fold: str, folds: int, parallelism: int = 5, **settings
) -> tuple[dict[int, Boosted], DataFrame]:
    """Per fold a model that stops early on the fold itself, as the rows scored by it do; and those scores.

    The rows are written once, with their features. ``settings`` go to
    :func:`boosted_with_patience`.
    """
    ready = pin(with_categories(df, numbers, categories))

    def job(i: int):
        train, valid = ready.where(F.col(fold) != i), ready.where(F.col(fold) == i)
        return lambda: boosted_with_patience(train, valid, target, **settings)

    models = dict(enumerate(_fitted_in_parallel([job(i) for i in range(folds)], parallelism)))
    parts = [m.scored(ready.where(F.col(fold) == i), "prediction") for i, m in models.items()]
    return models, reduce(lambda a, b: a.unionByName(b), parts).drop("features")


def forest_regression_folds(
    df: DataFrame, numbers: list[str], categories: list[str], target: str, fold: str, folds: int, trees: int = 40, depth: int = 10
) -> DataFrame:
    """Every row with the prediction of a random forest that was fitted on the other folds."""
    ready = pin(with_categories(df, numbers, categories))

    def job(i: int):
        own = ready.where(F.col(fold) != i)
        return lambda: RandomForestRegressor(labelCol=target, numTrees=trees, maxDepth=depth, maxBins=64, seed=42).fit(own)

    models = _fitted_in_parallel([job(i) for i in range(folds)], folds)
    parts = [m.transform(ready.where(F.col(fold) == i)) for i, m in enumerate(models)]
    return reduce(lambda a, b: a.unionByName(b), parts).drop("features")


def selected_with_trees(
    train: DataFrame, valid: DataFrame, start: list[str], candidates: list[str], target: str,
    rounds: int = 20, depth: int = 4, step: float = 0.1, parallelism: int = 4,
) -> list[tuple[int, str, float, bool]]:
    """Forward selection with boosted trees: a candidate stays if it lowers the error on ``valid``.

    Both tables are assembled and written once; every fit takes a slice of the
    same vector. ``parallelism`` candidates are tried side by side on top of
    what is kept; those behind one that stays are tried again on top of it, so
    the trace is that of one at a time. Returns (step, candidate, rmse, kept);
    step 0 is the starting set. Ties go to the smaller set.
    """
    names = [*start, *candidates]
    if len(set(names)) < len(names):
        raise ValueError("a column is named twice")

    def layout(df: DataFrame) -> DataFrame:
        return pin(VectorAssembler(inputCols=names, outputCol="_all").transform(df).select("_all", F.col(target).cast("double").alias("_y")))

    seen, judge = layout(train), layout(valid)
    measure = RegressionEvaluator(labelCol="_y", metricName="rmse")

    def job(kept: list[str]):
        def error() -> float:
            pick = VectorSlicer(inputCol="_all", outputCol="features", indices=[names.index(n) for n in kept])
            learner = GBTRegressor(labelCol="_y", maxIter=rounds, maxDepth=depth, stepSize=step, seed=42)
            model = learner.fit(pick.transform(seen).select("features", "_y"))
            return float(measure.evaluate(model.transform(pick.transform(judge))))

        return error

    kept, best = list(start), job(start)()
    trace = [(0, "", best, True)]
    at = 0
    while at < len(candidates):
        tried = candidates[at : at + parallelism]
        errors = _fitted_in_parallel([job([*kept, c]) for c in tried], parallelism)
        for c, e in zip(tried, errors, strict=True):
            at += 1
            trace.append((at, c, e, e < best))
            if e < best:
                kept, best = [*kept, c], e
                break
    return trace


def searched_classifiers(
    df: DataFrame, features: list[str], label: str, fold: str, folds: int, points: list[dict[str, float]], parallelism: int = 8
) -> list[float]:
    """Per point of parameters the loss of boosted classifiers: 1 - mean accuracy over the held-out folds.

    Points hold ``depth``, ``rounds``, ``step`` and ``share`` (of the rows that
    a round sees). The rows are assembled and written once; all fits read them,
    some side by side. Rows with a null feature, label or fold take no part; a
    fold without rows counts for nothing.
    """
    whole = df.select(*features, F.col(label).cast("double").alias("_y"), fold).na.drop()
    ready = pin(assembled(whole, features).select("features", "_y", fold))
    held = [r[fold] for r in ready.select(fold).distinct().collect() if 0 <= r[fold] < folds]

    def job(point: dict[str, float], i: int):
        def accuracy() -> float:
            learner = GBTClassifier(
                labelCol="_y", maxDepth=int(point["depth"]), maxIter=int(point["rounds"]),
                stepSize=point["step"], subsamplingRate=point["share"], seed=42,
            )
            model = learner.fit(ready.where(F.col(fold) != i))
            hits = model.transform(ready.where(F.col(fold) == i)).agg(F.avg((F.col("prediction") == F.col("_y")).cast("double")))
            return float(hits.first()[0])

        return accuracy

    found = iter(_fitted_in_parallel([job(p, i) for p in points for i in held], parallelism))
    return [1.0 - sum(next(found) for _ in held) / len(held) if held else math.nan for _ in points]


def fold_curves(spark, models: dict[int, Boosted]) -> DataFrame:
    """(fold, part, iteration, mse) of every round that was tried."""
    rows = [
        (i, part, n, error)
        for i, m in models.items()
        for n, here, there in m.curve
        for part, error in (("train", here), ("valid", there))
    ]
    return spark.createDataFrame(rows, "fold int, part string, iteration int, mse double")


def mean_of_models(models: list[BinnedTrees], df: DataFrame, features: list[str], key: list[str]) -> DataFrame:
    """Mean prediction of the fold models; each model adds one column, so nothing is shuffled."""
    ready = assembled(df, features)
    for i, model in enumerate(models):
        ready = model.scored(ready, f"_p{i}")
    mean = reduce(lambda a, b: a + b, [F.col(f"_p{i}") for i in range(len(models))])
    return ready.select(*key, (mean / len(models)).alias("prediction"))


def boosted_early_stop(
    df: DataFrame, features: list[str], target: str, valid: str, rounds: int = 20, tolerance: float = 0.01
) -> GBTRegressionModel:
    """Boosting that ends when the validation rows (flag column) stop improving."""
    learner = GBTRegressor(
        labelCol=target, maxIter=rounds, maxDepth=3, seed=42,
        validationIndicatorCol=valid, validationTol=tolerance,
    )
    return learner.fit(assembled(df, features))


def learning_curve(model: GBTRegressionModel, parts: dict[str, DataFrame], features: list[str]) -> DataFrame:
    """(part, iteration, error) rows: mean squared error after every boosting round."""
    rows = [
        (name, i + 1, float(v))
        for name, df in parts.items()
        for i, v in enumerate(model.evaluateEachIteration(assembled(df, features), "squared"))
    ]
    spark = next(iter(parts.values())).sparkSession
    return spark.createDataFrame(rows, "part string, iteration int, mse double")


def importances(spark, model, features: list[str]) -> DataFrame:
    rows = [(f, float(v)) for f, v in zip(features, model.featureImportances.toArray(), strict=True)]
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(
        F.desc("importance"), "feature"
    )


def binary_boosted(
    train: DataFrame, unseen: DataFrame, features: list[str], label: str, rounds: int = 20
) -> DataFrame:
    """Probability of class 1 for ``unseen`` rows, from a boosted classifier fitted on ``train``."""
    model = GBTClassifier(labelCol=label, maxIter=rounds, maxDepth=3, seed=42).fit(assembled(train, features))
    scored = model.transform(assembled(unseen, features))
    return scored.withColumn("score", vector_to_array("probability")[1]).drop(
        "features", "rawPrediction", "probability"
    )


def _fitted_in_parallel(jobs: list, parallelism: int) -> list:
    """The results of small fits, some at a time; each leaves most cores idle."""
    with ThreadPool(parallelism) as pool:
        return pool.map(lambda job: job(), jobs)


def boosted_class_folds(
    df: DataFrame, features: list[str], label: str, classes: list, fold: str, folds: int,
    rounds: int = 20, depth: int = 3, parallelism: int = 4,
) -> dict[int, list[GBTClassificationModel]]:
    """Per fold one boosted classifier for each class against the rest, fitted on the other folds."""
    ready = pin(assembled(df.select(*features, label, fold), features).select("features", label, fold))

    def job(i: int, c):
        own = ready.where(F.col(fold) != i).select("features", (F.col(label) == c).cast("double").alias("_own"))
        return lambda: GBTClassifier(labelCol="_own", maxIter=rounds, maxDepth=depth, seed=42).fit(own)

    pairs = [(i, c) for i in range(folds) for c in classes]
    found = dict(zip(pairs, _fitted_in_parallel([job(i, c) for i, c in pairs], parallelism), strict=True))
    return {i: [found[i, c] for c in classes] for i in range(folds)}


def _with_shares(ready: DataFrame, models: list[GBTClassificationModel], name: str) -> DataFrame:
    """Adds the one-against-rest probabilities, made to add up to one; each model adds one column."""
    made = ready
    for k, m in enumerate(models):
        made = m.copy({m.predictionCol: f"_y{k}", m.rawPredictionCol: f"_r{k}", m.probabilityCol: f"_q{k}"}).transform(made)
    shares = class_shares([vector_to_array(f"_q{k}")[1] for k in range(len(models))])
    return made.withColumn(name, shares).drop(*[f"_{x}{k}" for k in range(len(models)) for x in "yrq"])


def class_probabilities_out_of_fold(
    df: DataFrame, features: list[str], fold: str, models: dict[int, list[GBTClassificationModel]]
) -> DataFrame:
    """``df`` with column ``probs``: each row scored by the models of its fold, which did not see it."""
    ready = assembled(df, features)
    parts = [_with_shares(ready.where(F.col(fold) == i), own, "probs") for i, own in models.items()]
    return reduce(lambda a, b: a.unionByName(b), parts).drop("features")


def mean_class_probabilities(
    df: DataFrame, features: list[str], models: dict[int, list[GBTClassificationModel]]
) -> DataFrame:
    """``df`` with column ``probs``: the mean of the folds' probabilities, for rows that no model saw."""
    made = assembled(df, features)
    for i, own in models.items():
        made = _with_shares(made, own, f"_fold{i}")
    names = [f"_fold{i}" for i in models]
    total = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y), [F.col(n) for n in names])
    return made.withColumn("probs", F.transform(total, lambda x: x / len(names))).drop("features", *names)


def forest_folds(df: DataFrame, vector: str, label: str, fold: str, folds: int, trees: int = 20) -> DataFrame:
    """Every row with the class probabilities of a random forest that was fitted on the other folds."""
    parts = [
        forest_probabilities(df.where(F.col(fold) != i), df.where(F.col(fold) == i), vector, label, trees) for i in range(folds)
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def binary_boosted_folds(
    df: DataFrame, features: list[str], label: str, fold: str, folds: int, rounds: int = 20
) -> DataFrame:
    """Every row with the score of a boosted classifier that was fitted on the other folds."""
    parts = [
        binary_boosted(df.where(F.col(fold) != i), df.where(F.col(fold) == i), features, label, rounds) for i in range(folds)
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


def forest_probabilities(
    train: DataFrame, unseen: DataFrame, vector: str, label: str, trees: int = 20
) -> DataFrame:
    """Class probabilities for ``unseen`` rows, from a random forest fitted on an array column of ``train``."""

    def ready(df: DataFrame) -> DataFrame:
        return df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))

    model = RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=5, seed=42).fit(ready(train))
    return model.transform(ready(unseen)).withColumn("probabilities", vector_to_array("probability")).drop(
        "features", "rawPrediction", "probability"
    )


def boosted_grid(
    df: DataFrame, features: list[str], target: str, fold: str, folds: int,
    depths: list[int], rounds: list[int], parallelism: int = 4,
) -> DataFrame:
    """Grid search over given folds: parameters, mean RMSE and rank of every point.

    Every point is fitted and judged on :class:`Cells`; the error of a cell is
    that of its mean and the spread of its rows.
    """
    counts = fold_counts(df, fold, folds)
    if df.count() != sum(counts[i] for i in range(folds)):
        raise ValueError(f"folds have to be numbers from 0 to {folds - 1}")
    for i in range(folds):
        if not 0 < counts[i] < counts[None]:
            raise ValueError(f"the training or the validation data of fold {i} is empty")
    cells = cells_of_folds(df, features, target, fold, folds, counts, held=True)

    def job(depth: int, n: int, i: int):
        def error() -> float:
            judged = cells.fitted(i, n, depth).model.transform(cells.of(i, True))
            squares = F.col("_n") * ((F.col("_mean") - F.col("prediction")) ** 2 + F.col("_spread"))
            return float(judged.agg(F.sqrt(F.sum(squares) / F.sum("_n"))).first()[0])

        return error

    points = [(d, n) for d in depths for n in rounds]
    errors = iter(_fitted_in_parallel([job(d, n, i) for d, n in points for i in range(folds)], parallelism))
    rows = []
    for d, n in points:
        own = [next(errors) for _ in range(folds)]
        rows.append((d, n, float(np.mean(own)), float(np.std(own))))
    return df.sparkSession.createDataFrame(rows, "max_depth int, rounds int, rmse double, std double")


def fold_accuracy(scored: DataFrame, label: str) -> float:
    return MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(scored)


def feature_pipeline(categories: list[str], numbers: list[str]) -> Pipeline:
    """Index, one-hot and assemble; unseen categories get their own slot."""
    indexed = [f"{c}_index" for c in categories]
    return Pipeline(
        stages=[
            StringIndexer(inputCols=categories, outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=[f"{c}_hot" for c in categories], dropLast=False),
            VectorAssembler(inputCols=[*numbers, *[f"{c}_hot" for c in categories]], outputCol="features"),
        ]
    )


def saved_and_loaded(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def fitted_clusters(df: DataFrame, vector: str, k: int, rounds: int = 100) -> tuple[list[list[float]], DataFrame]:
    """The centers of k-means, and ``df`` with the cluster of each row."""
    ready = df.withColumn("features", array_to_vector(F.col(vector).cast("array<double>")))
    model = KMeans(k=k, maxIter=rounds, seed=0, initMode="k-means||").fit(ready)
    centers = [[float(x) for x in c] for c in model.clusterCenters()]
    return centers, model.transform(ready).drop("features").withColumnRenamed("prediction", "cluster")


def kmeans_clusters(df: DataFrame, vector: str, k: int, rounds: int = 100) -> DataFrame:
    return fitted_clusters(df, vector, k, rounds)[1]


def term_vectors(docs: DataFrame, tokens: str, vocabulary: list[str]) -> DataFrame:
    """Sparse count vectors over a fixed vocabulary."""
    model = CountVectorizerModel.from_vocabulary(vocabulary, inputCol=tokens, outputCol="features")
    return model.transform(docs)


def fit_topics(vectors: DataFrame, topics: int = 10, rounds: int = 10, seed: int = 100):
    return LDA(k=topics, maxIter=rounds, optimizer="online", seed=seed).fit(vectors)


def topic_terms(model, vocabulary: list[str], spark, terms: int = 5) -> DataFrame:
    """(topic, rank, term, weight) of the strongest terms of every topic."""
    rows = [
        (r["topic"], i + 1, vocabulary[t], float(w))
        for r in model.describeTopics(terms).collect()
        for i, (t, w) in enumerate(zip(r["termIndices"], r["termWeights"], strict=True))
    ]
    return spark.createDataFrame(rows, "topic int, rank int, term string, weight double")


def topic_mix(model, vectors: DataFrame, key: str) -> DataFrame:
    """(document, topic, share) rows."""
    mixed = model.transform(vectors)
    return mixed.select(
        key, F.posexplode(vector_to_array("topicDistribution")).alias("topic", "share")
    )


def main_topics(mix: DataFrame, key: str, terms: DataFrame) -> DataFrame:
    """Strongest topic per document, its share to four places and its keywords."""
    best = mix.groupBy(key).agg(
        F.max_by("topic", F.struct("share", -F.col("topic"))).alias("topic"),
        F.round(F.max("share"), 4).alias("share"),
    )
    words = terms.groupBy("topic").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("rank", "term"))), lambda s: s["term"]), ", ").alias("keywords")
    )
    return best.join(F.broadcast(words), "topic")
