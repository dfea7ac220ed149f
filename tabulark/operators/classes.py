"""Class centroids, nearest-centroid probabilities and class distances on array features."""

from __future__ import annotations

import math

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.functions.numeric import array_sum, distance, double_matrix, let, softmax
from tabulark.operators.joins import bounded_rows

MOST_CLASSES = 1_000


def _class_means(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean vector per class; whole vectors are summed map-side, positions are never exploded."""
    dense = array_to_vector(F.col(vector).cast("array<double>"))
    return (
        df.groupBy(F.col(label).alias("class"))
        .agg(Summarizer.mean(dense).alias("_m"))
        .select("class", vector_to_array("_m").alias("center"))
    )


def centroid_rows(df: DataFrame, label: str, vector: str) -> DataFrame:
    """Mean of every vector position per class, long form (class, position, mean)."""
    return _class_means(df, label, vector).select("class", F.posexplode("center").alias("position", "mean"))


def centroids(df: DataFrame, label: str, vector: str, most: int = MOST_CLASSES) -> dict:
    """Class to mean vector, a bounded model on the driver."""
    rows = bounded_rows(_class_means(df, label, vector), most, label)
    return dict(sorted((r["class"], list(r["center"])) for r in rows))


def fold_centroids(df: DataFrame, label: str, vector: str, fold: str, most: int = MOST_CLASSES) -> dict[int, dict]:
    """Per fold the centroids of all other folds, from one aggregate; rows with a null fold belong to none."""
    dense = array_to_vector(F.col(vector).cast("array<double>"))
    parts = df.where(F.col(fold).isNotNull()).groupBy(F.col(fold).alias("fold"), F.col(label).alias("class")).agg(
        F.count(F.lit(1)).alias("n"), Summarizer.sum(dense).alias("_s")
    )
    rows = bounded_rows(parts.select("fold", "class", "n", vector_to_array("_s").alias("s")), most, f"{fold} and {label}")
    out = {}
    for i in sorted({r["fold"] for r in rows}):
        sums: dict = {}
        for r in rows:
            if r["fold"] != i:
                n, held = sums.get(r["class"], (0, [0.0] * len(r["s"])))
                sums[r["class"]] = (n + r["n"], [a + b for a, b in zip(held, r["s"], strict=True)])
        out[i] = {c: [x / n for x in held] for c, (n, held) in sorted(sums.items())}
    return out


def center_distances(vector: Column, centers: dict) -> Column:
    """Array of distances from a row's vector to every center, in class order."""
    return let(
        vector.cast("array<double>"),
        lambda v: F.transform(double_matrix(list(centers.values())), lambda c: distance(v, c)),
    )


def class_probabilities(vector: Column, centers: dict) -> Column:
    """Softmax of minus the distances."""
    return softmax(F.transform(center_distances(vector, centers), lambda d: -d))


def nearest_class(vector: Column, centers: dict) -> Column:
    """Class of the closest center; the first one wins a tie."""
    at = let(center_distances(vector, centers), lambda far: F.array_position(far, F.array_min(far)))
    return F.array(*[F.lit(c) for c in centers])[(at - 1).cast("int")]


def ranked_classes(probabilities: Column, classes: list, k: int) -> Column:
    """The ``k`` most probable classes in order; equal values take the earlier class."""
    pairs = F.transform(probabilities, lambda p, i: F.struct((-p).alias("p"), i.alias("i")))
    names = F.array(*[F.lit(c) for c in classes])
    return F.transform(F.slice(F.sort_array(pairs), 1, k), lambda s: names[s["i"]])


def true_rank(probabilities: Column, position: Column) -> Column:
    """Place of the class at zero-based ``position`` when classes are ordered by probability."""
    return let(
        F.element_at(probabilities, position + 1),
        lambda mine: F.size(
            F.filter(probabilities, lambda p, i: (p > mine) | ((p == mine) & (i < position)))
        )
        + 1,
    )


def class_distance_matrix(centers: dict) -> list[list[float]]:
    """Euclidean distance between every two class centers over the largest one, 0 on the diagonal."""
    vectors = list(centers.values())
    raw = [[math.dist(a, b) for b in vectors] for a in vectors]
    largest = max((v for row in raw for v in row), default=0.0) or 1.0
    return [[v / largest for v in row] for row in raw]


def class_distance_rows(df: DataFrame, centers: dict) -> DataFrame:
    """Long form (class_a, class_b, dist) of the distance matrix."""
    spark = df.sparkSession
    names = F.array(*[F.lit(c) for c in centers])
    matrix = double_matrix(class_distance_matrix(centers))
    return (
        spark.range(1)
        .select(F.posexplode(matrix).alias("a", "row"))
        .select("a", F.posexplode("row").alias("b", "dist"))
        .select(names[F.col("a")].alias("class_a"), names[F.col("b")].alias("class_b"), "dist")
    )


def expected_distance(probabilities: Column, position: Column, matrix: list[list[float]]) -> Column:
    """Sum over classes of p times the distance from the true class."""
    row = F.element_at(double_matrix(matrix), position + 1)
    return array_sum(F.zip_with(probabilities, row, lambda p, d: p * d))


def class_position(label: Column, classes: list) -> Column:
    """Zero-based place of the label in the class list."""
    return (F.array_position(F.array(*[F.lit(c) for c in classes]), label) - 1).cast("int")


def lloyd_step(df: DataFrame, vector: str, centers: dict) -> DataFrame:
    """One k-means step: assign every row to its nearest center, then average per center."""
    assigned = df.select(nearest_class(F.col(vector), centers).alias("_c"), vector)
    return centroid_rows(assigned, "_c", vector)
