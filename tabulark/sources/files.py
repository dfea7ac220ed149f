"""CSV tables, corpora, prediction stores and fitted pipelines on files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabulark.functions.text import without_footer, without_header, without_quotes


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header; types are inferred only when no schema is given."""
    reader = spark.read.option("header", True).option("escape", '"')
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    return reader.schema(schema).csv(path)


def round_trip(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back under its own schema."""
    write_csv(df, path)
    return read_csv(df.sparkSession, path, df.schema)


def load_corpus(docs: DataFrame, category: str, chosen: list[str]) -> DataFrame:
    """Rows of the chosen categories; an empty list means all of them."""
    return docs.where(F.col(category).isin(chosen)) if chosen else docs


def cleaned_corpus(docs: DataFrame, text: str) -> DataFrame:
    """Messages without their header block, their footer block and quoted lines, in that order."""
    return docs.withColumn(text, without_quotes(without_footer(without_header(F.col(text)))))


def submission(ids: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Predictions attached to the ids by key, never by position."""
    return ids.select(key).join(predictions.select(key, "prediction"), key)


def write_predictions(long: DataFrame, path: str) -> None:
    """One folder per model, so a reader can take the models it wants."""
    long.write.mode("overwrite").partitionBy("model").parquet(path)


def read_predictions(spark: SparkSession, path: str, models: list[str]) -> DataFrame:
    """Stored predictions of the named models (partition pruning skips the others)."""
    return spark.read.parquet(path).where(F.col("model").isin(models))


def read_many(spark: SparkSession, paths: dict[str, str], schema: str) -> DataFrame:
    """One prediction file per model, stacked with the model name."""
    parts = [
        read_csv(spark, p, schema).withColumn("model", F.lit(name)) for name, p in paths.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)
