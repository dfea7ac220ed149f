"""Helpers shared by the operators of this package."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.session import fresh_folder, read_table

BLANKS = " \t\n\x0b\x0c\r"
BLANK_CLASS = r"[\x20\x09-\x0D]"


ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The table; Python workers are told where this package lies, if they see the same disk."""
    found = spark.sparkContext.environment
    if ROOT not in found.get("PYTHONPATH", "").split(":"):
        found["PYTHONPATH"] = ":".join(filter(None, [found.get("PYTHONPATH"), ROOT]))
    return read_table(spark, folder, name)


def text_of(column: str) -> Column:
    """The text, an absent one as the empty string."""
    return F.coalesce(F.col(column), F.lit(""))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as compressed Parquet into the shared folder and go on from the files."""
    path = fresh_folder(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def word_count(text: Column) -> Column:
    """Number of maximal runs of characters other than ASCII white space; null counts 0."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, BLANK_CLASS + "+", -1))).cast("long")
