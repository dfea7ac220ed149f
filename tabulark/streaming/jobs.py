"""Structured Streaming forms of pricing and of windowed event statistics."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.session import fresh_folder


def file_stream(spark: SparkSession, folder: str, name: str, files_per_batch: int = 1_000) -> DataFrame:
    """Stream over the files of one table; the schema comes from the stored table."""
    path = f"{folder}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    # A pattern fits a table kept as one file and one kept as a folder of files.
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(f"{path}*")


def drained(stream: DataFrame, label: str) -> DataFrame:
    """Run the stream over everything there is and return what the file sink holds."""
    spark = stream.sparkSession
    out, state = fresh_folder(spark, label), fresh_folder(spark, f"{label}-state")
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", state)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def priced_stream(stream: DataFrame, price: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Stateless: every arriving contract row is priced by the batch expressions."""
    return price(stream)


def window_statistics(
    events: DataFrame, time: str, value: str, length: str, slide: str | None = None, late: str | None = None
) -> DataFrame:
    """Count, mean and sample std per event-time window; with ``late`` set, a watermark closes windows."""
    source = events
    if late:
        # A watermark needs an instant; plain date-times are read in the session's zone.
        source = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    window = F.window(time, length, slide) if slide else F.window(time, length)
    return (
        source.groupBy(window.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg(value).alias("mean_value"),
            F.stddev_samp(value).alias("std_value"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n", "mean_value", "std_value")
    )
