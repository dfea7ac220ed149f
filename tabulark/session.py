"""Session settings, table access and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabulark")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: The folder that holds this package.
ROOT = str(Path(__file__).resolve().parents[1])


def package_on_workers(spark: SparkSession) -> None:
    """Tell Python workers where this package lies, if they see the same disk; on a cluster it is installed."""
    found = spark.sparkContext.environment
    if ROOT not in found.get("PYTHONPATH", "").split(":"):
        found["PYTHONPATH"] = ":".join(filter(None, [found.get("PYTHONPATH"), ROOT]))


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A machine-local folder is used only when the session runs in local mode
    and nothing was set.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
            folder = tempfile.mkdtemp(prefix="tabulark-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path inside the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written rows.

    Row placement stays fixed afterwards, so a lost executor cannot change it.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


ROWS_PER_PART = 50_000


def pin_small(df: DataFrame, rows: int) -> DataFrame:
    """:func:`pin` for a table of at most about ``rows`` narrow rows, in as few files as that asks for.

    One that fits a single file says so to the planner, which then groups and
    joins it without any shuffle.
    """
    parts = max(1, min(shuffle_width(df.sparkSession), -(-rows // ROWS_PER_PART)))
    pinned = pin(df.coalesce(parts))
    return pinned.coalesce(1) if parts == 1 else pinned


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, key: str) -> DataFrame:
    """A scanned table on at least as many tasks as there are cores, for heavy per-row work.

    Big tables arrive in many splits and pass through untouched; only one that
    fits a few splits is redistributed.
    """
    if df.rdd.getNumPartitions() >= df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(key)
