"""Lines that many documents share, dropped by explode, hash, count and reassembly by position."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.llm.common import BLANKS, text_of, written


def normalised(line: Column) -> Column:
    """The line without ASCII white space at both ends and with A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), string.ascii_uppercase, string.ascii_lowercase)


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_keys(lines: Column, least_chars: int) -> Column:
    """A 128-bit hash per line; null where the normalised line is too short to be judged."""
    return F.transform(
        F.transform(lines, normalised),
        lambda n: F.when(
            F.length(n) >= least_chars,
            F.struct(F.xxhash64(n).alias("a"), F.xxhash64(F.lit(1), n).alias("b")),
        ),
    )


def drop_common_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least_chars: int = 40, least_docs: int = 5
) -> DataFrame:
    """``docs`` with shared lines removed from ``text``, plus ``n_lines`` and ``n_dropped``.

    A line is judged by its normalised form. One of at least ``least_chars``
    code points found in at least ``least_docs`` documents is dropped wherever
    it stands, except in the document with the largest key that holds it.
    ``n_lines`` counts the lines before dropping.

    Only hashes are shuffled to find the shared lines. The texts move once, to
    meet the positions that they lose.

    Defined cases: a null or empty text is one empty line, and an untouched
    null text stays null. A null key is one document that ranks below all
    others. Rows that repeat a key count as one document; each row is still
    returned with its own lines. Columns ``n_lines`` or ``n_dropped`` of the
    input are replaced; all other columns pass through unchanged.
    """
    rows = docs.select(
        F.col(key).alias("_key"),
        F.xxhash64(text_of(text)).alias("_hash"),
        text_of(text).alias("_text"),
        F.struct("*").alias("_row"),
    )
    found = (
        rows.select("_key", "_hash", F.posexplode(line_keys(split_lines(F.col("_text")), least_chars)).alias("_pos", "_line"))
        .where(F.col("_line").isNotNull())
        .select("_key", "_hash", "_pos", "_line.a", "_line.b")
    )
    # Written first, so that the join below shuffles both sides plainly and one
    # line's rows may be split over tasks.
    shared = written(
        found.groupBy("a", "b", "_key")
        .agg(F.first(F.lit(1)).alias("_one"))
        .groupBy("a", "b")
        .agg(F.count(F.lit(1)).alias("_n"), F.max(F.col("_key")).alias("_keep"))
        .where(F.col("_n") >= least_docs)
        .select("a", "b", "_keep"),
        "shared",
    )
    lost = (
        found.join(shared, ["a", "b"])
        .where(~F.col("_key").eqNullSafe(F.col("_keep")))
        .groupBy(F.col("_key").alias("_k"), F.col("_hash").alias("_h"))
        .agg(F.array_sort(F.collect_set("_pos")).alias("_lost"))
    )
    met = rows.join(lost, F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_hash") == F.col("_h")), "left")
    lines = split_lines(F.col("_text"))
    # Kept runs lie between lost positions: linear in lines plus losses.
    edges = F.concat(F.array(F.lit(-1)), F.col("_lost"), F.array(F.col("_total")))
    runs = F.transform(
        F.arrays_zip(F.slice("_edges", 1, F.size("_lost") + 1).alias("from"), F.slice("_edges", 2, F.size("_lost") + 1).alias("to")),
        lambda e: F.slice(F.col("_lines"), e["from"] + 2, e["to"] - e["from"] - 1),
    )
    keep = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped")]
    return (
        met.withColumn("_lines", lines)
        .withColumn("_total", F.size("_lines"))
        .withColumn("_edges", F.when(F.col("_lost").isNotNull(), edges))
        .select(
            *[F.col("_row").getField(c).alias(c) for c in docs.columns if c in keep],
            F.when(F.col("_lost").isNull(), F.col("_row").getField(text))
            .otherwise(F.array_join(F.flatten(runs), "\n"))
            .alias(text),
            F.col("_total").cast("long").alias("n_lines"),
            F.coalesce(F.size("_lost"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
