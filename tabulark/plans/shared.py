"""Inputs that several queries share, with their SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.functions.hashing import bucket32
from tabulark.operators.ensemble import long_predictions
from tabulark.operators.joins import lookup
from tabulark.plans import sqlbits
from tabulark.plans.sqlbits import ROW_ID
from tabulark.session import pin, read_table, spread

KEYS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
FOLDS = 5
FEATURES = ["quantity", "discount", "tax", "line"]


def line_items(spark: SparkSession, sf: str, whole: bool = True) -> DataFrame:
    """Line items with a row key, short names, a hold-out flag, a fold and the log target.

    ``whole`` says that every row will be worked on, not just a few.
    """
    li = read_table(spark, sf, "lineitem")
    if whole:
        li = spread(li, "l_orderkey")
    keyed = li.select(
        F.concat_ws("-", *KEYS, F.floor(F.col("l_extendedprice") * 100 + 0.5)).alias("row_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
        F.col("l_linenumber").alias("line"),
        F.col("l_extendedprice").alias("price"),
        "l_returnflag",
        "l_linestatus",
        "l_shipdate",
    )
    return keyed.withColumns(
        {
            "is_test": F.pmod(bucket32(["row_id"], "holdout"), F.lit(5)) == 0,
            "fold": F.pmod(bucket32(["row_id"], "fold"), F.lit(FOLDS)).cast("int"),
            "target": F.log1p("price"),
        }
    )


LINE_SQL = f"""WITH line AS (SELECT *, {sqlbits.bucket32('row_id', 'holdout')} % 5 = 0 AS is_test,
        {sqlbits.bucket32('row_id', 'fold')} % {FOLDS} AS fold, ln(1 + price) AS target
    FROM (SELECT {ROW_ID} AS row_id, l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
        l_linenumber::DOUBLE AS line, l_extendedprice AS price FROM lineitem))"""


def wide_store(li: DataFrame) -> DataFrame:
    """Row, price and one column per model: group means by line number, quantity and discount.

    One pass gives the means of all three. They are joined back under a size
    check, so a frequent value never pulls its rows into one window.
    """
    models = {"by_line": "line", "by_quantity": "quantity", "by_discount": "discount"}
    cells = [
        F.struct(F.lit(m).alias("model"), F.col(c).cast("double").alias("key")) for m, c in models.items()
    ]
    means = pin(
        li.select("price", F.explode(F.array(*cells)).alias("_c"))
        .groupBy("_c.model", "_c.key")
        .agg(F.avg("price").alias("mean"))
    )
    rows = li.select("row_id", "price", "line", "quantity", "discount")
    for model, col in models.items():
        # The key travels inside a struct, in which nulls are equal.
        table = means.where(F.col("model") == model).select(F.struct("key").alias("_key"), F.col("mean").alias(model))
        keyed = rows.withColumn("_key", F.struct(F.col(col).cast("double").alias("key")))
        rows = lookup(keyed, table, ["_key"], pinned=True).drop("_key")
    return rows.select("row_id", "price", *models)


def prediction_store(li: DataFrame) -> DataFrame:
    """The three models of :func:`wide_store` in long form, as they are stored."""
    return long_predictions(wide_store(li), ["row_id"], ["by_line", "by_quantity", "by_discount"])


CENTER_SQL = """WITH flat AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i
        FROM embeddings),
    centers AS (SELECT label AS class, i, avg(v) AS m FROM flat GROUP BY label, i),
    dists AS (SELECT f.vec_id, f.label, c.class, sqrt(sum((f.v - c.m)*(f.v - c.m))) AS d
        FROM flat f JOIN centers c ON f.i = c.i GROUP BY f.vec_id, f.label, c.class),
    raised AS (SELECT *, exp(-d - max(-d) OVER (PARTITION BY vec_id)) AS e FROM dists),
    probs AS (SELECT vec_id, label, class, d, e / sum(e) OVER (PARTITION BY vec_id) AS p FROM raised)"""
