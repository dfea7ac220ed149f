"""Queries on counts, summaries and facets."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulark.functions.numeric import clip
from tabulark.functions.recode import recode
from tabulark.operators import aggregate as agg
from tabulark.operators.classes import centroid_rows
from tabulark.plans.registry import query
from tabulark.plans.shared import line_items
from tabulark.session import read_table


@query("A1 O1", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type ORDER BY n DESC, event_type")
def event_type_counts(spark, sf):
    counted = agg.value_counts(read_table(spark, sf, "events"), ["event_type"])
    return counted.orderBy(F.desc("n"), "event_type")


@query(
    "A2 O1",
    """SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL
    ORDER BY n DESC, o_orderstatus, o_orderpriority""",
)
def combination_counts(spark, sf):
    cats = ["o_orderstatus", "o_orderpriority"]
    return agg.value_counts(read_table(spark, sf, "orders"), cats).orderBy(F.desc("n"), *cats)


@query(
    "A3",
    """SELECT l_quantity AS quantity, l_discount AS discount, l_tax AS tax,
        CASE l_returnflag WHEN 'A' THEN 'accepted' WHEN 'R' THEN 'returned' ELSE l_returnflag END AS flag,
        min(l_extendedprice) AS price FROM lineitem GROUP BY ALL""",
)
def collapsed_to_minimum(spark, sf):
    li = line_items(spark, sf).withColumn(
        "flag", recode(F.col("l_returnflag"), {"A": "accepted", "R": "returned"})
    )
    return agg.collapse_to_min(li, ["quantity", "discount", "tax", "flag"], "price")


DESCRIBED = ["quantity", "price", "discount", "tax"]


@query(
    "A4",
    " UNION ALL ".join(
        f"""SELECT '{n}' AS "column", count({c}) AS n, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
        min({c}) AS min, round(quantile_cont({c}, 0.25::DOUBLE), 6) AS q25,
        round(quantile_cont({c}, 0.5::DOUBLE), 6) AS q50, round(quantile_cont({c}, 0.75::DOUBLE), 6) AS q75,
        max({c}) AS max FROM lineitem"""
        for n, c in zip(DESCRIBED, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], strict=True)
    ),
)
def described_columns(spark, sf):
    table = agg.describe(line_items(spark, sf), DESCRIBED)
    rounded = [F.round(c, 6).alias(c) for c in ("mean", "std")]
    quart = [F.round(c, 6).alias(c) for c in ("q25", "q50", "q75")]
    return table.select("column", "n", *rounded, "min", *quart, "max")


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query(
    "A5",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END)::BIGINT AS nulls FROM orders"""
        for c in ORDER_COLUMNS
    ),
)
def null_counts(spark, sf):
    return agg.null_counts(read_table(spark, sf, "orders"))


PART_COLUMNS = ["p_brand", "p_name", "p_size", "p_type"]


@query(
    "A6",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS cardinality FROM part""" for c in PART_COLUMNS
    ),
)
def cardinalities(spark, sf):
    return agg.cardinalities(read_table(spark, sf, "part"), PART_COLUMNS)


@query("A6")
def approximate_cardinalities(spark, sf):
    return agg.approximate_cardinalities(read_table(spark, sf, "part"), PART_COLUMNS)


@query(
    "A7",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(DISTINCT {c}) AS cardinality,
        least(50, (count(DISTINCT {c}) + 1) // 2) AS width FROM part"""
        for c in PART_COLUMNS
    ),
)
def embedding_widths(spark, sf):
    sizes = agg.cardinalities(read_table(spark, sf, "part"), PART_COLUMNS)
    return sizes.withColumn("width", agg.embedding_size(F.col("cardinality")))


@query("A8", "SELECT DISTINCT md5(text) AS text_md5, lang FROM documents")
def duplicates_removed(spark, sf):
    """Whole-row de-duplication; the long text is replaced by its digest before the shuffle."""
    docs = read_table(spark, sf, "documents")
    return docs.select(F.md5("text").alias("text_md5"), "lang").dropDuplicates()


@query(
    "A9",
    """WITH c AS (SELECT value AS raw, greatest(least(value, 100.0::DOUBLE), 1.0::DOUBLE) AS clipped FROM events)
    SELECT 'clipped' AS "column", round(avg(clipped), 6) AS mean, round(median(clipped), 6) AS median FROM c
    UNION ALL SELECT 'raw', round(avg(raw), 6), round(median(raw), 6) FROM c""",
)
def clipped_mean_median(spark, sf):
    events = read_table(spark, sf, "events")
    both = events.select(F.col("value").alias("raw"), clip(F.col("value"), 1.0, 100.0).alias("clipped"))
    stats = agg.plain_statistics(both, ["raw", "clipped"])
    middle = agg.narrowed_quantiles(both, ["raw", "clipped"], {"median": 0.5}, stats)
    rows = [(s["column"], s["mean"], middle[s["column"]]["median"]) for s in stats]
    table = spark.createDataFrame(rows, "column string, mean double, median double")
    return table.select("column", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"))


@query(
    "A10",
    """WITH f AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) - 1 AS i FROM embeddings)
    SELECT label AS class, i AS position, round(avg(v), 6) AS mean FROM f GROUP BY label, i""",
)
def class_centroids(spark, sf):
    rows = centroid_rows(read_table(spark, sf, "embeddings"), "label", "embedding")
    return rows.select("class", F.col("position").cast("long").alias("position"), F.round("mean", 6).alias("mean"))


@query(
    "A11",
    """WITH c AS (SELECT quality, count(*) AS n FROM labels GROUP BY quality)
    SELECT quality, n, round((SELECT sum(n) FROM c)::DOUBLE / ((SELECT count(*) FROM c) * n), 8) AS weight FROM c""",
)
def balanced_class_weights(spark, sf):
    weights = agg.balanced_weights(read_table(spark, sf, "labels"), "quality")
    return weights.withColumn("weight", F.round("weight", 8))


@query(
    "A12",
    """WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
    c AS (SELECT least(floor((value - lo) / ((hi - lo) / 20)), 19)::BIGINT AS bin, count(*) AS n FROM events, e GROUP BY 1)
    SELECT b.bin, round(lo + b.bin * ((hi - lo) / 20), 6) AS low, coalesce(n, 0) AS n
    FROM (SELECT unnest(range(20)) AS bin) b CROSS JOIN e LEFT JOIN c ON b.bin = c.bin""",
)
def value_histogram(spark, sf):
    return agg.histogram(read_table(spark, sf, "events"), "value", 20).withColumn("low", F.round("low", 6))


@query(
    "A13",
    """SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'all' ELSE o_orderpriority END AS o_orderpriority,
        count(*) AS n FROM orders GROUP BY ROLLUP (o_orderpriority)""",
)
def facet_counts(spark, sf):
    return agg.facet_counts(read_table(spark, sf, "orders"), "o_orderpriority")


@query(
    "A17",
    """SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day,
        date_diff('day', min(o_orderdate), max(o_orderdate)) AS days FROM orders""",
)
def date_extent(spark, sf):
    return agg.date_extent(read_table(spark, sf, "orders"), "o_orderdate")


@query(
    "A18",
    """SELECT 'corpus_rows' AS fact, count(*) AS n FROM documents
    UNION ALL SELECT 'corpus_keys', count(DISTINCT doc_id) FROM documents
    UNION ALL SELECT 'label_rows', count(*) FROM labels
    UNION ALL SELECT 'labels_without_text', count(*) FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""",
)
def corpus_profile(spark, sf):
    return agg.corpus_profile(read_table(spark, sf, "documents"), read_table(spark, sf, "labels"), "doc_id")


@query(
    "W17",
    "SELECT o_orderkey, round(date_diff('day', o_orderdate, DATE '2002-01-01') / 365.0::DOUBLE, 8) AS years FROM orders",
)
def year_fractions(spark, sf):
    orders = read_table(spark, sf, "orders")
    days = F.datediff(F.lit("2002-01-01").cast("date"), F.col("o_orderdate"))
    return orders.select("o_orderkey", F.round(days / 365.0, 8).alias("years"))
