"""Queries on joins, encoders, sampling and generated features."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import functions as F

from tabulark.functions.hashing import digest
from tabulark.functions.numeric import tidy
from tabulark.operators import aggregate as agg
from tabulark.operators import features as feat
from tabulark.operators import sampling, scale
from tabulark.operators.classes import centroids, class_distance_rows
from tabulark.operators.ensemble import bound_columns, wide_predictions
from tabulark.operators.joins import lookup
from tabulark.operators.project import paired_difference
from tabulark.plans.registry import query
from tabulark.plans.shared import FEATURES, LINE_SQL, line_items, prediction_store
from tabulark.plans.preparation import STORE_SQL
from tabulark.plans.sqlbits import ROW_ID, bucket32
from tabulark.plans.sqlbits import digest as digest_sql
from tabulark.plans.sqlbits import tidy as tidy_sql
from tabulark.session import pin, read_table

# Joins and lookups

BRAND_LEVELS = 25
TYPES = ["ECONOMY", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


def pair_scores() -> list[tuple[str, str, float]]:
    """A score table with gaps, made from a rule: every third pair is left out."""
    return [
        (f"Brand#{b}", t, round(0.2 + ((b * 7 + i * 3) % 9) / 10, 1))
        for b in range(1, BRAND_LEVELS + 1)
        for i, t in enumerate(TYPES)
        if (b + i) % 3
    ]


PAIR_SQL = ", ".join(f"('{b}', '{t}', {s}::DOUBLE)" for b, t, s in pair_scores())


@query(
    "J1",
    f"""SELECT p_partkey, coalesce(score, 0.5::DOUBLE) AS score FROM part
    LEFT JOIN (VALUES {PAIR_SQL}) s(b, t, score) ON p_brand = b AND p_type = t""",
)
def pair_lookup_score(spark, sf):
    """The score table is a literal of fixed size, so its broadcast is bounded."""
    table = spark.createDataFrame(pair_scores(), "p_brand string, p_type string, score double")
    joined = read_table(spark, sf, "part").join(F.broadcast(table), ["p_brand", "p_type"], "left")
    return joined.select("p_partkey", F.coalesce("score", F.lit(0.5)).alias("score"))


@query(
    "J2",
    "SELECT d.doc_id, lang, n_chars, quality, toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def labels_aligned(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return docs.join(read_table(spark, sf, "labels"), "doc_id")


@query("J3", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def rows_in_key_set(spark, sf):
    keys = read_table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    return read_table(spark, sf, "documents").select("doc_id", "lang").join(keys, "doc_id", "left_semi")


@query("J3", "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def rows_outside_key_set(spark, sf):
    keys = read_table(spark, sf, "labels").where("toxic = 1").select("doc_id")
    return read_table(spark, sf, "documents").select("doc_id", "lang").join(keys, "doc_id", "left_anti")


@query(
    "J4",
    STORE_SQL
    + " SELECT row_id, "
    + ", ".join(f"{tidy_sql(m, 4)} AS {m}" for m in ("by_line", "by_quantity", "by_discount"))
    + " FROM m",
)
def bound_prediction_columns(spark, sf):
    long = pin(prediction_store(line_items(spark, sf)))
    models = ["by_line", "by_quantity", "by_discount"]
    parts = [
        long.where(F.col("model") == m).select("row_id", tidy(F.col("pred"), 4).alias(m)) for m in models
    ]
    return bound_columns(parts, ["row_id"])


@query(
    "J5",
    """WITH f AS (SELECT label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
    c AS (SELECT label, i, avg(v) AS m FROM f GROUP BY label, i),
    d AS (SELECT a.label AS class_a, b.label AS class_b, sqrt(sum((a.m - b.m)*(a.m - b.m))) AS dist
        FROM c a JOIN c b ON a.i = b.i GROUP BY a.label, b.label)
    SELECT class_a, class_b, round(dist / (SELECT max(dist) FROM d), 6) AS dist FROM d""",
)
def class_distances(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    rows = class_distance_rows(emb, centroids(emb, "label", "embedding"))
    return rows.select("class_a", "class_b", F.round("dist", 6).alias("dist"))


@query(
    "J7",
    """WITH names AS (SELECT label, 'class_' || label AS name FROM (SELECT DISTINCT label FROM embeddings))
    SELECT vec_id, name FROM embeddings JOIN names USING (label)""",
)
def decoded_classes(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    names = emb.select("label").distinct().withColumn("name", F.concat(F.lit("class_"), F.col("label")))
    return lookup(emb.select("vec_id", "label"), names, ["label"]).select("vec_id", "name")


@query(
    "J9 E13",
    f"""SELECT {ROW_ID} AS row_id, round(avg(l_quantity) OVER (), 6) AS quantity_mean,
        round(stddev_samp(l_quantity) OVER (), 6) AS quantity_std, min(l_quantity) OVER () AS quantity_min,
        max(l_quantity) OVER () AS quantity_max FROM lineitem""",
)
def global_statistics(spark, sf):
    rows = agg.with_statistics(line_items(spark, sf).select("row_id", "quantity"), ["quantity"])
    return rows.select(
        "row_id",
        *[F.round(f"quantity_{k}", 6).alias(f"quantity_{k}") for k in ("mean", "std")],
        "quantity_min",
        "quantity_max",
    )


# Codes and encoders


@query(
    "W13",
    """WITH f AS (SELECT event_type, min(event_id) AS first FROM events GROUP BY event_type),
    c AS (SELECT event_type, row_number() OVER (ORDER BY first) - 1 AS code FROM f)
    SELECT event_id, code FROM events JOIN c USING (event_type)""",
)
def codes_by_first_seen(spark, sf):
    events = read_table(spark, sf, "events").select("event_id", "event_type")
    codes = agg.code_by_first_seen(events, "event_type", "event_id")
    return agg.encode_with(events, codes, "event_type", "code").select("event_id", F.col("code").cast("long").alias("code"))


@query(
    "W14",
    """WITH c AS (SELECT p_brand, row_number() OVER (ORDER BY p_brand) - 1 AS code FROM (SELECT DISTINCT p_brand FROM part))
    SELECT p_partkey, code FROM part JOIN c USING (p_brand)""",
)
def codes_by_value(spark, sf):
    part = read_table(spark, sf, "part").select("p_partkey", "p_brand")
    codes = agg.code_by_value(part, "p_brand")
    return agg.encode_with(part, codes, "p_brand", "code").select("p_partkey", F.col("code").cast("long").alias("code"))


NUMBERS = ["quantity", "discount", "tax"]


@query(
    "E1",
    LINE_SQL
    + ", s AS (SELECT "
    + ", ".join(f"avg({c}) AS {c}_m, stddev_samp({c}) AS {c}_s" for c in NUMBERS)
    + " FROM line WHERE NOT is_test) SELECT row_id, "
    + ", ".join(f"round(({c} - {c}_m) / {c}_s, 6) AS {c}" for c in NUMBERS)
    + " FROM line, s",
)
def z_scores(spark, sf):
    li = line_items(spark, sf)
    fitted = scale.fit_z_score(li.where("NOT is_test"), NUMBERS)
    return fitted.apply(li).select("row_id", *[F.round(c, 6).alias(c) for c in NUMBERS])


@query(
    "E2",
    """SELECT p_partkey, round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 6) AS p_size,
    round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 6) AS p_retailprice FROM part""",
)
def standard_scaled(spark, sf):
    part = read_table(spark, sf, "part")
    cols = ["p_size", "p_retailprice"]
    return scale.fit_z_score(part, cols, population=True).apply(part).select(
        "p_partkey", *[F.round(c, 6).alias(c) for c in cols]
    )


@query(
    "E3",
    "WITH s AS (SELECT "
    + ", ".join(
        f"quantile_cont({c}::DOUBLE, 0.25::DOUBLE) AS {c}_1, quantile_cont({c}::DOUBLE, 0.5::DOUBLE) AS {c}_2, "
        f"quantile_cont({c}::DOUBLE, 0.75::DOUBLE) AS {c}_3"
        for c in ("p_size", "p_retailprice")
    )
    + " FROM part) SELECT p_partkey, "
    + ", ".join(f"round(({c} - {c}_2) / ({c}_3 - {c}_1), 6) AS {c}" for c in ("p_size", "p_retailprice"))
    + " FROM part, s",
)
def robust_scaled(spark, sf):
    part = read_table(spark, sf, "part")
    cols = ["p_size", "p_retailprice"]
    return scale.fit_robust(part, cols).apply(part).select("p_partkey", *[F.round(c, 6).alias(c) for c in cols])


@query(
    "E4",
    """SELECT p_partkey, round((p_size - min(p_size) OVER ()) / (max(p_size) OVER () - min(p_size) OVER ())::DOUBLE, 6) AS p_size
    FROM part""",
)
def min_max_scaled(spark, sf):
    part = read_table(spark, sf, "part")
    return scale.fit_min_max(part, ["p_size"]).apply(part).select("p_partkey", F.round("p_size", 6).alias("p_size"))


STATUSES = ["F", "O", "P"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
HOT_SQL = ", ".join(
    [f"""(o_orderstatus = '{v}')::INTEGER AS "o_orderstatus_{v}" """ for v in STATUSES]
    + [f"""(o_orderpriority = '{v}')::INTEGER AS "o_orderpriority_{v}" """ for v in PRIORITIES]
)


@query("E5", f"SELECT o_orderkey, {HOT_SQL} FROM orders")
def one_hot_columns(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return scale.fit_one_hot(orders, ["o_orderstatus", "o_orderpriority"]).apply(orders)


@query(
    "E6",
    f"""WITH s AS (SELECT quantile_cont(o_totalprice, 0.25::DOUBLE) AS a, quantile_cont(o_totalprice, 0.5::DOUBLE) AS b,
        quantile_cont(o_totalprice, 0.75::DOUBLE) AS c FROM orders)
    SELECT o_orderkey, round((o_totalprice - b) / (c - a), 6) AS o_totalprice, {HOT_SQL} FROM orders, s""",
)
def mixed_encoding(spark, sf):
    orders = read_table(spark, sf, "orders")
    fitted = scale.fit_mixed(orders, ["o_totalprice"], ["o_orderstatus", "o_orderpriority"])
    out = fitted.apply(orders, ["o_orderkey"])
    return out.withColumn("o_totalprice", F.round("o_totalprice", 6))


@query(
    "P6 E1",
    f"""WITH b AS (SELECT {ROW_ID} AS row_id, l_extendedprice - l_quantity AS balance FROM lineitem)
    SELECT row_id, round((balance - avg(balance) OVER ()) / stddev_samp(balance) OVER (), 6) AS balance FROM b""",
)
def scaled_balance(spark, sf):
    """Credit-style preparation: paired difference, then scaling, in one lazy plan."""
    li = line_items(spark, sf).select("row_id", "price", "quantity")
    balance = paired_difference(li, [("balance", "price", "quantity")])
    return scale.fit_z_score(balance, ["balance"]).apply(balance).withColumn("balance", F.round("balance", 6))


# Generated features, one row per line item.


def _named(pick, joint):
    return joint.join(pick)


def _product_sql(pick):
    return "*".join(pick)


def _picks(ways):
    return list(combinations_with_replacement(FEATURES, ways))


@query(
    "E7",
    LINE_SQL
    + " SELECT row_id, "
    + ", ".join(f"round({_product_sql(p)}, 6) AS {_named(p, '_x_')}" for p in _picks(2))
    + " FROM line",
)
def two_way_products(spark, sf):
    li = line_items(spark, sf)
    made = li.select("row_id", *feat.products(FEATURES, 2))
    return made.select("row_id", *[F.round(c, 6).alias(c) for c in made.columns if c != "row_id"])


def _rows_sql(columns: dict[str, str], digits: int) -> str:
    return f"{LINE_SQL} SELECT row_id, " + ", ".join(f'round({e}, {digits}) AS "{n}"' for n, e in columns.items()) + " FROM line"


def _rows(made, digits):
    return made.select("row_id", *[F.round(c, digits).alias(c) for c in made.columns if c != "row_id"])


@query("E8", _rows_sql({_named(p, "_x_"): _product_sql(p) for p in _picks(3)}, 6))
def three_way_products(spark, sf):
    return _rows(line_items(spark, sf).select("row_id", *feat.products(FEATURES, 3)), 6)


@query("E9", _rows_sql({_named(p, "_p_"): f"{p[0]}*{p[1]}+{p[2]}*{p[3]}" for p in _picks(4)}, 6))
def four_way_sums(spark, sf):
    return _rows(line_items(spark, sf).select("row_id", *feat.pair_sums(FEATURES)), 6)


@query(
    "E10",
    LINE_SQL
    + " SELECT row_id, "
    + ", ".join(f"round({a} / ({b} + 1e-5::DOUBLE), 3) AS {a}_d_{b}" for a, b in _picks(2))
    + " FROM line",
)
def ratio_features(spark, sf):
    made = line_items(spark, sf).select("row_id", *feat.ratios(FEATURES))
    return made.select("row_id", *[F.round(c, 3).alias(c) for c in made.columns if c != "row_id"])


@query(
    "E11",
    LINE_SQL
    + " SELECT row_id, "
    + ", ".join(f"round(ln(1 + {_product_sql(p)}), 8) AS log_{_named(p, '_x_')}" for p in _picks(2))
    + " FROM line",
)
def log_product_features(spark, sf):
    made = line_items(spark, sf).select("row_id", *feat.log_products(FEATURES, 2))
    return made.select("row_id", *[F.round(c, 8).alias(c) for c in made.columns if c != "row_id"])


@query("E11", _rows_sql({"log_" + _named(p, "_x_"): f"ln(1 + {_product_sql(p)})" for p in _picks(3)}, 8))
def log_three_way_products(spark, sf):
    return _rows(line_items(spark, sf).select("row_id", *feat.log_products(FEATURES, 3)), 8)


@query("E11", _rows_sql({"log_" + _named(p, "_p_"): f"ln(1 + {p[0]}*{p[1]}+{p[2]}*{p[3]})" for p in _picks(4)}, 8))
def log_four_way_sums(spark, sf):
    return _rows(line_items(spark, sf).select("row_id", *feat.log_pair_sums(FEATURES)), 8)


DOMAIN = {
    "body_index": "price / ((quantity / 100) * (quantity / 100))",
    "intensity": "price / line",
    "load_time": "price * line",
    "load_by_age": "price / quantity",
    "age_index": "quantity * (price / ((quantity / 100) * (quantity / 100)))",
    "room": "220 - quantity",
    "load_of_room": "price / (220 - quantity)",
}


@query(
    "E12",
    LINE_SQL + " SELECT row_id, " + ", ".join(f"{tidy_sql(e, 6)} AS {n}" for n, e in DOMAIN.items()) + " FROM line",
)
def domain_ratio_features(spark, sf):
    made = line_items(spark, sf).select(
        "row_id", *feat.domain_ratios("price", "quantity", "price", "line", "quantity", 220.0)
    )
    return made.select("row_id", *[tidy(F.col(c), 6).alias(c) for c in made.columns if c != "row_id"])


# Sampling and folds


@query("F1", f"SELECT o_orderkey, {bucket32('o_orderkey', 'split')} / 4294967296.0::DOUBLE < 0.2::DOUBLE AS is_test FROM orders")
def holdout_split(spark, sf):
    orders = read_table(spark, sf, "orders")
    return orders.select("o_orderkey", sampling.holdout_flag(["o_orderkey"], "split").alias("is_test"))


def stratified_sql(table: str, label: str, key: str, seed: str, share: str = "0.2") -> str:
    return f"""SELECT {key}, {label}, row_number() OVER (PARTITION BY {label} ORDER BY {digest_sql(key, seed)}, {key})
        <= floor(count(*) OVER (PARTITION BY {label}) * {share}::DOUBLE + 0.5) AS is_test FROM {table}"""


@query("F2", stratified_sql("labels", "quality", "doc_id", "split"))
def stratified_holdout(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    return sampling.stratified_holdout(labels, "quality", ["doc_id"], "split")


@query(
    "F3",
    f"""SELECT {ROW_ID} AS row_id, ({bucket32(ROW_ID, 'kfold')} % 5)::INTEGER AS fold_5,
    ({bucket32(ROW_ID, 'kfold')} % 10)::INTEGER AS fold_10, ({bucket32(ROW_ID, 'kfold')} % 50)::INTEGER AS fold_50 FROM lineitem""",
)
def hashed_folds(spark, sf):
    li = line_items(spark, sf)
    return li.select("row_id", *[sampling.fold_number(["row_id"], "kfold", k).alias(f"fold_{k}") for k in (5, 10, 50)])


@query(
    "F4",
    f"""SELECT doc_id, quality, ((row_number() OVER (PARTITION BY quality ORDER BY {digest_sql('doc_id', 'fold')}, doc_id) - 1) % 5)::INTEGER
        AS fold FROM labels""",
)
def stratified_folds(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    return sampling.stratified_folds(labels, "quality", ["doc_id"], "fold", 5)


EDGE_SQL = (
    "WITH e AS (SELECT DISTINCT q FROM (SELECT unnest(["
    + ", ".join(f"quantile_cont(value, {i / 10}::DOUBLE)" for i in range(11))
    + "]) AS q FROM events)), inner_edges AS (SELECT q FROM e WHERE q > (SELECT min(q) FROM e) AND q < (SELECT max(q) FROM e)), "
    "binned AS (SELECT event_id, (SELECT count(*) FROM inner_edges WHERE q <= value)::INTEGER AS bin FROM events)"
)


@query("F5", EDGE_SQL + " SELECT event_id, bin FROM binned")
def quantile_bins(spark, sf):
    events = read_table(spark, sf, "events")
    edges = sampling.quantile_edges(events, "value", 10)
    return events.select("event_id", sampling.quantile_bin("value", edges).alias("bin"))


@query(
    "F6",
    EDGE_SQL
    + f""" SELECT event_id, bin, ((row_number() OVER (PARTITION BY bin ORDER BY {digest_sql('event_id', 'fold')}, event_id) - 1) % 5)::INTEGER
        AS fold FROM binned""",
)
def stratified_bin_folds(spark, sf):
    events = read_table(spark, sf, "events")
    edges = sampling.quantile_edges(events, "value", 10)
    binned = events.select("event_id", sampling.quantile_bin("value", edges).alias("bin"))
    return sampling.stratified_folds(binned, "bin", ["event_id"], "fold", 5)


@query(
    "F7",
    f"""WITH maj AS (SELECT doc_id, quality FROM labels WHERE quality = 1),
    mino AS (SELECT doc_id, quality, row_number() OVER (ORDER BY {digest_sql('doc_id', 'draw')}, doc_id) AS r FROM labels WHERE quality = 0),
    draws AS (SELECT {bucket32('i', 'draw')} % (SELECT count(*) FROM mino) + 1 AS r FROM (SELECT unnest(range((SELECT count(*) FROM maj))) AS i))
    SELECT doc_id, quality, count(*) AS times FROM (SELECT doc_id, quality FROM maj
        UNION ALL SELECT doc_id, quality FROM draws JOIN mino USING (r)) GROUP BY doc_id, quality""",
)
def upsampled_minority(spark, sf):
    labels = read_table(spark, sf, "labels").select("doc_id", "quality")
    drawn = sampling.upsample_minority(labels, "quality", 0, 1, "doc_id", "draw")
    return drawn.groupBy("doc_id", "quality").agg(F.count(F.lit(1)).alias("times"))


@query(
    "F8",
    f"SELECT doc_id, row_number() OVER (ORDER BY {digest_sql('doc_id', 'shuffle')}, doc_id) AS position FROM documents",
)
def seeded_shuffle(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id")
    return sampling.shuffled_position(docs, ["doc_id"], "shuffle").select(
        "doc_id", F.col("position").cast("long").alias("position")
    )


@query("F8", f"SELECT doc_id, {digest_sql('doc_id', 'shuffle')} AS mark FROM documents ORDER BY mark, doc_id")
def seeded_order(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id")
    return sampling.shuffled(docs, ["doc_id"], "shuffle").select("doc_id", digest(["doc_id"], "shuffle").alias("mark"))
