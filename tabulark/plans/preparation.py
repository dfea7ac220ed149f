"""Queries on sources, projection and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulark.functions.hashing import bucket32 as hash_bucket
from tabulark.functions.numeric import clip, scaled_size, tidy
from tabulark.functions.recode import emphasis, fold_rare, inverted, literal_map, recode
from tabulark.functions.text import STOP_WORDS, letter_tokens, snippet
from tabulark.operators import project, setops
from tabulark.operators.classes import centroids, class_probabilities, ranked_classes
from tabulark.operators.ensemble import wide_predictions
from tabulark.plans.registry import query
from tabulark.plans.shared import CENTER_SQL, line_items, prediction_store
from tabulark.plans.sqlbits import ROW_ID, bucket32
from tabulark.plans.sqlbits import tidy as tidy_sql
from tabulark.session import fresh_folder, read_table
from tabulark.sources import files

# Sources and sinks


@query(
    "S1",
    "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def csv_scan(spark, sf):
    part = read_table(spark, sf, "part")
    path = fresh_folder(spark, "part-csv")
    files.write_csv(part, path)
    return files.read_csv(spark, path, part.schema)


@query("S2", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_round_trip(spark, sf):
    return files.round_trip(read_table(spark, sf, "nation"), fresh_folder(spark, "nation-csv"))


@query(
    "S3",
    "SELECT doc_id, lang, source, n_chars FROM documents WHERE lang IN ('en', 'fr')",
)
def corpus_by_category(spark, sf):
    docs = files.load_corpus(read_table(spark, sf, "documents"), "lang", ["en", "fr"])
    return docs.select("doc_id", "lang", "source", "n_chars")


@query(
    "S3",
    "SELECT lang, count(*) AS n FROM documents GROUP BY lang",
)
def corpus_all_categories(spark, sf):
    docs = files.load_corpus(read_table(spark, sf, "documents"), "lang", [])
    return docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query(
    "S4",
    """WITH h AS (SELECT doc_id, CASE WHEN regexp_matches(text, '^[A-Z][A-Za-z-]*: ') AND strpos(text, chr(10) || chr(10)) > 0
            THEN substr(text, strpos(text, chr(10) || chr(10)) + 2) ELSE text END AS t FROM documents),
    l AS (SELECT *, string_split(trim(t, ' ' || chr(9) || chr(10)), chr(10)) AS ls FROM h),
    k AS (SELECT *, list_max(list_filter(range(1, len(ls) + 1), lambda i: regexp_full_match(ls[i], '[ \\t]*-*[ \\t]*'))) AS rule FROM l),
    f AS (SELECT doc_id, CASE WHEN rule > 1 THEN ls[1:rule - 1] ELSE string_split(t, chr(10)) END AS ls FROM k)
    SELECT doc_id, md5(array_to_string(list_filter(ls, lambda x: NOT regexp_matches(x,
        '(writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\\||^>)')), chr(10))) AS text_md5 FROM f""",
)
def corpus_cleaned(spark, sf):
    docs = files.cleaned_corpus(read_table(spark, sf, "documents"), "text")
    return docs.select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "S5",
    """WITH s AS (SELECT p_type, avg(p_retailprice) AS m FROM part GROUP BY p_type)
    SELECT p_partkey, round(m + 1e-7::DOUBLE, 4) AS prediction FROM part JOIN s USING (p_type)""",
)
def submission_file(spark, sf):
    part = read_table(spark, sf, "part")
    means = part.groupBy("p_type").agg(tidy(F.avg("p_retailprice"), 4).alias("prediction"))
    scored = part.join(means, "p_type").select("p_partkey", "prediction")
    path = fresh_folder(spark, "submission")
    files.write_csv(files.submission(part, scored, "p_partkey"), path)
    return files.read_csv(spark, path, "p_partkey long, prediction double")


STORE_SQL = f"""WITH b AS (SELECT {ROW_ID} AS row_id, l_quantity AS q, l_discount AS d, l_linenumber AS ln,
        l_extendedprice AS y FROM lineitem),
    m AS (SELECT b.*, avg(y) OVER (PARTITION BY ln) AS by_line, avg(y) OVER (PARTITION BY q) AS by_quantity,
        avg(y) OVER (PARTITION BY d) AS by_discount FROM b)"""


@query(
    "S6",
    STORE_SQL
    + f" SELECT row_id, {tidy_sql('by_line', 4)} AS by_line, {tidy_sql('by_quantity', 4)} AS by_quantity FROM m",
)
def prediction_store_wide(spark, sf):
    """Writes one file set per model, reads two of them back side by side."""
    path = fresh_folder(spark, "predictions")
    files.write_predictions(prediction_store(line_items(spark, sf)), path)
    chosen = ["by_line", "by_quantity"]
    wide = wide_predictions(files.read_predictions(spark, path, chosen), ["row_id"], chosen)
    return wide.select("row_id", *[tidy(F.col(c), 4).alias(c) for c in chosen])


# Projection, filter, recode


@query(
    "P1",
    """SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus
    FROM lineitem""",
)
def drop_generated_columns(spark, sf):
    li = read_table(spark, sf, "lineitem").withColumnsRenamed(
        {"l_partkey": "key_0", "l_suppkey": "key_1", "l_linenumber": "key_2"}
    )
    return project.drop_generated(li, "key_", range(7), ("l_shipdate",))


@query(
    "P2",
    "SELECT s_suppkey AS c_custkey, s_name AS c_name, s_nationkey AS c_nationkey, s_acctbal AS c_acctbal FROM supplier",
)
def aligned_schema(spark, sf):
    return project.aligned(
        read_table(spark, sf, "supplier"),
        {"s_suppkey": "c_custkey", "s_name": "c_name", "s_nationkey": "c_nationkey", "s_acctbal": "c_acctbal"},
    )


STATUS = {"F": "finished", "O": "open"}


@query(
    "P3",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open'
        ELSE o_orderstatus END AS status FROM orders""",
)
def recoded_status(spark, sf):
    orders = read_table(spark, sf, "orders")
    return orders.select("o_orderkey", recode(F.col("o_orderstatus"), STATUS).alias("status"))


KEPT = ["1-URGENT", "2-HIGH"]


@query(
    "P4",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderpriority
        ELSE 'other' END AS priority FROM orders""",
)
def folded_priority(spark, sf):
    orders = read_table(spark, sf, "orders")
    return orders.select("o_orderkey", fold_rare(F.col("o_orderpriority"), KEPT).alias("priority"))


PRIORITY_GROUP = {"1-URGENT": "fast", "2-HIGH": "fast", "3-MEDIUM": "normal", "5-LOW": "slow"}


@query(
    "P5",
    """WITH g AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'fast' WHEN '2-HIGH' THEN 'fast'
        WHEN '3-MEDIUM' THEN 'normal' WHEN '5-LOW' THEN 'slow' END AS speed FROM orders)
    SELECT o_orderkey, speed, CASE speed WHEN 'fast' THEN '2-HIGH' WHEN 'normal' THEN '3-MEDIUM'
        WHEN 'slow' THEN '5-LOW' END AS code FROM g""",
)
def inverse_recode(spark, sf):
    grouped = read_table(spark, sf, "orders").select(
        "o_orderkey", literal_map(PRIORITY_GROUP)[F.col("o_orderpriority")].alias("speed")
    )
    return grouped.withColumn("code", literal_map(inverted(PRIORITY_GROUP))[F.col("speed")])


@query(
    "P6",
    f"""SELECT {ROW_ID} AS row_id, round(l_extendedprice - l_quantity, 4) AS balance_1,
        round(l_tax - l_discount, 6) AS balance_2 FROM lineitem""",
)
def paired_balances(spark, sf):
    li = line_items(spark, sf).select("row_id", "price", "quantity", "tax", "discount")
    out = project.paired_difference(
        li, [("balance_1", "price", "quantity"), ("balance_2", "tax", "discount")]
    )
    return out.select("row_id", F.round("balance_1", 4).alias("balance_1"), F.round("balance_2", 6).alias("balance_2"))


@query(
    "P7",
    """SELECT doc_id, md5(text) AS text_md5 FROM documents WHERE source IN ('src0', 'src3')
    ORDER BY doc_id LIMIT 1000""",
)
def member_filter(spark, sf):
    """The row cap is the operator: first thousand rows of a source in key order."""
    docs = read_table(spark, sf, "documents").where(F.col("source").isin("src0", "src3"))
    return project.first_rows(docs, ["doc_id"], 1000).select("doc_id", F.md5("text").alias("text_md5"))


@query(
    "P8",
    """SELECT 'number' AS kind, o_orderkey, md5(concat_ws('|', o_orderkey, o_custkey)) AS packed FROM orders
    UNION ALL SELECT 'text', o_orderkey, md5(concat_ws('|', o_orderstatus, o_orderpriority)) FROM orders""",
)
def columns_split_by_type(spark, sf):
    orders = read_table(spark, sf, "orders")
    kinds = project.columns_by_kind(orders)
    whole = [c for c in kinds["number"] if c != "o_totalprice"]
    return orders.select(
        F.lit("number").alias("kind"), "o_orderkey", F.md5(F.concat_ws("|", *whole)).alias("packed")
    ).unionByName(
        orders.select(F.lit("text").alias("kind"), "o_orderkey", F.md5(F.concat_ws("|", *kinds["text"])).alias("packed"))
    )


@query("P9", "SELECT l_quantity, l_discount, l_tax, l_extendedprice FROM lineitem")
def feature_subset(spark, sf):
    features, target = ["l_quantity", "l_discount", "l_tax"], ["l_extendedprice"]
    return read_table(spark, sf, "lineitem").select(*features, *target)


@query("P10", "SELECT p_brand, p_name, p_partkey, p_retailprice, p_size, p_type FROM part")
def canonical_columns(spark, sf):
    return project.sorted_columns(read_table(spark, sf, "part"))


@query(
    "P11",
    """SELECT o_orderkey, round(ln(1 + o_totalprice), 8) AS logged,
        round(exp(ln(1 + o_totalprice)) - 1, 4) AS back FROM orders""",
)
def log_target(spark, sf):
    orders = read_table(spark, sf, "orders").select("o_orderkey", F.log1p("o_totalprice").alias("l"))
    return orders.select("o_orderkey", F.round("l", 8).alias("logged"), F.round(F.expm1("l"), 4).alias("back"))


@query("P12", "SELECT event_id, greatest(least(value, 100.0::DOUBLE), 1.0::DOUBLE) AS clipped FROM events")
def clipped_values(spark, sf):
    events = read_table(spark, sf, "events")
    return events.select("event_id", clip(F.col("value"), 1.0, 100.0).alias("clipped"))


@query(
    "P13",
    "SELECT "
    + ROW_ID
    + " AS row_id, "
    + ", ".join(
        f"CASE WHEN l_linenumber = {i} THEN l_quantity ELSE 0 END AS quantity_line_{i}" for i in range(1, 8)
    )
    + " FROM lineitem",
)
def conditional_interactions(spark, sf):
    li = line_items(spark, sf)
    levels = project.distinct_values(li, "line")
    return li.select("row_id", *project.conditional_columns("line", "quantity", levels))


@query(
    "P14",
    f"""SELECT {ROW_ID} AS row_id, l_quantity*f AS quantity_x_returned, l_quantity*(1-f) AS quantity_x_not_returned,
        l_tax*f AS tax_x_returned, l_tax*(1-f) AS tax_x_not_returned
    FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS f FROM lineitem)""",
)
def flag_interactions(spark, sf):
    li = line_items(spark, sf).withColumn("returned", (F.col("l_returnflag") == "R").cast("int"))
    return li.select("row_id", *project.flag_interactions("returned", ["quantity", "tax"]))


@query(
    "P15",
    "SELECT doc_id, CAST(quality = 1 AS INTEGER) AS is_good, CAST(toxic > 0 AS INTEGER) AS is_toxic FROM labels",
)
def integer_flags(spark, sf):
    labels = read_table(spark, sf, "labels")
    return labels.select(
        "doc_id", (F.col("quality") == 1).cast("int").alias("is_good"), (F.col("toxic") > 0).cast("int").alias("is_toxic")
    )


@query("P16", "SELECT doc_id, greatest(4.0::DOUBLE, least(12.0::DOUBLE, n_chars / 400.0::DOUBLE)) AS radius FROM documents")
def marker_size(spark, sf):
    docs = read_table(spark, sf, "documents")
    return docs.select("doc_id", scaled_size(F.col("n_chars"), 400.0, 4.0, 12.0).alias("radius"))


STOP_SQL = "[" + ", ".join(f"'{w}'" for w in STOP_WORDS) + "]"
LETTERS_SQL = r"list_filter(regexp_extract_all(lower(text), '(\p{L}+)', 1), lambda t: length(t) BETWEEN 4 AND 15)"


@query(
    "P17",
    f"SELECT doc_id, array_to_string(list_slice({LETTERS_SQL}, 1, 8), ' ') AS snippet FROM documents",
)
def text_snippets(spark, sf):
    docs = read_table(spark, sf, "documents")
    return docs.select("doc_id", snippet(letter_tokens(F.col("text"))).alias("snippet"))


@query(
    "P18",
    CENTER_SQL
    + """, r AS (SELECT vec_id, class, row_number() OVER (PARTITION BY vec_id ORDER BY p DESC, class) AS k FROM probs)
    SELECT vec_id, string_agg(class::VARCHAR, ' ' ORDER BY k) AS labels FROM r WHERE k <= 3 GROUP BY vec_id""",
)
def joined_labels(spark, sf):
    emb = read_table(spark, sf, "embeddings")
    centers = centroids(emb, "label", "embedding")
    top = ranked_classes(class_probabilities(F.col("embedding"), centers), list(centers), 3)
    return emb.select("vec_id", F.concat_ws(" ", top.cast("array<string>")).alias("labels"))


@query(
    "P19",
    "SELECT o_orderkey, CASE WHEN o_orderpriority = '2-HIGH' THEN 0.8::DOUBLE ELSE 0.15::DOUBLE END AS opacity FROM orders",
)
def emphasised_category(spark, sf):
    orders = read_table(spark, sf, "orders")
    return orders.select("o_orderkey", emphasis(F.col("o_orderpriority"), "2-HIGH").alias("opacity"))


# Sort, limit, set operations


@query("O2", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id DESC LIMIT 10")
def longest_documents(spark, sf):
    docs = read_table(spark, sf, "documents").select("doc_id", "n_chars")
    return project.first_rows(docs, ["n_chars", "doc_id"], 10, last=True)


@query("O2", "SELECT doc_id, n_chars FROM documents ORDER BY doc_id LIMIT 10")
def first_documents(spark, sf):
    return project.first_rows(read_table(spark, sf, "documents").select("doc_id", "n_chars"), ["doc_id"], 10)


PARTY_SQL = """SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
    UNION ALL SELECT s_nationkey, s_acctbal FROM supplier"""


def _parties(spark, sf):
    customer = project.aligned(read_table(spark, sf, "customer"), {"c_nationkey": "nation", "c_acctbal": "balance"})
    supplier = project.aligned(read_table(spark, sf, "supplier"), {"s_acctbal": "balance", "s_nationkey": "nation"})
    return customer, supplier


@query("O3", PARTY_SQL)
def union_by_name(spark, sf):
    customer, supplier = _parties(spark, sf)
    return customer.unionByName(supplier)


@query("O4", f"SELECT DISTINCT nation, round(balance, 0) AS balance FROM ({PARTY_SQL})")
def union_then_distinct(spark, sf):
    rounded = [df.select("nation", F.round("balance", 0).alias("balance")) for df in _parties(spark, sf)]
    return setops.union_distinct(rounded)


@query(
    "O5",
    f"SELECT p_partkey, upper(p_type) AS kind FROM part WHERE {bucket32('p_partkey', 'part')} % 5 <> 0",
)
def split_back(spark, sf):
    """Train and test are stacked, encoded together, and the train part is taken out again."""
    part = read_table(spark, sf, "part").withColumn("b", F.pmod(hash_bucket(["p_partkey"], "part"), F.lit(5)))
    both = setops.stacked({"train": part.where("b <> 0"), "test": part.where("b = 0")})
    encoded = both.withColumn("kind", F.upper("p_type"))
    return setops.part_of(encoded, "train").select("p_partkey", "kind")


@query(
    "O6",
    f"""SELECT CASE WHEN {bucket32(ROW_ID, 'holdout')} % 5 = 0 THEN 'test' ELSE 'train' END AS part,
        {ROW_ID} AS row_id, round(l_extendedprice / 1000, 5) AS thousands FROM lineitem""",
)
def full_after_transform(spark, sf):
    li = line_items(spark, sf).withColumn("thousands", F.round(F.col("price") / 1000, 5))
    both = setops.stacked({"train": li.where("NOT is_test"), "test": li.where("is_test")})
    return both.select("part", "row_id", "thousands")
