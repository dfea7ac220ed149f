"""Queries on tokens, vocabularies, classifiers, topics and entities."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulark.functions.text import (
    ENGLISH_STOP_WORDS,
    SHORT_STOP_WORDS,
    STOP_WORDS,
    letter_tokens,
    plural_stem,
    spoken_tokens,
    without,
    word_tokens,
)
from tabulark.operators import entities as ent
from tabulark.operators import learn, metrics, reduce, sampling, terms
from tabulark.plans.lookups import stratified_sql
from tabulark.plans.preparation import LETTERS_SQL, STOP_SQL
from tabulark.plans.registry import query
from tabulark.session import pin, read_table, spread

ALL_STOP = (*SHORT_STOP_WORDS, *STOP_WORDS)
ALL_STOP_SQL = "[" + ", ".join(f"'{w}'" for w in ALL_STOP) + "]"
WORDS_SQL = r"regexp_extract_all(lower(text), '([\p{L}\p{N}_]{2,})', 1)"


def documents(spark, sf):
    return spread(read_table(spark, sf, "documents"), "doc_id")


def topic_tokens():
    """Letters only, length 4 to 15, stop words out, light stem."""
    return F.transform(without(letter_tokens(F.col("text")), STOP_WORDS), plural_stem)


def class_tokens():
    return without(word_tokens(F.col("text")), ALL_STOP)


STEM_SQL = """CASE WHEN regexp_matches(t, 'ies$') AND NOT regexp_matches(t, '[ea]ies$') THEN regexp_replace(t, 'ies$', 'y')
    WHEN regexp_matches(t, 'es$') AND NOT regexp_matches(t, '[aeo]es$') THEN regexp_replace(t, 'es$', 'e')
    WHEN regexp_matches(t, 's$') AND NOT regexp_matches(t, '[us]s$') THEN regexp_replace(t, 's$', '') ELSE t END"""
TOPIC_SQL = f"""WITH raw AS (SELECT doc_id, unnest({LETTERS_SQL}) AS t FROM documents),
    tok AS (SELECT doc_id, {STEM_SQL} AS term FROM raw WHERE NOT list_contains({STOP_SQL}, t)),
    n_docs AS (SELECT count(*) AS n FROM documents), df AS (SELECT term, count(DISTINCT doc_id) AS df FROM tok GROUP BY term)"""
PRUNED_SQL = """, kept AS (SELECT term, df FROM df, n_docs WHERE df >= 10 AND df <= n * 0.5::DOUBLE ORDER BY df DESC, term LIMIT 10000)"""


def vocabulary(spark, sf, tokens, least=10, share=0.5, keep=10_000):
    docs = documents(spark, sf)
    frequency = terms.document_frequency(docs, tokens)
    return terms.pruned_vocabulary(frequency, docs.count(), least, share, keep)


@query("T1", f"SELECT doc_id, md5(array_to_string({LETTERS_SQL}, ' ')) AS tokens_md5, length({LETTERS_SQL})::INTEGER AS n FROM documents")
def tokenised_documents(spark, sf):
    docs = documents(spark, sf).select("doc_id", letter_tokens(F.col("text")).alias("tokens"))
    return docs.select("doc_id", F.md5(F.array_join("tokens", " ")).alias("tokens_md5"), F.size("tokens").alias("n"))


@query(
    "T2",
    f"""SELECT doc_id, md5(array_to_string(list_filter({LETTERS_SQL}, lambda w: NOT list_contains({STOP_SQL}, w)), ' ')) AS tokens_md5 FROM documents""",
)
def stop_words_removed(spark, sf):
    kept = without(letter_tokens(F.col("text")), STOP_WORDS)
    return documents(spark, sf).select("doc_id", F.md5(F.array_join(kept, " ")).alias("tokens_md5"))


SHIPPED_SQL = "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in ENGLISH_STOP_WORDS) + "]"
SPOKEN_SQL = r"regexp_extract_all(lower(text), '([\p{L}'']+)', 1)"


@query(
    "T2",
    f"""WITH k AS (SELECT doc_id, {SPOKEN_SQL} AS every, list_filter({SPOKEN_SQL}, lambda w: NOT list_contains({SHIPPED_SQL}, w)) AS kept FROM documents)
    SELECT doc_id, len(every)::INTEGER AS tokens, len(kept)::INTEGER AS left_over, md5(array_to_string(kept, ' ')) AS tokens_md5 FROM k""",
)
def shipped_stop_words_removed(spark, sf):
    """Words of any length, contractions whole, without Spark's own English list."""
    every = spoken_tokens(F.col("text"))
    rows = documents(spark, sf).select("doc_id", every.alias("every")).withColumn("kept", without(F.col("every"), ENGLISH_STOP_WORDS))
    return rows.select(
        "doc_id", F.size("every").alias("tokens"), F.size("kept").alias("left_over"), F.md5(F.array_join("kept", " ")).alias("tokens_md5")
    )


@query("T3", TOPIC_SQL + " SELECT term, count(*) AS n FROM tok GROUP BY term")
def stemmed_counts(spark, sf):
    long = documents(spark, sf).select(F.explode(topic_tokens()).alias("term"))
    return long.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


@query("T4", TOPIC_SQL + " SELECT term, row_number() OVER (ORDER BY encode(term)) - 1 AS term_id, df FROM df")
def term_dictionary(spark, sf):
    return terms.dictionary(terms.document_frequency(documents(spark, sf), topic_tokens()))


@query("T5", TOPIC_SQL + PRUNED_SQL + " SELECT term, df FROM kept")
def pruned_dictionary(spark, sf):
    return vocabulary(spark, sf, topic_tokens())


@query(
    "T6",
    TOPIC_SQL + PRUNED_SQL + """, ids AS (SELECT term, row_number() OVER (ORDER BY encode(term)) - 1 AS term_id FROM kept)
    SELECT doc_id, term_id, count(*) AS n FROM tok JOIN ids USING (term) GROUP BY doc_id, term_id""",
)
def bag_of_words(spark, sf):
    docs = documents(spark, sf)
    counts = pin(terms.term_counts(docs, ["doc_id"], topic_tokens()))
    kept = terms.pruned_vocabulary(terms.frequency_of(counts), docs.count(), 10, 0.5, 10_000)
    return terms.bag_of_words(counts, "doc_id", terms.dictionary(kept))


CLASS_SQL = f"""WITH raw AS (SELECT doc_id, lang, unnest({WORDS_SQL}) AS term FROM documents),
    tok AS (SELECT * FROM raw WHERE NOT list_contains({ALL_STOP_SQL}, term)),"""


def weight_sql(source: str, docs: str, limits: str = "") -> str:
    return f""" cnt AS (SELECT doc_id, lang, term, count(*)::DOUBLE AS n FROM {source} GROUP BY ALL),
    nd AS (SELECT count(*) AS nd FROM {docs}), df AS (SELECT term, count(*) AS df FROM cnt GROUP BY term),
    idf AS (SELECT term, ln((1.0::DOUBLE + nd) / (1 + df)) + 1 AS idf FROM df, nd {limits}),
    w AS (SELECT doc_id, lang, term, n * idf AS w FROM cnt JOIN idf USING (term)),
    vec AS (SELECT doc_id, lang, term, w / sqrt(sum(w*w) OVER (PARTITION BY doc_id)) AS weight FROM w)"""


@query("T7", CLASS_SQL + weight_sql("tok", "documents") + " SELECT doc_id, term, round(weight, 8) AS weight FROM vec")
def tf_idf_weights(spark, sf):
    docs = documents(spark, sf)
    counts = pin(terms.term_counts(docs, ["doc_id"], class_tokens()))
    idf = terms.smooth_idf(terms.frequency_of(counts), docs.count())
    return terms.tf_idf(counts, ["doc_id"], idf).withColumn("weight", F.round("weight", 8))


@query(
    "T8",
    CLASS_SQL
    + weight_sql("tok", "documents", "WHERE df >= 2 AND df <= nd * 0.5::DOUBLE")
    + " SELECT doc_id, term, round(weight, 8) AS weight FROM vec",
)
def limited_tf_idf_weights(spark, sf):
    docs = documents(spark, sf)
    n = docs.count()
    counts = pin(terms.term_counts(docs, ["doc_id"], class_tokens()))
    frequency = terms.frequency_of(counts).where((F.col("df") >= 2) & (F.col("df") <= n * 0.5))
    return terms.tf_idf(counts, ["doc_id"], terms.smooth_idf(frequency, n)).withColumn("weight", F.round("weight", 8))


SPLIT_SQL = f" sp AS ({stratified_sql('documents', 'lang', 'doc_id', 'texts')}), tr AS (SELECT tok.* FROM tok JOIN sp USING (doc_id) WHERE NOT is_test), trd AS (SELECT * FROM sp WHERE NOT is_test),"
TRAIN_SQL = CLASS_SQL + SPLIT_SQL + weight_sql("tr", "trd")
TEST_SQL = """, tc AS (SELECT tok.doc_id, tok.lang, term, count(*)::DOUBLE AS n FROM tok JOIN sp USING (doc_id) WHERE is_test GROUP BY ALL),
    tw AS (SELECT doc_id, lang, term, n * idf AS w FROM tc JOIN idf USING (term)),
    tvec AS (SELECT doc_id, lang, term, w / sqrt(sum(w*w) OVER (PARTITION BY doc_id)) AS weight FROM tw)"""


def train_and_test(spark, sf):
    """Counted once for all rows; the vocabulary and idf come from the training rows only."""
    docs = documents(spark, sf)
    keep = ["doc_id", "lang"]
    # Ranked on keys alone: the texts are not moved for the split.
    flags = pin(sampling.stratified_holdout(docs.select(*keep), "lang", ["doc_id"], "texts"))
    train_docs, test_docs = flags.where("NOT is_test").drop("is_test"), flags.where("is_test").drop("is_test")
    counts = pin(
        terms.term_counts(docs, keep, class_tokens()).join(flags.select("doc_id", "is_test"), "doc_id")
    )
    train_counts = counts.where("NOT is_test").drop("is_test")
    test_counts = counts.where("is_test").drop("is_test")
    idf = terms.smooth_idf(terms.frequency_of(train_counts), train_docs.count())
    train, test = terms.tf_idf_parts([train_counts, test_counts], keep, idf)
    return train, test, train_docs, test_docs


@query("T9", TRAIN_SQL + TEST_SQL + " SELECT doc_id, term, round(weight, 8) AS weight FROM tvec")
def unseen_tf_idf_weights(spark, sf):
    _, test, _, _ = train_and_test(spark, sf)
    return test.select("doc_id", "term", F.round("weight", 8).alias("weight"))


BAYES_SQL = TRAIN_SQL + """, cl AS (SELECT lang, ln(count(*)::DOUBLE / (SELECT count(*) FROM trd)) AS prior FROM trd GROUP BY lang),
    voc AS (SELECT count(*) AS v FROM idf), ct AS (SELECT lang, term, sum(weight) AS s FROM vec GROUP BY lang, term),
    tot AS (SELECT lang, sum(s) AS total FROM ct GROUP BY lang),
    lw AS (SELECT cl.lang, idf.term, ln((coalesce(s, 0) + 0.1::DOUBLE) / (total + 0.1::DOUBLE * v)) AS lw
        FROM cl CROSS JOIN idf CROSS JOIN voc JOIN tot ON tot.lang = cl.lang LEFT JOIN ct ON ct.lang = cl.lang AND ct.term = idf.term)"""
GUESS_SQL = BAYES_SQL + TEST_SQL + """, sc AS (SELECT t.doc_id, lw.lang AS c, sum(t.weight * lw) AS s FROM tvec t JOIN lw USING (term) GROUP BY ALL),
    full_sc AS (SELECT sp.doc_id, sp.lang, cl.lang AS c, coalesce(s, 0) + prior AS s FROM sp CROSS JOIN cl
        LEFT JOIN sc ON sc.doc_id = sp.doc_id AND sc.c = cl.lang WHERE is_test),
    gs AS (SELECT doc_id, lang, arg_max(c, s) AS predicted FROM full_sc GROUP BY doc_id, lang)"""


@query("T10", BAYES_SQL + " SELECT lang, term, round(lw, 6) AS log_weight FROM lw")
def naive_bayes_weights(spark, sf):
    train, _, train_docs, _ = train_and_test(spark, sf)
    model = terms.fit_naive_bayes(train, train_docs, "lang")
    return terms.naive_bayes_table(model, "lang").withColumn("log_weight", F.round("log_weight", 6))


def guessed_languages(spark, sf):
    train, test, train_docs, test_docs = train_and_test(spark, sf)
    model = terms.fit_naive_bayes(train, train_docs, "lang")
    return terms.predict_naive_bayes(model, test, test_docs, "doc_id")


@query("T11", GUESS_SQL + " SELECT doc_id, lang, predicted FROM gs")
def naive_bayes_predictions(spark, sf):
    return guessed_languages(spark, sf)


REPORT_SQL = GUESS_SQL + """, cls AS (SELECT lang AS c FROM gs UNION SELECT predicted FROM gs),
    per AS (SELECT c, count(*) FILTER (lang = c) AS support, count(*) FILTER (predicted = c) AS chosen, count(*) FILTER (lang = c AND predicted = c) AS hits FROM gs, cls GROUP BY c),
    rep AS (SELECT c AS class, CASE WHEN chosen > 0 THEN hits::DOUBLE/chosen ELSE 0 END AS p, CASE WHEN support > 0 THEN hits::DOUBLE/support ELSE 0 END AS r,
        CASE WHEN chosen + support > 0 THEN 2.0::DOUBLE*hits/(chosen+support) ELSE 0 END AS f, support FROM per)"""


@query(
    "K4",
    REPORT_SQL + """ SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, support FROM rep
    UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), sum(support)::BIGINT FROM rep
    UNION ALL SELECT 'weighted avg', round(sum(p*support)/sum(support), 6), round(sum(r*support)/sum(support), 6), round(sum(f*support)/sum(support), 6), sum(support)::BIGINT FROM rep""",
)
def language_report(spark, sf):
    rows = metrics.class_report(pin(guessed_languages(spark, sf)), "lang", "predicted")
    return rows.select("class", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("K5", REPORT_SQL + " SELECT a.c AS truth, b.c AS guess, count(gs.doc_id) AS n FROM cls a CROSS JOIN cls b LEFT JOIN gs ON gs.lang = a.c AND gs.predicted = b.c GROUP BY a.c, b.c")
def language_confusion(spark, sf):
    return metrics.confusion(pin(guessed_languages(spark, sf)), "lang", "predicted")


@query(
    "W2",
    BAYES_SQL + """, rk AS (SELECT lang, term, lw, row_number() OVER (PARTITION BY lang ORDER BY round(lw, 6) DESC, term) AS rank FROM lw)
    SELECT lang, term, round(lw, 6) AS log_weight, rank::INTEGER AS rank FROM rk WHERE rank <= 10""",
)
def top_class_terms(spark, sf):
    train, _, train_docs, _ = train_and_test(spark, sf)
    model = terms.fit_naive_bayes(train, train_docs, "lang")
    table = terms.naive_bayes_table(model, "lang").withColumn("log_weight", F.round("log_weight", 6))
    return terms.top_in_group(table, ["lang"], [F.desc("log_weight"), F.col("term")], 10)


@query(
    "T14",
    CLASS_SQL + weight_sql("tok", "documents", "WHERE df >= 2 AND df <= nd * 0.5::DOUBLE") + """, sz AS (SELECT lang, count(*) AS k FROM documents GROUP BY lang),
    mw AS (SELECT lang, term, round(sum(weight) / any_value(k), 8) AS mean_weight FROM vec JOIN sz USING (lang) GROUP BY lang, term),
    rk AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY mean_weight DESC, term) AS rank FROM mw)
    SELECT lang, term, mean_weight, rank::INTEGER AS rank FROM rk WHERE rank <= 50""",
)
def discriminative_terms(spark, sf):
    docs = documents(spark, sf)
    n = docs.count()
    counts = pin(terms.term_counts(docs, ["doc_id", "lang"], class_tokens()))
    frequency = terms.frequency_of(counts).where((F.col("df") >= 2) & (F.col("df") <= n * 0.5))
    vectors = terms.tf_idf(counts, ["doc_id", "lang"], terms.smooth_idf(frequency, n))
    means = terms.mean_weights(vectors, docs.select("doc_id", "lang"), "lang")
    rounded = means.withColumn("mean_weight", F.round("mean_weight", 8))
    return terms.top_in_group(rounded, ["lang"], [F.desc("mean_weight"), F.col("term")], 50)


# Documents in few dimensions, and clusters of them

#: Dimensions of the reference setting, and clusters looked for: one per language.
DIMENSIONS, CLUSTERS = 300, 4


def reduced(spark, sf, dimensions=DIMENSIONS):
    """All terms in two documents or more and in at most half of them; no limit on their number."""
    docs = documents(spark, sf).select("doc_id", class_tokens().alias("tokens"))
    n = docs.count()
    frequency = terms.document_frequency(docs, F.col("tokens")).where((F.col("df") >= 2) & (F.col("df") <= n * 0.5))
    weights = terms.tf_idf(terms.term_counts(docs, ["doc_id"], F.col("tokens")), ["doc_id"], terms.smooth_idf(frequency, n))
    return reduce.reduced(reduce.document_rows(weights, "doc_id"), "doc_id", dimensions)


@query("T12")
def reduced_documents(spark, sf):
    return reduced(spark, sf).documents.select("doc_id", F.posexplode("reduced").alias("dimension", "value"))


@query("T12")
def singular_values(spark, sf):
    rows = list(enumerate(reduced(spark, sf).values))
    return spark.createDataFrame(rows, "dimension int, value double")


@query("T14 T13")
def document_clusters(spark, sf):
    _, clustered = learn.fitted_clusters(reduced(spark, sf).documents, "reduced", CLUSTERS)
    return clustered.select("doc_id", "cluster")


@query("T14")
def cluster_terms(spark, sf):
    """The 50 strongest terms of each cluster of documents, from its center through the inverse of the reduction."""
    small = reduced(spark, sf)
    centers, _ = learn.fitted_clusters(small.documents, "reduced", CLUSTERS)
    return reduce.cluster_terms(centers, small.terms, 50)


@query("T14 K10")
def document_cluster_agreement(spark, sf):
    langs = read_table(spark, sf, "documents").select("doc_id", "lang")
    scored = metrics.cluster_agreement(document_clusters(spark, sf).join(langs, "doc_id"), "lang", "cluster")
    return scored.select(*[F.round(c, 8).alias(c) for c in scored.columns])


# Topics: checked by facts

#: The survey's vocabulary limit for topics.
TOPIC_WORDS = 10_000


def topic_vectors(spark, sf):
    words = vocabulary(spark, sf, topic_tokens(), keep=TOPIC_WORDS)
    listed = [r["term"] for r in words.collect()]
    docs = documents(spark, sf).select("doc_id", topic_tokens().alias("tokens"))
    return pin(learn.term_vectors(docs, "tokens", listed)), listed


@query("T15")
def topic_keywords(spark, sf):
    vectors, listed = topic_vectors(spark, sf)
    return learn.topic_terms(learn.fit_topics(vectors, 10), listed, spark, 10)


@query("T16")
def topic_shares(spark, sf):
    vectors, _ = topic_vectors(spark, sf)
    return learn.topic_mix(learn.fit_topics(vectors, 10), vectors, "doc_id")


@query("W3 P17")
def main_topics(spark, sf):
    vectors, listed = topic_vectors(spark, sf)
    model = learn.fit_topics(vectors, 10)
    best = learn.main_topics(learn.topic_mix(model, vectors, "doc_id"), "doc_id", learn.topic_terms(model, listed, spark, 5))
    snippets = vectors.select("doc_id", F.array_join(F.slice("tokens", 1, 8), " ").alias("snippet"))
    return best.join(snippets, "doc_id")


# Entities

#: A capitalised word is a name from so many documents on.
NAME_DOCUMENTS = 5


def mentions(spark, sf):
    docs = documents(spark, sf)
    by_pattern = ent.pattern_entities(docs, ["doc_id"], "text", ent.PATTERNS)
    names = pin(ent.frequent_names(docs, "text", NAME_DOCUMENTS))
    return by_pattern.unionByName(ent.listed_entities(docs, ["doc_id"], "text", names, "NAME"))


NAME_SQL = f"regexp_extract_all(text, '{ent.NAME_WORD}')"
MENTION_SQL = (
    "WITH nm AS (SELECT doc_id, unnest("
    + NAME_SQL
    + ") AS entity FROM documents), fr AS (SELECT entity FROM nm GROUP BY entity "
    + f"HAVING count(DISTINCT doc_id) >= {NAME_DOCUMENTS}), men AS ("
    + " UNION ALL ".join(
        f"SELECT doc_id, '{k}' AS type, unnest(regexp_extract_all(text, '{p}')) AS entity FROM documents"
        for k, p in ent.PATTERNS.items()
    )
    + " UNION ALL SELECT doc_id, 'NAME', entity FROM nm JOIN fr USING (entity))"
)


@query("T17", MENTION_SQL + " SELECT doc_id, type, entity, count(*) AS n FROM men GROUP BY ALL")
def entity_mentions(spark, sf):
    return mentions(spark, sf).groupBy("doc_id", "type", "entity").agg(F.count(F.lit(1)).alias("n"))


@query("A15", MENTION_SQL + " SELECT type, entity, count(*) AS n FROM men GROUP BY ALL")
def entity_counts(spark, sf):
    return ent.entity_counts(mentions(spark, sf))


@query("A16", MENTION_SQL + " SELECT type, count(DISTINCT entity) AS entities, count(*) AS mentions FROM men GROUP BY type")
def entity_type_totals(spark, sf):
    return ent.type_totals(mentions(spark, sf))


@query(
    "W4",
    MENTION_SQL + """, c AS (SELECT type, entity, count(*) AS n FROM men GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY type ORDER BY n DESC, encode(entity)) AS rank FROM c)
    SELECT type, entity, n, rank::INTEGER AS rank FROM r WHERE rank <= 10 AND n > 1""",
)
def top_entities(spark, sf):
    return ent.top_entities(mentions(spark, sf), 10)


BREAK_SQL = "'[.!?]+[ \\n]+|\\n+'"
SENTENCE_SQL = f"""WITH pc AS (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, {BREAK_SQL}), lambda s: trim(s)), lambda s: length(s) > 0) AS l FROM documents),
    sen AS (SELECT doc_id, unnest(l) AS sentence, generate_subscripts(l, 1) - 1 AS sentence_no FROM pc)"""


@query("T18", SENTENCE_SQL + f" SELECT doc_id, sentence_no, md5(sentence) AS sentence_md5 FROM sen WHERE regexp_matches(sentence, '{ent.PATTERNS['PHONE']}')")
def sentences_with_phone(spark, sf):
    found = ent.mentioning(ent.sentence_rows(documents(spark, sf), "doc_id", "text"), "PHONE")
    return found.select("doc_id", F.col("sentence_no").cast("long").alias("sentence_no"), F.md5("sentence").alias("sentence_md5"))


@query(
    "T19",
    SENTENCE_SQL
    + f" SELECT doc_id, sentence_no, length(regexp_extract_all(sentence, '{ent.PATTERNS['NUMBER']}')) AS n FROM sen WHERE length(regexp_extract_all(sentence, '{ent.PATTERNS['NUMBER']}')) >= 2",
)
def sentences_with_several_numbers(spark, sf):
    found = ent.mentioning(ent.sentence_rows(documents(spark, sf), "doc_id", "text"), "NUMBER", least=2)
    return found.select(
        "doc_id", F.col("sentence_no").cast("long").alias("sentence_no"), F.size("entities").cast("long").alias("n")
    )


NAMED_SQL = (
    MENTION_SQL
    + ", top AS (SELECT entity FROM nm JOIN fr USING (entity) GROUP BY entity ORDER BY count(*) DESC, encode(entity) LIMIT 1), "
    + SENTENCE_SQL.removeprefix("WITH ")
    + f", named AS (SELECT doc_id, sentence_no, sentence, regexp_extract_all(sentence, '{ent.NAME_WORD}') AS es FROM sen)"
)


def sentences_about(spark, sf, least):
    """Sentences that hold the most frequent name of the corpus, and so many names in all."""
    docs = documents(spark, sf)
    names = pin(ent.frequent_names(docs, "text", NAME_DOCUMENTS))
    counts = ent.entity_counts(ent.listed_entities(docs, ["doc_id"], "text", names, "NAME"))
    first = counts.orderBy(F.desc("n"), "entity").first()
    name = first["entity"] if first else ""
    found = ent.mentioning(ent.sentence_rows(docs, "doc_id", "text"), "NAME", least=least, entity=name)
    return found.select("doc_id", F.col("sentence_no").cast("long").alias("sentence_no"), F.md5("sentence").alias("sentence_md5"), F.lit(name).alias("entity"))


@query("T18", NAMED_SQL + " SELECT doc_id, sentence_no, md5(sentence) AS sentence_md5, entity FROM named, top WHERE list_contains(es, entity)")
def sentences_about_a_name(spark, sf):
    return sentences_about(spark, sf, 1)


@query(
    "T19",
    NAMED_SQL + " SELECT doc_id, sentence_no, md5(sentence) AS sentence_md5, entity FROM named, top WHERE list_contains(es, entity) AND len(es) >= 2",
)
def sentences_about_a_name_and_others(spark, sf):
    return sentences_about(spark, sf, 2)


SPAN_SQL = SENTENCE_SQL + f""", al AS (SELECT *, regexp_extract_all(sentence, '{ent.PATTERNS['PHONE']}') AS es,
        regexp_split_to_array(sentence, '{ent.PATTERNS['PHONE']}') AS gs FROM sen),
    em AS (SELECT doc_id, sentence_no, sentence, gs, es, unnest(es) AS entity, generate_subscripts(es, 1) AS k FROM al),
    bf AS (SELECT *, array_to_string(gs[1:k], '') || array_to_string(es[1:k-1], '') AS before FROM em),
    sp AS (SELECT doc_id, sentence_no, sentence, entity, length(before) - length(replace(before, ' ', '')) AS s,
        length(entity) - length(replace(entity, ' ', '')) + 1 AS wd FROM bf)"""


@query("T20", SPAN_SQL + ' SELECT doc_id, sentence_no, entity, s AS start, s + wd AS "end" FROM sp')
def phone_spans(spark, sf):
    spans = ent.entity_spans(ent.sentence_rows(documents(spark, sf), "doc_id", "text"), "PHONE")
    return spans.select("doc_id", F.col("sentence_no").cast("long").alias("sentence_no"), "entity", "start", "end")


CONTENT_SQL = f"lambda w: length(w) >= 4 AND NOT list_contains({STOP_SQL}, w)"
PLAIN_SQL = "lambda w: lower(regexp_replace(w, '[^\\p{L}]', '', 'g'))"


@query(
    "T21",
    SPAN_SQL + f""", tk AS (SELECT *, string_split(sentence, ' ') AS l FROM sp),
    ct AS (SELECT doc_id, sentence_no, entity, list_filter(list_transform(list_slice(l, 1, s), {PLAIN_SQL}), {CONTENT_SQL}) AS b,
        list_filter(list_transform(list_slice(l, s + wd + 1, length(l)), {PLAIN_SQL}), {CONTENT_SQL}) AS a FROM tk)
    SELECT doc_id, sentence_no, entity, b[-1] AS word_before, a[1] AS word_after FROM ct""",
)
def phone_participants(spark, sf):
    spans = ent.entity_spans(ent.sentence_rows(documents(spark, sf), "doc_id", "text"), "PHONE")
    found = ent.participants(spans)
    return found.select(
        "doc_id", F.col("sentence_no").cast("long").alias("sentence_no"), "entity", "word_before", "word_after"
    )
