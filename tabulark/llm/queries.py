"""Registered queries of this package, with SQL where it can state the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabulark.llm import (
    chat,
    language,
    lines,
    middle,
    minhash,
    mixing,
    neighbours,
    packing,
    phrases,
    pigeonhole,
    recipes,
    secrets,
    suffixes,
)
from tabulark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(build):
        QUERIES[build.__name__] = build
        if sql is not None:
            SQL[build.__name__] = sql
        return build

    return keep


@query()
def op1_minimum_bin_slack(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, folder, "documents"), added=True)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


#: A conversation whose texts are made of control strings.
TRAP = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query(r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text)
      + len(regexp_extract_all(text, '<\\*(?:s>|/s>)|\[\\*(?:SYS\]|/SYS\]|INST\]|/INST\]|OUT\]|ROLE=|/ROLE\])'))
      + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11
                  ELSE 16 + length(url_encode(role)) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
""")
def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    said = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    made = chat.format_conversations(said.unionByName(spark.createDataFrame(TRAP, said.schema)))
    turns = chat.read_turns(F.col("formatted"))
    both = F.transform("_turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return made.select("*", turns.alias("_turns"), chat.learned_text(F.col("segments")).alias("_learned")).select(
        "conv_id",
        F.size("_turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(both, ""), 256).alias("turns_sha256"),
        F.length("_learned").cast("long").alias("loss_chars"),
        F.sha2("_learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    filters = language.fit_filters(docs.where(~language.held_out("doc_id")))
    named = language.identify(docs.select("doc_id", "text"), filters)
    return named.select("doc_id", language.held_out("doc_id").alias("held_out"), "lang_pred", "score")


@query()
def op4_linear_grouping(spark: SparkSession, folder: str) -> DataFrame:
    kept = suffixes.drop_repeated_strings(table(spark, folder, "documents"))
    return kept.select(
        "doc_id",
        "n_bytes",
        suffixes.removed(F.col("spans")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query()
def op5_probminhash(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_copies(table(spark, folder, "documents"))


@query()
def op6_block_matrix_join(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings")
    return neighbours.nearest(rows, F.pmod(F.col("vec_id"), F.lit(50)) == 0)


@query(r"""
WITH parts AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM parts
), shared AS (
  SELECT k, max(doc_id) AS keep FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT doc_id, pos, line, keep IS NOT NULL AND keep <> doc_id AS lost FROM keyed LEFT JOIN shared USING (k)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN lost THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
""")
def op7_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    kept = lines.drop_common_lines(docs)
    text = F.coalesce("text", F.lit(""))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


@query()
def op8_randomness_battery(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != secrets.RANDOM)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(p.kind) for p in secrets.PATTERNS],
        F.sha2(secrets.described(base), 256).alias("base_sha256"),
        secrets.described(F.col("spans")).alias("spans"),
    )


@query()
def op9_subspace_pigeonhole(spark: SparkSession, folder: str) -> DataFrame:
    return pigeonhole.near_vectors(table(spark, folder, "embeddings"))


@query()
def op10_capped_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


@query(r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), cut AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces
), started AS (
  SELECT lang, unnest(ws) AS x, unnest(ws[2:]) AS y, unnest(ws[3:]) AS z FROM cut
), counts AS MATERIALIZED (
  SELECT lang, x AS phrase, count(*) AS f FROM started GROUP BY ALL
  UNION ALL SELECT lang, x || ' ' || y, count(*) FROM started WHERE y IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, x || ' ' || y || ' ' || z, count(*) FROM started WHERE z IS NOT NULL GROUP BY ALL
), cand AS (
  SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws FROM counts
  WHERE f >= 10 AND phrase LIKE '% %'
), numbered AS (
  SELECT *, unnest(range(1, len(ws))) AS k FROM cand
), parts AS MATERIALIZED (
  SELECT *, array_to_string(ws[1:k], ' ') AS head, array_to_string(ws[k + 1:], ' ') AS tail FROM numbered
), judged AS (
  SELECT p.lang, p.phrase, p.a, p.k, l.f AS l, r.f AS r,
         CAST((1000000::HUGEINT * p.a * p.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM parts p
  JOIN counts l ON l.lang = p.lang AND l.phrase = p.head
  JOIN counts r ON r.lang = p.lang AND r.phrase = p.tail
), weakest AS (
  SELECT * FROM judged QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), longer AS (
  SELECT lang, phrase, max(a) AS a FROM (
    SELECT lang, ws[1] || ' ' || ws[2] AS phrase, a FROM cand WHERE len(ws) = 3
    UNION ALL SELECT lang, ws[2] || ' ' || ws[3], a FROM cand WHERE len(ws) = 3
  ) GROUP BY ALL
), totals AS (
  SELECT lang, count(*) AS n FROM started GROUP BY lang
)
SELECT w.lang, row_number() OVER (PARTITION BY w.lang ORDER BY w.score DESC, w.a DESC, w.phrase) AS rank,
       w.phrase, w.a, w.l, w.r, t.n, w.score
FROM weakest w JOIN totals t USING (lang) LEFT JOIN longer g ON g.lang = w.lang AND g.phrase = w.phrase
WHERE g.a IS NULL OR 100 * g.a < 50 * w.a
QUALIFY rank <= 2000
""")
def op11_vertical_partitioning(spark: SparkSession, folder: str) -> DataFrame:
    return phrases.collocations(table(spark, folder, "documents"))


@query(r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units,
         sha256('7:' || CAST(doc_id AS VARCHAR)) AS h
  FROM documents
), numbers AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4
  FROM drawn
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100
              THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers
), parts AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS p, coalesce(array_to_string(units[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS s
  FROM cut
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
""")
def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = middle.fill_in_middle(table(spark, folder, "documents").select("doc_id", "text"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query(r"""
WITH made AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM made WINDOW w AS (PARTITION BY t)
""")
def op13_chunk_recipes(spark: SparkSession, folder: str) -> DataFrame:
    copies = recipes.exact_copies(table(spark, folder, "documents"))
    return copies.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
