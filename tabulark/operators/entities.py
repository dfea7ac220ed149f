"""Entity tables from patterns and a word list, and the sentences around them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabulark.functions.text import STOP_WORDS
from tabulark.operators.joins import lookup
from tabulark.operators.terms import document_frequency, top_in_group

# One pattern per entity type.
PATTERNS = {
    "EMAIL": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "IP": r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}",
    "PHONE": r"\+[0-9]{1,2} \([0-9]{3}\) [0-9]{3}-[0-9]{4}",
    "NUMBER": r"[0-9]{12,}",
}
NAME_WORD = r"\p{Lu}\p{Ll}{3,}"
SENTENCE_BREAK = r"[.!?]+[ \n]+|\n+"


def matches(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def pattern_entities(docs: DataFrame, keep: list[str], text: str, patterns: dict[str, str]) -> DataFrame:
    """One row per mention; all types are read in a single pass over the text."""

    def typed(kind: str, pattern: str) -> Column:
        return F.transform(
            matches(F.col(text), pattern), lambda e: F.struct(F.lit(kind).alias("type"), e.alias("entity"))
        )

    found = [typed(kind, pattern) for kind, pattern in patterns.items()]
    return docs.select(*keep, F.explode(F.flatten(F.array(*found))).alias("_e")).select(*keep, "_e.*")


def frequent_names(docs: DataFrame, text: str, least_docs: int) -> DataFrame:
    """Word list: the capitalised words found in at least ``least_docs`` documents."""
    counted = document_frequency(docs, matches(F.col(text), NAME_WORD))
    return counted.where(F.col("df") >= least_docs).select(F.col("term").alias("entity"))


def listed_entities(docs: DataFrame, keep: list[str], text: str, names: DataFrame, kind: str) -> DataFrame:
    """Mentions of listed names; the list is broadcast when its measured size allows."""
    words = docs.select(*keep, F.explode(matches(F.col(text), NAME_WORD)).alias("entity"))
    return lookup(words, names, ["entity"], pinned=True).select(*keep, F.lit(kind).alias("type"), "entity")


def entity_counts(mentions: DataFrame) -> DataFrame:
    return mentions.groupBy("type", "entity").agg(F.count(F.lit(1)).alias("n"))


def type_totals(mentions: DataFrame) -> DataFrame:
    """Distinct entities and mentions per type, from the already grouped counts."""
    return entity_counts(mentions).groupBy("type").agg(
        F.count(F.lit(1)).alias("entities"), F.sum("n").alias("mentions")
    )


def top_entities(mentions: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` most frequent entities per type; among those, only repeated ones are shown."""
    ranked = top_in_group(entity_counts(mentions), ["type"], [F.desc("n"), F.col("entity")], n)
    return ranked.where("n > 1")


def sentence_rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(document, sentence number, sentence) with empty pieces left out."""
    pieces = F.filter(
        F.transform(F.split(F.col(text), SENTENCE_BREAK), lambda s: F.trim(s)),
        lambda s: F.length(s) > 0,
    )
    return docs.select(key, F.posexplode(pieces).alias("sentence_no", "sentence"))


def mentioning(sentences: DataFrame, kind: str, least: int = 1, entity: str | None = None) -> DataFrame:
    """Sentences with at least ``least`` entities of the type, and with the named one if ``entity`` is given.

    Names are of type ``NAME``: every capitalised word counts, listed or not.
    """
    found = matches(F.col("sentence"), PATTERNS.get(kind, NAME_WORD))
    kept = sentences.withColumn("entities", found).where(F.size("entities") >= least)
    return kept if entity is None else kept.where(F.array_contains("entities", entity))


def entity_spans(sentences: DataFrame, kind: str) -> DataFrame:
    """Token start and end (exclusive) of every mention, one row each.

    The text between mentions comes from a split at the same pattern; the
    blanks in it and in the mentions before count the tokens.
    """

    def blanks(text: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, F.lit(" ")))

    gaps = F.transform(F.split("sentence", PATTERNS.get(kind, NAME_WORD), -1), blanks)
    inside = F.transform("entities", blanks)
    each = mentioning(sentences, kind).select(
        *sentences.columns, gaps.alias("_gaps"), inside.alias("_inside"), F.posexplode("entities").alias("_at", "entity")
    )

    def total(counts: Column) -> Column:
        return F.aggregate(counts, F.lit(0), lambda a, n: a + n)

    start = total(F.slice("_gaps", F.lit(1), F.col("_at") + 1)) + total(F.slice("_inside", F.lit(1), F.col("_at")))
    width = blanks(F.col("entity")) + 1
    return each.select(
        *sentences.columns,
        "entity",
        start.cast("long").alias("start"),
        (start + width).cast("long").alias("end"),
    )


def _content(words: Column) -> Column:
    plain = F.transform(words, lambda w: F.lower(F.regexp_replace(w, r"[^\p{L}]", "")))
    return F.filter(plain, lambda w: (F.length(w) >= 4) & ~w.isin(*STOP_WORDS))


def participants(spans: DataFrame) -> DataFrame:
    """Nearest content word before and after the entity inside its sentence."""
    tokens = F.split(F.col("sentence"), " ")
    before = _content(F.slice(tokens, F.lit(1), F.col("start").cast("int")))
    after = _content(F.slice(tokens, (F.col("end") + 1).cast("int"), F.size(tokens)))
    return spans.withColumn("word_before", F.try_element_at(before, F.lit(-1))).withColumn(
        "word_after", F.try_element_at(after, F.lit(1))
    )
