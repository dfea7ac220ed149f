"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Frequent English words of four letters and more.
STOP_WORDS = (
    "about", "above", "after", "again", "against", "been", "before", "being", "below", "between",
    "both", "could", "does", "doing", "down", "during", "each", "from", "further", "have",
    "having", "here", "into", "just", "more", "most", "once", "only", "other", "over",
    "same", "should", "some", "such", "than", "that", "their", "them", "then", "there",
    "these", "they", "this", "those", "through", "under", "until", "very", "were", "what",
    "when", "where", "which", "while", "will", "with", "would", "your", "yours",
)
# Frequent English words of two and three letters.
SHORT_STOP_WORDS = (
    "all", "am", "an", "and", "any", "are", "as", "at", "be", "but", "by", "can", "did", "do",
    "few", "for", "had", "has", "he", "her", "him", "his", "how", "if", "in", "is", "it", "its",
    "me", "my", "no", "nor", "not", "of", "off", "on", "or", "our", "out", "own", "she", "so",
    "the", "to", "too", "up", "was", "we", "who", "why", "you",
)
# The English list that ships with Spark, in its order.
ENGLISH_STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "your", "yours", "yourself", "yourselves",
    "he", "him", "his", "himself", "she", "her", "hers", "herself", "it", "its", "itself", "they", "them", "their",
    "theirs", "themselves", "what", "which", "who", "whom", "this", "that", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do", "does", "did", "doing", "a", "an",
    "the", "and", "but", "if", "or", "because", "as", "until", "while", "of", "at", "by", "for", "with", "about",
    "against", "between", "into", "through", "during", "before", "after", "above", "below", "to", "from", "up",
    "down", "in", "out", "on", "off", "over", "under", "again", "further", "then", "once", "here", "there", "when",
    "where", "why", "how", "all", "any", "both", "each", "few", "more", "most", "other", "some", "such", "no",
    "nor", "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can", "will", "just", "don",
    "should", "now", "i'll", "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've", "we've", "you've",
    "they've", "isn't", "aren't", "wasn't", "weren't", "haven't", "hasn't", "hadn't", "don't", "doesn't", "didn't",
    "won't", "wouldn't", "shan't", "shouldn't", "mustn't", "can't", "couldn't", "cannot", "could", "here's",
    "how's", "let's", "ought", "that's", "there's", "what's", "when's", "where's", "who's", "why's", "would",
)
LETTER_RUN = r"(\p{L}+)"
SPOKEN_RUN = r"([\p{L}']+)"
WORD_RUN = r"([\p{L}\p{N}_]{2,})"


def letter_tokens(text: Column, shortest: int = 4, longest: int = 15) -> Column:
    """Lower-case runs of letters with a length window."""
    runs = F.regexp_extract_all(F.lower(text), F.lit(LETTER_RUN))
    return F.filter(runs, lambda t: F.length(t).between(shortest, longest))


def spoken_tokens(text: Column) -> Column:
    """Lower-case runs of letters and apostrophes, so that contractions stay whole."""
    return F.regexp_extract_all(F.lower(text), F.lit(SPOKEN_RUN))


def word_tokens(text: Column) -> Column:
    """Lower-case runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_RUN))


def without(tokens: Column, words: tuple[str, ...]) -> Column:
    """Token array without the listed words (a hashed set test), order and repeats kept."""
    return F.filter(tokens, lambda t: ~t.isin(*words))


def plural_stem(token: Column) -> Column:
    """Published three-rule plural stemmer: the first rule whose ending fits decides."""
    return (
        F.when(
            token.rlike("ies$") & ~token.rlike("[ea]ies$"), F.regexp_replace(token, "ies$", "y")
        )
        .when(token.rlike("es$") & ~token.rlike("[aeo]es$"), F.regexp_replace(token, "es$", "e"))
        .when(token.rlike("s$") & ~token.rlike("[us]s$"), F.regexp_replace(token, "s$", ""))
        .otherwise(token)
    )


def snippet(tokens: Column, words: int = 8) -> Column:
    return F.array_join(F.slice(tokens, 1, words), " ")


# The first line of a header block, a line that quotes, and the rule above a footer.
HEADER_LINE = r"^[A-Z][A-Za-z-]*: "
QUOTED_LINE = r"(writes in|writes:|wrote:|says:|said:|^In article|^Quoted from|^\||^>)"
FOOTER_RULE = r"^[ \t]*-*[ \t]*$"


def without_header(text: Column) -> Column:
    """The text after the first blank line, if it starts with a header line and has one."""
    starts = text.rlike(HEADER_LINE) & text.contains("\n\n")
    return F.when(starts, F.regexp_replace(text, r"(?s)\A.*?\n\n(.*)\z", "$1")).otherwise(text)


def without_footer(text: Column) -> Column:
    """The text above its last line of dashes or blanks, unless that is the first line."""
    lines = F.split(F.btrim(text, F.lit(" \t\n")), "\n", -1)
    rules = F.transform(lines, lambda line: line.rlike(FOOTER_RULE))
    above = F.size(lines) - F.array_position(F.reverse(rules), True)
    found = F.array_contains(rules, True) & (above > 0)
    return F.when(found, F.array_join(F.slice(lines, F.lit(1), above.cast("int")), "\n")).otherwise(text)


def without_quotes(text: Column) -> Column:
    """The text without the lines that quote someone."""
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~line.rlike(QUOTED_LINE)), "\n")
