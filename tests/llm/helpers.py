"""Small tables with every awkward row, and what to expect of them."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, _row string, key long, n_lines long"


def documents(spark, rows, schema: str = DOCS):
    """(doc_id, text[, lang[, source]]) rows with extra columns of clashing names."""
    full = [(r[0], r[1], *(r[2:3] or (None,)), *(r[3:4] or (None,)), 0, "x", 7, -1) for r in rows]
    return spark.createDataFrame(full, schema)


def words(n: int, start: int = 0) -> str:
    return " ".join(f"word{i:05d}" for i in range(start, start + n))


def awkward(long: int = 20_000) -> list[tuple]:
    """Null and empty texts, null and repeated keys, a very long text, white space, repeated rows."""
    return [
        (1, None),
        (2, ""),
        (3, " \t\n\r\x0b\x0c "),
        (4, words(long)),
        (5, "a"),
        (5, "a"),
        (6, "häßlich ñandú 日本語 \U0001f600"),
        (None, "no key at all"),
        (None, None),
        (7, words(30)),
        (8, words(30)),
    ]
