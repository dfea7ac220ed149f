from __future__ import annotations

import hashlib
import random
import re

from helpers import awkward, documents
from pyspark.sql import functions as F

from tabulark.llm.middle import fill_in_middle, restored


def brute(rows, rate=100, spm=50, seed=7):
    out = []
    for doc, text in rows:
        text = text or ""
        units = re.findall(r"[^\n]*\n|[^\n]+", text)
        n = len(units)
        digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
        h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        p, m, s = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, n)))
        if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
            out.append((doc, n, "plain", None, None, text))
        elif h[3] % 100 < spm:
            out.append((doc, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"))
        else:
            out.append((doc, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"))
    return sorted(out, key=str)


def found(df):
    names = ("doc_id", "n", "form", "prefix_chars", "middle_chars", "output")
    return sorted((tuple(r[c] for c in names) for r in df.collect()), key=str)


def cases():
    rng = random.Random(5)
    pieces = ["a", "é日\U0001f600", "\n", "\n\n", "\r\n", "<", "<P", "P>", " ", " ", "\x00", "<S"]
    rows = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 30)))) for i in range(300)]
    rows += [(1000, "x<M>y\n"), (1001, "<P>"), (1002, "\n"), (1003, "a"), (1004, "a\n"), (1005, "l\n" * 200_000), (-3, "neg\native")]
    return rows + [(1003, "a"), (None, "b\nc")] + awkward(500)


def test_against_brute_force(spark):
    rows = cases()
    assert found(fill_in_middle(documents(spark, rows))) == brute(rows)
    assert found(fill_in_middle(documents(spark, rows), rate=60, spm=20, seed=11)) == brute(rows, 60, 20, 11)


def test_texts_come_back(spark):
    rows = cases()
    made = fill_in_middle(documents(spark, rows)).withColumn("back", restored(F.col("output"), F.col("form")))
    assert made.where(F.col("back") != F.coalesce("text", F.lit(""))).count() == 0
    assert sorted((r["back"] for r in made.collect())) == sorted(r[1] or "" for r in rows)


def test_long_text_among_others_in_small_batches(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    rows = [(i, f"line {i}\n" * (400_000 if i == 4 else i)) for i in range(10)]
    assert found(fill_in_middle(documents(spark, rows))) == brute(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_other_columns_and_empty_table(spark):
    docs = documents(spark, [(1, "a\nb", "en", "s")]).withColumns({"row": F.lit("r"), "h1": F.lit(3), "output": F.lit("old")})
    out = fill_in_middle(docs)
    assert set(out.columns) == {*docs.columns, "n", "form", "prefix_chars", "middle_chars"}
    row = out.first()
    assert row["row"] == "r" and row["h1"] == 3 and row["key"] == 7 and row["output"] != "old"
    assert fill_in_middle(docs.limit(0)).count() == 0
