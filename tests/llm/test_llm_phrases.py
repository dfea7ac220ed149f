from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import awkward, documents, words

from tabulark.llm import phrases
from tabulark.llm.phrases import collocations, folded, phrase_counts


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_counts(rows, most=3):
    seen = Counter()
    for row in rows:
        lang = (row[2] if len(row) > 2 else None) or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(row[1])):
            found = re.findall(r"[^\x20\x09]+", piece)
            seen[lang, ""] += len(found)
            for k in range(1, most + 1):
                for i in range(len(found) - k + 1):
                    seen[lang, " ".join(found[i : i + k])] += 1
    return seen


def brute(rows, low=2, high=3, least=10, held=50, top=2000):
    seen = brute_counts(rows, high)
    cand = {p: a for p, a in seen.items() if a >= least and low <= len(p[1].split(" ")) <= high}
    out = []
    for (lang, phrase), a in cand.items():
        ws = phrase.split(" ")
        if any(
            o == lang and len(p.split(" ")) > len(ws) and f" {phrase} " in f" {p} " and 100 * b >= held * a
            for (o, p), b in cand.items()
        ):
            continue
        cuts = []
        for k in range(1, len(ws)):
            left, right = seen[lang, " ".join(ws[:k])], seen[lang, " ".join(ws[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, phrase, a, left, right, seen[lang, ""], score))
    ranked = []
    for lang in {r[0] for r in out}:
        own = sorted((r for r in out if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        ranked += [(r[0], i, *r[1:]) for i, r in enumerate(own[:top], 1)]
    return sorted(ranked)


def made(n=300, vocabulary=12, seed=3):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)] + ["É", "日本", "A.b", "x\ty", "\x0b", "u v"]
    rows = []
    for i in range(n):
        text = "".join(rng.choice(names) + rng.choice(["  ", " ", " ", "\t", ". ", "\n", ", "]) for _ in range(rng.randint(0, 40)))
        rows.append((i, text, rng.choice(["en", "fr", None, "und"])))
    return rows


def found(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


@pytest.mark.parametrize("budget", [phrases.BUDGET, 40])
def test_against_brute_force(spark, budget):
    rows = made() + awkward(300)
    assert found(collocations(documents(spark, rows), budget=budget)) == brute(rows)


def test_small_stretches_and_long_phrases(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SLICE", 64)
    rows = made(80, vocabulary=3)
    texts = pa.array([r[1] for r in rows])
    whole = [t for t, _ in phrases.stretches(texts)]
    assert b"".join(t.tobytes() for t in whole) == "".join(r[1] for r in rows).encode()
    got = found(collocations(documents(spark, rows), words=(2, 5), least=4, budget=25))
    assert got == brute(rows, 2, 5, 4)


@pytest.mark.parametrize("budget", [phrases.BUDGET, 30])
def test_counts_of_a_very_common_word_and_pair(spark, widths, budget):
    rows = [(i, "hot pair " * (30 if i % 3 else 2) + words(3, i), "en") for i in range(60)]
    got = {(r["lang"], r["phrase"]): r["n"] for r in phrase_counts(documents(spark, rows), budget=budget).collect()}
    assert got == {k: v for k, v in brute_counts(rows).items() if v >= 10 or k[1] == ""}


def test_long_text_without_a_break_and_empty_table(spark):
    rows = [(1, "la " * 400_000, "en"), (2, None, "en"), (3, "la", None)]
    docs = documents(spark, rows)
    assert found(collocations(docs, words=(2, 2))) == [("en", 1, "la la", 399_999, 400_000, 400_000, 400_000, 999_995)]
    assert collocations(docs.limit(0)).count() == 0


def test_products_beyond_64_bits(spark):
    a = 3_000_000_000
    counts = spark.createDataFrame([("en", 1, "x", 2 * a), ("en", 1, "y", a + 1), ("en", 2, "x y", a)], "lang string, size int, phrase string, n long")
    row = phrases.scored(counts, counts.where("size = 2").withColumnRenamed("n", "a")).first()
    assert row["score"] == 1_000_000 * a * a // (2 * a * (a + 1))


def test_folding_of_wide_rows():
    rng = np.random.default_rng(1)
    rows = rng.integers(0, 3, (500, 6)) * (1 << 20)
    kept, n = folded(rows)
    want = Counter(map(tuple, rows.tolist()))
    assert [tuple(r) for r in kept.tolist()] == sorted(want) and dict(zip(map(tuple, kept.tolist()), n.tolist())) == want


def test_groups_stay_within_the_budget():
    counts = {c: 7 * (c % 5) for c in range(1000)} | {5: 900}
    cell, cells = phrases.classes_cut(counts, 100)
    inner = {int(cell[5]) + k: 20 for k in range(int(cells[5]) - 1)} | {int(cell[5] + cells[5] - 1): 250}
    plan = phrases.packed_groups(cell, cells, counts, inner, 100)
    held = Counter()
    for c, n in counts.items():
        if c != 5:
            held[int(plan.group[cell[c]])] += n
    assert max(held.values()) <= 100 and sum(held.values()) > 60 * len(held)
    assert plan.groups.max() == 3 and not plan.parted[list(held)].any()
