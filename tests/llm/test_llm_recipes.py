from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from helpers import awkward, documents, words

from tabulark.llm import recipes
from tabulark.llm.recipes import exact_copies


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for doc, text in rows:
        groups[normal(text)].append(doc)
    out = []
    for text, keys in groups.items():
        some = [k for k in keys if k is not None]
        keep = min(some) if some else None
        out += [(k, keep, len(keys), hashlib.sha256(text.encode()).hexdigest()) for k in keys]
    return sorted(out, key=str)


def check(df, rows):
    got = df.collect()
    assert sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got), key=str) == brute(rows)
    # One row of each text stays, and it has the key of its group.
    stay = [r for r in got if r["kept"]]
    assert sorted(r["text_sha256"] for r in stay) == sorted({r["text_sha256"] for r in got})
    assert all(r["doc_id"] == r["keep_id"] for r in stay)


def cases():
    rng = random.Random(2)
    base = ["", "a", " ", "\t\n", "a b", "é b", words(900), words(900, 5), "z" * 70_000, "z" * 70_001, "ab" * 40_000]
    rows = []
    for i in range(200):
        text = rng.choice(base)
        rows.append((rng.randint(0, 150), text.replace(" ", rng.choice([" ", "  ", "\n", " \t"]))))
    # Equal but for one letter in the middle of a long text.
    long = words(6000)
    rows += [(900 + i, long[: 30_000 + i] + "#" + long[30_001 + i :]) for i in range(4)] + [(899, long), (950, long), (None, long)]
    return rows + awkward(3000)


@pytest.mark.parametrize("bits", [64, 2, 0])
def test_against_brute_force_whatever_the_prints(spark, bits):
    rows = cases()
    check(exact_copies(documents(spark, rows), bits=bits), rows)


def test_one_group_with_most_rows(spark, widths):
    rows = [(i, words(400)) for i in range(500)] + [(1000 + i, words(50, i)) for i in range(60)]
    check(exact_copies(documents(spark, rows)), rows)


def test_a_text_of_many_store_rows(spark, monkeypatch):
    monkeypatch.setattr(recipes, "ROW", recipes.MOST)
    rng = random.Random(1)
    long = " ".join(str(rng.random()) for _ in range(60_000))
    rows = [(3, long), (1, long.replace(" ", "\n", 7)), (2, long + "x"), (4, "x"), (5, long[1:])]
    for bits in (64, 1):
        check(exact_copies(documents(spark, rows), bits=bits), rows)


def test_chunks_depend_on_content_only():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 123, 300_000, dtype=np.uint8)

    def chunks(data):
        ends = recipes.chunk_ends(recipes.cuts(data, recipes.CUT_BITS), 0, len(data), recipes.LEAST, recipes.MOST)
        assert max(np.diff([0, *ends])) <= recipes.MOST and ends[-1] == len(data)
        return {data[a:b].tobytes() for a, b in zip([0, *ends], ends)}

    whole = chunks(text)
    moved = chunks(np.concatenate([text[:1000], np.frombuffer(b"inserted", np.uint8), text[1000:]]))
    assert len(whole - moved) <= 3 and 80 < len(whole) < 300


def test_empty_table_and_other_columns(spark):
    docs = documents(spark, [(1, "a"), (2, "a")])
    assert exact_copies(docs.limit(0)).count() == 0
    assert [r["kept"] for r in exact_copies(docs).orderBy("doc_id").collect()] == [True, False]
