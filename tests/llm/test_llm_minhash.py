from __future__ import annotations

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
from helpers import WORD, awkward, documents, words

from tabulark.llm import minhash as M


def weighted(text, size=5):
    w = WORD.findall((text or "").lower())
    size = min(size, len(w))
    return Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1)) if w else Counter()


def jaccard(a, b):
    every, both = set(a) | set(b), set(a) & set(b)
    if max(a.values()) == max(b.values()) == 1:
        return len(both) / len(every)
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in every) for d in set(a) & set(b))


def brute(rows, least=0.8):
    sets = [weighted(t) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if None in (rows[a][0], rows[b][0]):
            continue
        if rows[a][0] == rows[b][0] and sets[a] or sets[a] and sets[a].keys() & sets[b].keys() and jaccard(sets[a], sets[b]) >= least:
            parent[top(a)] = top(b)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[top(i)] = min(low.get(top(i), k), k)
    return sorted(((k, low[top(i)] if k is not None else None, k is None or low[top(i)] == k) for i, (k, _) in enumerate(rows)), key=str)


def edited(text, seed, edits):
    w, draw = text.split(" "), random.Random(seed)
    for _ in range(edits):
        w[draw.randrange(len(w))] = f"new{draw.randrange(10**6)}"
    return " ".join(w)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_groups(spark):
    base = [words(200, 1000 * i) for i in range(6)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(10 + i, edited(base[i % 6], i, 1 + i % 9)) for i in range(60)]
    rows += [(100 + i, base[0].upper() if i % 2 else base[1] + " \n") for i in range(8)]
    rows += [(200, "three words here"), (201, "Three  WORDS here"), (202, "a a a a a a a b"), (203, "a a a a a a b")]
    rows += awkward(3000)
    assert found(M.near_copies(documents(spark, rows))) == brute(rows)


def test_a_chain_of_edits_is_one_group(spark):
    text, rows = words(400), []
    for i in range(30):
        rows.append((i, text))
        text = edited(text, i, 8)
    assert found(M.near_copies(documents(spark, rows))) == brute(rows)


def test_large_buckets_are_settled_by_tiles(spark):
    base = words(300)
    rows = [(i, edited(base, i, 2 + i % 12)) for i in range(70)]
    assert found(M.near_copies(documents(spark, rows), small=4, tile=9)) == brute(rows)


def test_signatures_estimate_probability_jaccard():
    draw = np.random.default_rng(2)
    for shared in (0.2, 0.5, 0.9):
        a = {int(x): int(w) for x, w in zip(draw.integers(1, 1 << 60, 300), draw.integers(1, 6, 300))}
        b = {k + (0 if draw.random() < shared else 1): w for k, w in a.items()}
        doc = np.repeat([0, 1], [len(a), len(b)])
        shingle = np.array([*a, *b], np.uint64)
        weight = np.array([*a.values(), *b.values()], float)
        signed = M.signatures(doc, shingle, weight, 2, 4096)
        true = jaccard(Counter(a), Counter(b))
        assert (signed[0] == signed[1]).mean() == pytest.approx(true, abs=0.035)
        keys = [np.array(sorted(x), np.uint64) for x in (a, b)]
        counts = [np.array([x[int(k)] for k in ks], np.int64) for x, ks in zip((a, b), keys)]
        assert M.probability_jaccard(keys[0], counts[0], keys[1], counts[1]) == pytest.approx(true)


def test_words_and_shingles():
    assert len(M.word_hashes(" a  bb\t\na ".encode())) == 3
    one, two = M.word_hashes(b"a bb a"), M.word_hashes(b"\x0ba\x0cbb\ra")
    assert (one == two).all() and one[0] == one[2] != one[1]
    assert len(M.shingles(one, 5)) == 1 and len(M.shingles(M.word_hashes(words(9).encode()), 5)) == 5
    assert len(set(M.word_hashes(("x" * 64 + " " + "x" * 128).encode()).tolist())) == 2


def test_empty_table(spark):
    assert M.near_copies(documents(spark, [(1, "x")]).where("false")).count() == 0
