from __future__ import annotations

import hashlib
import random
from collections import Counter

import pytest
from helpers import awkward, documents, words
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulark.llm import suffixes as S


@given(st.lists(st.integers(1, 3), max_size=60), st.integers(1, 4))
def test_suffix_array(symbols, times):
    text = symbols * times + [0]
    assert S.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_groups_are_lyndon_prefixes():
    draw = random.Random(5)
    for _ in range(200):
        text = [draw.randint(1, 3) for _ in range(draw.randint(1, 30))] + [0]
        group, _ = S.lyndon_groups(text)

        def prefix(i):
            best = 1
            for e in range(i + 1, len(text) + 1):
                w = text[i:e]
                if all(w < w[k:] for k in range(1, len(w))):
                    best = e - i
            return tuple(text[i : i + best])

        names = {}
        for i in range(len(text)):
            names.setdefault(group[i], set()).add(prefix(i))
        assert all(len(v) == 1 for v in names.values())
        ordered = [next(iter(names[g])) for g in sorted(names)]
        assert ordered == sorted(ordered) and len(set(ordered)) == len(ordered)


@given(st.lists(st.binary(max_size=40).map(lambda b: bytes(c % 3 for c in b)), max_size=6))
def test_repeated_places(strings):
    strings = [s for s in strings if s]
    every = Counter(s[i : i + 5] for s in strings for i in range(len(s) - 4))
    want = [[i for i in range(len(s) - 4) if every[s[i : i + 5]] > 1] for s in strings]
    assert [sorted(x) for x in S.repeated_places(strings, 5)] == want if strings else True


def brute(rows, window=200):
    texts = [(k, (t or "").encode()) for k, t in rows]
    every = Counter(t[i : i + window] for _, t in texts for i in range(len(t) - window + 1))
    out = []
    for k, t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - window + 1):
            if every[t[i : i + window]] > 1:
                gone[i : i + window] = b"\1" * window
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((k, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    out = df.select("doc_id", "n_bytes", S.removed(F.col("spans")), F.size("spans"), F.sha2("kept", 256))
    return sorted((tuple(r) for r in out.collect()), key=str)


def prose(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("etaonié", k=draw.randint(2, 7))) for _ in range(n))


def fixture():
    passage, line = prose(1, 70), prose(2, 20)
    rows = [(100 + i, f"{prose(i + 10, 40)} {passage} {prose(i + 500, 30)}") for i in range(40)]
    rows += [(200 + i, f"{prose(i + 900, 60)}\n{line}\n{prose(i + 990, 60)}") for i in range(40)]
    rows += [(300 + i, passage[i : i + 260]) for i in range(0, 90, 3)]
    rows += [(400, "x" * 700), (401, "ab" * 300), (402, passage * 3), (403, prose(7, 9) + passage[:199]), (404, "x" * 200)]
    rows += [(500 + i, prose(3000, 80)[: 500 - i]) for i in range(3)] + awkward(900)
    return rows


@pytest.mark.parametrize("crowd", [4000, 5])
def test_same_as_brute_force(spark, crowd):
    rows = fixture()
    assert found(S.drop_repeated_strings(documents(spark, rows), crowd=crowd)) == brute(rows)


def test_null_and_repeated_keys_are_documents_of_their_own(spark):
    passage = prose(1, 60)[:250]
    rows = [(None if i % 3 else 7, prose(i + 50, 12) + "\n" * (i % 40) + passage + prose(i + 9000, 8)) for i in range(1500)]
    assert found(S.drop_repeated_strings(documents(spark, rows))) == brute(rows)


def test_long_texts_are_cut_where_it_does_not_matter(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 1000)
    rows = [(1, prose(4, 900)), (2, prose(5, 20) + prose(4, 900)[500:4000] + prose(6, 50)), (3, words(500) + words(400))]
    texts = [t.encode() for _, t in rows]
    whole = {}
    for number, _, start, count, _, piece, base in S.runs_of(texts, 200, 64):
        for s, c in zip(start.tolist(), count.tolist()):
            for p in range(s, s + c):
                whole[number, base + p] = piece[p : p + 200]
    assert whole == {(n, i): t[i : i + 200] for n, t in enumerate(texts) for i in range(len(t) - 199)}
    assert found(S.drop_repeated_strings(documents(spark, rows))) == brute(rows)


def test_empty_table(spark):
    assert S.drop_repeated_strings(documents(spark, [(1, "x")]).where("false")).count() == 0
