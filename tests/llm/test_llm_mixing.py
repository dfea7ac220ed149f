from __future__ import annotations

from collections import defaultdict

import pytest
from helpers import WORD, awkward, documents, words

from tabulark.llm.mixing import WEIGHTS, mix_sources, repeated


def targets(sizes, share=1.5, cap=2.0):
    """Clamp and share again until no source is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= cap * sizes[s]}
        if not over:
            out |= {s: level * weight[s] for s in free}
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
        free -= over
    return out


def judged(docs):
    rows = mix_sources(docs).collect()
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        n = len(WORD.findall(r["text"] or ""))
        assert r["size"] == n and 0 <= r["copies"] <= 2
        sizes[r["source"]] += n
        taken[r["source"]] += n * r["copies"]
    want = targets(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6)
    return rows, sizes, taken, want


def test_targets_and_taken_words(spark, widths):
    rows = [(i, words(1 + i * 7 % 90, i), "en", f"s{i % 5}" if i % 3 else "hot") for i in range(900)]
    rows += [(1000 + i, words(9, i), "en", None) for i in range(40)]
    _, _, taken, want = judged(documents(spark, rows))
    for s, n in taken.items():
        assert abs(n - want[s]) <= 90


def test_awkward_rows(spark):
    rows = [(*r, "en", s) for r, s in zip(awkward(3000), ["a", "b", None, "a", "b", "b", "c", None, "z", "c", "é"])]
    found, sizes, _, _ = judged(documents(spark, rows))
    assert len(found) == len(rows) and sizes["z"] == 0


def test_same_again_and_repeated(spark):
    docs = documents(spark, [(i, words(5 + i % 3, i), "en", "ab"[i % 2]) for i in range(200)])
    one, two = (sorted((r["doc_id"], r["copies"]) for r in mix_sources(docs).collect()) for _ in range(2))
    assert one == two
    mix = repeated(mix_sources(docs), docs.columns)
    assert mix.columns == docs.columns and mix.count() == sum(c for _, c in one)
    assert mix_sources(docs.limit(0)).count() == 0


def test_many_copies_of_one_size(spark):
    docs = documents(spark, [(i, words(10, i), "en", "hot" if i < 600 else f"s{i}") for i in range(610)])
    _, _, taken, want = judged(docs)
    assert abs(taken["hot"] - want["hot"]) <= 10
