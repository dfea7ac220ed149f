from __future__ import annotations

import math

import numpy as np
import pytest

from tabulark.llm import components as C
from tabulark.llm import neighbours, pigeonhole
from pyspark.sql import functions as F

SCHEMA = "vec_id long, embedding array<float>, label int, raw string, part int"


def table(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, lab, "x", 3) for i, v, lab in rows], schema).repartition(4)


def cloud(n, width=16, seed=0, label=0, first=0):
    draw = np.random.default_rng(seed)
    return [(first + i, draw.standard_normal(width).astype("f4").tolist(), label) for i in range(n)]


def odd(first, label=0):
    nan, inf = math.nan, math.inf
    cells = [None, [], [0.0] * 16, [nan] * 16, [inf] + [1.0] * 15, [None] + [1.0] * 15]
    return [(first + 50 * i, v, label) for i, v in enumerate(cells)]


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


def cosine(a, b):
    a, b = np.array(a, "f4").astype("f8"), np.array(b, "f4").astype("f8")
    return float(a @ b / math.sqrt(a @ a) / math.sqrt(b @ b))


def nearest_brute(rows, k=5):
    able = [(i, v) for i, v, _ in rows if i is not None and usable(v)]
    out = {}
    for q, v in able:
        if q % 50 == 0:
            best = sorted(((-cosine(v, w), i) for i, w in able if i != q and len(w) == len(v)))[:k]
            out[q] = [(i, -s) for s, i in best]
    return {q: b for q, b in out.items() if b}


def test_nearest(spark, widths):
    rows = cloud(300) + odd(1000) + [(50 * 40, [1.0, 2.0], 0), (None, [1.0] * 16, 0)]
    rows += [(5000 + i, rows[3][1], 0) for i in range(12)] + [(6000, rows[3][1], 0), (6001, [1e-30] * 16, 0), (6050, [3e30] * 16, 0)]
    got = {}
    for r in neighbours.nearest(table(spark, rows), F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    want = nearest_brute(rows)
    assert set(got) == set(want)
    for q, best in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, len(best) + 1))
        assert [s for _, _, s in mine] == pytest.approx([s for _, s in best], abs=1e-12)
        if len({round(s, 9) for _, s in best}) == len(best):
            assert [i for _, i, _ in mine] == [i for i, _ in best]


def test_nearest_ties_go_to_the_smaller_key(spark):
    rows = [(0, [1.0, 0.0], 0)] + [(i, [0.5, 0.5], 0) for i in range(1, 9)]
    found = neighbours.nearest(table(spark, rows), F.col("vec_id") % 50 == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [1, 2, 3, 4, 5]


def test_nearest_of_few_or_none(spark):
    assert neighbours.nearest(table(spark, []), F.lit(True)).count() == 0
    assert neighbours.nearest(table(spark, odd(0)), F.lit(True)).count() == 0
    two = neighbours.nearest(table(spark, cloud(2)), F.col("vec_id") % 50 == 0).collect()
    assert [(r["query_id"], r["vec_id"]) for r in two] == [(0, 1)]


def test_bounds_hold():
    draw = np.random.default_rng(4)
    units = draw.standard_normal((200, 64))
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    codes, steps, errors = neighbours.quantised(units)
    near = (codes.astype("f8") @ codes.T.astype("f8")) * steps[:, None] * steps[None, :]
    slack = errors[:, None] + (1 + errors[:, None]) * errors[None, :]
    assert (np.abs(units @ units.T - near) <= slack + 1e-12).all()


def linked_brute(rows, least=0.93):
    n = len(rows)
    near = [[] for _ in rows]
    for a in range(n):
        for b in range(a + 1, n):
            (i, v, x), (j, w, y) = rows[a], rows[b]
            if None not in (i, j, x, y) and x == y and usable(v) and usable(w) and len(v) == len(w) and cosine(v, w) >= least:
                near[a].append(b)
                near[b].append(a)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in near[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        group = min(rows[b][0] for b in seen) if rows[a][0] is not None else None
        out.append((rows[a][0], len(near[a]), group, rows[a][0] == group))
    return sorted(out, key=str)


def test_near_vectors(spark, widths):
    draw = np.random.default_rng(9)
    rows = cloud(60, label=1) + cloud(40, seed=2, label=2, first=100) + odd(200, label=1)
    for i in range(80):
        base = np.array(rows[i % 7][1]) * draw.uniform(0.1, 9)
        rows.append((1000 + i, (base + draw.standard_normal(16) * 0.25).astype("f4").tolist(), 1 if i % 5 else None))
    rows += [(2000 + i, rows[0][1], 1) for i in range(6)] + [(None, rows[0][1], 1), (3000, [1.0, 2.0], 1), (3001, [1.0, 2.0], 1)]
    got = pigeonhole.near_vectors(table(spark, rows), chunk=25).collect()
    assert sorted((tuple(r) for r in got), key=str) == linked_brute(rows)


def test_one_key_with_several_vectors(spark):
    a, b = [1.0, 0.0, 0.0, 0.0], [0.0, 1.0, 0.0, 0.0]
    rows = [(1, a, 0), (1, b, 0), (3, a, 0), (4, [0.0, 0.0, 1.0, 0.0], 0), (4, [0.0, 0.0, 0.99, 0.05], 0), (4, a, 2)]
    got = sorted(tuple(r) for r in pigeonhole.near_vectors(table(spark, rows)).collect())
    assert got == linked_brute(rows)
    assert sorted(r[1] for r in got if r[0] == 1) == [0, 1]


def test_range_joins_multiply_less_than_all_pairs():
    draw = np.random.default_rng(2)
    x = draw.standard_normal((1000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    turned = (x @ pigeonhole.rotation(64)).astype(np.float32)
    done = 0
    for d in range(0, 64, pigeonhole.BLOCK):
        p = turned[:, d : d + pigeonhole.BLOCK]
        met = np.zeros((1000, 1000), bool)
        reach = math.sqrt(0.14 * pigeonhole.BLOCK / 64)
        for i, j in pigeonhole.near_ranges(p, p, reach):
            done += len(i) * len(j)
            met[np.ix_(i, j)] = True
        assert met[np.abs(p[:, None, :3] - p[None, :, :3]).max(axis=2) <= reach].all()
    assert done < 0.55 * 8 * 1000 * 1000


def test_links_of_earlier_strips_hold():
    root = np.arange(8)
    strips = [[(1, 7), (2, 5), (3, 4), (3, 6)], [(4, 5), (6, 7)]]
    for pairs in strips:
        i, j = np.array(pairs).T
        root = pigeonhole.settled(root, i, j)
    assert root.tolist() == [0, 1, 1, 1, 1, 1, 1, 1]


def test_a_chain_over_several_strips_is_one_component(spark):
    draw = np.random.default_rng(6)
    n, width, angle = 1800, 32, 0.36
    walk = [draw.standard_normal(width)]
    walk[0] /= np.linalg.norm(walk[0])
    while len(walk) < n:
        side = draw.standard_normal(width)
        side -= (side @ walk[-1]) * walk[-1]
        walk.append(math.cos(angle) * walk[-1] + math.sin(angle) * side / np.linalg.norm(side))
    keys = draw.permutation(n) + 100
    rows = [(int(k), v.astype("f4").tolist(), 0) for k, v in zip(keys, walk)]
    assert all(cosine(a[1], b[1]) >= 0.93 for a, b in zip(rows, rows[1:]))
    got = pigeonhole.near_vectors(table(spark, rows)).collect()
    assert len(got) == n and {r["component_id"] for r in got} == {100}
    assert [r["vec_id"] for r in got if r["kept"]] == [100]


def test_near_vectors_empty(spark):
    assert pigeonhole.near_vectors(table(spark, [])).count() == 0


def test_every_linked_pair_is_a_candidate():
    draw = np.random.default_rng(3)
    base = draw.standard_normal((150, 20))
    every = np.concatenate([base, base + draw.standard_normal(base.shape) * 0.33])
    every /= np.linalg.norm(every, axis=1, keepdims=True)
    found = set()
    for i, j in pigeonhole.candidates(every, every, 0.14):
        found |= set(zip(i.tolist(), j.tolist()))
    a, b = np.nonzero(every @ every.T >= 0.93)
    assert set(zip(a.tolist(), b.tolist())) <= found


def test_components_of_paths_stars_and_rings(spark):
    draw = np.random.default_rng(1)
    names = draw.permutation(400).tolist()
    path = list(zip(names[:150], names[1:150]))
    star = [(names[200], x) for x in names[201:300]]
    ring = [(names[300 + i], names[300 + (i + 1) % 50]) for i in range(50)] + [(names[300], names[300])]
    df = spark.createDataFrame([*path, *star, *ring, *star], "a long, b long")
    got = {r["node"]: r["component"] for r in C.components(df).collect()}
    want = {}
    for part in (names[:150], names[200:300], names[300:350]):
        want |= dict.fromkeys(part, min(part))
    assert got == want
    assert C.components(df.where("false")).count() == 0
