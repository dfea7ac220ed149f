from __future__ import annotations

import math
import random
import re
import string
from collections import Counter

import pytest
from helpers import awkward, documents
from pyspark.sql import functions as F

from tabulark.llm import secrets as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def drawn(seed, alphabet, n):
    return "".join(random.Random(seed).choices(alphabet, k=n))


RUN_20 = "[A-Za-z0-9+/_-]{20}"
HEX, B64 = "0123456789abcdef", string.ascii_letters + string.digits + "+/"


def texts():
    return [
        "password: token: abcdefgh token=short secret = 'abc.def' API_KEY=\"x\" apikey:ZZZZZZ",
        "é日\U0001f600 AKIA" + "A" * 16 + " AKIAAKIA" + "B" * 11 + " AKIA" + "C" * 15,
        "00" * 12 + "g" + "ab" * 11 + " " + "cafe" * 6 + "\n" + "token=" + "0" * 30,
        "tokentoken==abcdef secret=secret=secret=abcdefg passwd\"  :  'hunter22222",
        " ".join(f"token={drawn(i, HEX, 18)}" for i in range(60)),
    ]


def test_base_spans(spark):
    rows = [(100 + i, t) for i, t in enumerate(texts())] + awkward(3000)
    got = S.find_secrets(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    want = sorted((k, str(base(t or ""))) for k, t in rows if k is not None)
    mine = [(r["doc_id"], str([tuple(s) for s in r["spans"] if s["kind"] != S.RANDOM])) for r in got if r["doc_id"] is not None]
    assert sorted(mine) == want


def test_random_tokens_are_found_and_words_are_not(spark):
    rows = [(i, f"some text {drawn(i, B64, 40)} more") for i in range(150)]
    rows += [(1000 + i, "path Foo1FooFooFooFooFooFooFooFooFooFoo1 aaaaaaaaaaBBBBBBBBBB1111111111 verylongwordwithoutdigits") for i in range(50)]
    spans = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == S.RANDOM] for r in S.find_secrets(documents(spark, rows)).collect()}
    hits = sum(bool(spans[i]) for i in range(150))
    assert hits >= 130
    assert not any(spans[1000 + i] for i in range(50))
    for i in range(150):
        for s in spans[i]:
            assert rows[i][1][s["start"] : s["end"]] == drawn(i, B64, 40)


def test_random_tokens_have_even_p(spark):
    rows = [(drawn(i, HEX, 40),) for i in range(1500)]
    p = [r[0] for r in spark.createDataFrame(rows, "t string").select(S.battery(F.col("t"))["p"]).collect()]
    assert 0.4 < sum(p) / len(p) < 0.6 and sum(x < 0.05 for x in p) / len(p) < 0.1


def tail(x):
    return math.erfc(x / math.sqrt(2)) / 2


def brute_p(token):
    """Encoding and combined p, with the tails of the standard library."""
    fit = next((e for e in S.ENCODINGS if re.search(e.regex, token)), None)
    if fit is None:
        return None
    v = [fit.alphabet.index(c) for c in token.rstrip("=")]
    n, k = len(v), len(fit.alphabet)
    chi, free = sum(v.count(c) ** 2 for c in range(k)) * k / n - n, k - 1
    spread = 2 / (9 * free)
    one = tail(((max(chi, 0) / free) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    bits = [2 * x >= k for x in v]
    high, count = sum(bits), 1 + sum(a != b for a, b in zip(bits, bits[1:]))
    mean = 2 * high * (n - high) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    two = 2 * tail(abs((count - mean) / math.sqrt(variance))) if variance > 0 else 0.0
    off = [x - sum(v) / n for x in v]
    total = sum(x * x for x in off)
    r = sum(a * b for a, b in zip(off, off[1:])) / total if total else 0.0
    three = 2 * tail(abs((r + 1 / (n - 1)) * math.sqrt(n - 1))) if total else 0.0
    half = -sum(math.log(max(min(p, 1.0), S.LEAST_P)) for p in (one, two, three))
    return fit.name, math.exp(-half) * (1 + half + half * half / 2)


def tokens_of_all_kinds():
    out = [drawn(i, e.alphabet, 20 + 7 * i % 150) for i, e in enumerate(S.ENCODINGS * 12)]
    out += ["a1" * 20, "ab1" * 30, "A" * 30 + "1", "0123456789abcdef" * 2, "Zz9" * 9 + "==", "words-and_More9-" * 3, "a+b_1C" * 5, "z" * 25]
    return out


def test_battery_against_brute_force(spark):
    tokens = tokens_of_all_kinds()
    got = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", S.battery(F.col("t")).alias("b")).collect()
    for r in got:
        want = brute_p(r["t"])
        assert (r["b"] is None) == (want is None), r["t"]
        if want:
            assert r["b"]["encoding"] == want[0] and math.isclose(r["b"]["p"], want[1], rel_tol=1e-8, abs_tol=1e-13), r["t"]


def test_values_behind_names_and_in_paths(spark):
    made = {i: drawn(i, B64[:62], 40) for i in range(200)}
    forms = ["SESSION_KEY={}", "id={}&x=1", "keys/prod-{}", "a_b/{}/c-d"]
    rows = [(i, "see " + forms[i % 4].format(v) + " there") for i, v in made.items()]
    rows += [(1000 + i, f"NAME=some-Long9-word_with-parts/Of9Paths/And9more{'abc' * (i % 5)}") for i in range(100)]
    found = {r["doc_id"]: [s for s in r["spans"] if s["kind"] == S.RANDOM] for r in S.find_secrets(documents(spark, rows)).collect()}
    hits = sum(any(made[i] in rows[i][1][s["start"] : s["end"]] for s in found[i]) for i in made)
    false = sum(len(found[1000 + i]) for i in range(100))
    assert hits >= 160 and false <= 0.1 * (hits + false)


def test_spans_against_brute_force(spark):
    rows = [(i, f"{w} {t} {w}={t[:25]}/x-{t}") for i, t in enumerate(tokens_of_all_kinds()) for w in ("note",)]
    tested, histogram = {}, Counter()
    for doc, text in rows:
        spans = {m.span() for p in S.TOKENS for m in re.finditer(p, text)}
        taken = [s for s in base(text)]
        tested[doc] = []
        for a, b in sorted(spans):
            p = brute_p(text[a:b])
            if p and not any(x < b and a < y for x, _, y, _ in taken):
                band = max([x for x in S.BANDS if b - a >= x], default=0)
                tested[doc].append((a, b, f"{p[0]}:{band}", p[1]))
                histogram[f"{p[0]}:{band}", min(int(p[1] * S.BINS), S.BINS - 1)] += 1
    limits = S.cuts([{"stratum": k, "bin": i, "n": n} for (k, i), n in histogram.items()], 0.1)
    want = {}
    for doc, all_tested in tested.items():
        good = [(a, b) for a, b, k, p in all_tested if p >= limits[k]]
        want[doc] = sorted((a, b) for a, b in good if not any(x <= a and b <= y and y - x > b - a for x, y in good))
    got = {r["doc_id"]: sorted((s["start"], s["end"]) for s in r["spans"] if s["kind"] == S.RANDOM) for r in S.find_secrets(documents(spark, rows)).collect()}
    assert got == want and sum(map(len, want.values())) > 40


def test_the_plan_stays_small(spark):
    text = spark.createDataFrame([("x",)], "t string").select(S.battery(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert len(text) < 100_000


def test_cuts():
    even = [{"stratum": "a", "bin": b, "n": 5} for b in range(S.BINS)]
    assert S.cuts(even, 0.1) == {"a": 0.0}
    assert S.cuts([*even, {"stratum": "a", "bin": 0, "n": 5000}], 0.1)["a"] > 0
    assert S.cuts([{"stratum": "a", "bin": 0, "n": 9}], 0.1) == {"a": S.SURE}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 101])
def test_running_totals(spark, n):
    sizes = [random.Random(n).randint(0, 9) for _ in range(n)]
    df = spark.createDataFrame([(sizes,)], "s array<long>")
    assert df.select(S.running_totals(F.col("s"))).first()[0] == [sum(sizes[:i]) for i in range(n)]


def test_empty_table(spark):
    assert S.find_secrets(documents(spark, [(1, "x")]).where("false")).count() == 0


def test_no_python_in_the_plan(spark):
    plan = S.find_secrets(documents(spark, [(1, "x")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_text_is_searched_as_often_for_many_matches_as_for_one(spark):
    # What a lambda names as a whole expression is worked out again for every element.
    for regex, group in ((S.TOKENS[0], 0), (S.PATTERNS[0].regex, S.PATTERNS[0].group)):
        plan = spark.createDataFrame([("x",)], "t string").select(S.matches(F.col("t"), regex, group))._jdf.queryExecution().analyzed().toJSON()
        assert plan.count("expressions.RegExpExtractAll\"") <= 3 and plan.count("expressions.StringSplit\"") <= 2
    text = "".join(f"token: {drawn(i, HEX, 24)}{'é' * (i % 3)} " for i in range(3000))
    got = spark.createDataFrame([(text,)], "t string").select(S.matches(F.col("t"), S.PATTERNS[2].regex)).first()[0]
    assert [(m["start"], m["end"], m["part"]) for m in got] == [(*m.span(), m[0]) for m in re.finditer("[0-9a-f]{24,}", text)]


def test_texts_are_searched_for_every_pattern_and_alphabet(spark):
    held = ["AKIA" + "Z" * 16, "0123456789ab" * 2, "x " + "a-_" * 7, "b+/" * 7 + "==", "password = hunter22", "API_KEY:abcdef"]
    bare = ["", "a : b = c", "AKIA" + "Z" * 15, "word " * 50, "password hunter22"]
    rows = spark.createDataFrame([(t,) for t in held + bare], "t string")
    for r in rows.select("t", *[c.alias(n) for n, c in zip(("runs", "assigned"), S.searched(F.col("t")), strict=True)]).collect():
        full = [r["t"] if re.search(RUN_20, r["t"]) else "", r["t"] if ASSIGN.search(r["t"]) else ""]
        assert [r["runs"], r["assigned"]] == full and any(full) == (r["t"] in held)
