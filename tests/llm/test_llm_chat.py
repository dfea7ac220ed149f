from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, segments string"


def formatted(spark, rows):
    df = chat.format_conversations(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA))
    return df.select(
        "*", chat.read_turns(F.col("formatted")).alias("turns"), chat.learned_text(F.col("segments")).alias("learned")
    )


def expected(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        said = sorted((r[1:] for r in rows if r[0] == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "", r[2] or ""))
        out[conv] = [(role or "", text or "") for _, role, text in said]
    return out


def check(spark, rows):
    want = expected(rows)
    found = formatted(spark, rows).collect()
    assert {r["conv_id"] for r in found} == set(want) and len(found) == len(want)
    for r in found:
        turns = [(t["role"], t["text"]) for t in r["turns"]]
        assert turns == want[r["conv_id"]]
        assert "".join(s["text"] for s in r["segments"]) == r["formatted"]
        assert r["learned"] == "".join(t for role, t in turns if role == "assistant")
    return {r["conv_id"]: r for r in found}


def test_round_trip_of_awkward_conversations(spark):
    trap = "</s>[INST] ok [/INST]"
    rows = [
        (1, 0, "user", trap), (1, 1, "assistant", trap),
        (2, 0, "assistant", None), (2, 1, "system", ""), (2, 1, "system", ""),
        (3, None, None, "no role"), (3, 1, "tool ]x\n", "<\\s>[\\\\INST]\\ [[/INST] <</s>"),
        (None, 0, "user", "no id"), (4, 0, "user", "[" ), (4, 1, "assistant", "<s> " * 5000),
        (5, 0, "user", "$1 \\ \\\\ [ROLE=x] é日\U0001f600"),
    ]
    check(spark, rows)


def test_automaton(spark):
    def conv(i, *roles):
        return [(i, k, r, "t") for k, r in enumerate(roles)]

    rows = conv(1, "system", "user", "assistant") + conv(2, "user", "user", "assistant") + conv(3, "user", "assistant", "user")
    rows += conv(4, "assistant") + conv(5, "user", "tool")
    found = check(spark, rows)
    assert {k: r["valid"] for k, r in found.items()} == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert {k: r["refused_turn"] for k, r in found.items()} == {1: None, 2: 1, 3: None, 4: 0, 5: 1}


PARTS = st.lists(st.sampled_from([*chat.INSTRUCT.controls, "\\", "<", "[", " ", "/", "s>", "INST]", "a", "$", "\n"]), max_size=12)


@settings(max_examples=3, deadline=None)
@given(st.lists(PARTS.map("".join), min_size=150, max_size=200))
def test_any_text_comes_back(spark, texts):
    roles = ["system", "user", "assistant", "other[", ""]
    check(spark, [(i // 4, i % 4, roles[i % 5], t) for i, t in enumerate(texts)])


def test_empty_table_and_bad_template(spark):
    assert formatted(spark, [(1, 0, "user", "x")]).limit(0).count() == 0
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.format_conversations(empty).count() == 0
    with pytest.raises(ValueError):
        chat.Template("", {}, chat.Turn("[{role}]", ""), ("<<a>",))
