from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import awkward, documents, words
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus_pipeline import packed
from tabulark.llm import packing
from tabulark.llm.packing import Packer, byte_pair_encoder, fullest, pack_documents
from tabulark.llm.queries import op1_minimum_bin_slack


@pytest.fixture(scope="module")
def slow():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def test_fullest_is_the_best_subset():
    draw = random.Random(3)
    for _ in range(300):
        counts = Counter(draw.randint(1, 30) for _ in range(draw.randint(0, 9)))
        room = draw.randint(0, 60)
        sums = {0}
        for length, n in counts.items():
            for _ in range(n):
                sums |= {s + length for s in sums if s + length <= room}
        used = fullest(counts, room)
        assert sum(k * v for k, v in used.items()) == max(sums)
        assert all(v <= counts[k] for k, v in used.items())


@pytest.mark.parametrize("lengths", [[700] * 90, [513] * 31 + [511] * 7, list(range(1, 300)), [1], []])
def test_only_the_last_window_is_short(lengths):
    packer = Packer(1024, 0)
    for i, n in enumerate(lengths):
        packer.add(i, 0, bytes(4 * n), n)
    filled = Counter()
    for _, _, n, _, _, sequence, offset in packer.drain(0):
        assert offset == filled[sequence]
        filled[sequence] += n
    assert sum(filled.values()) == sum(lengths)
    assert all(v == 1024 for s, v in filled.items() if s != max(filled))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_those_of_the_tokenizers_file(slow, text):
    assert byte_pair_encoder()(text) == slow(text)


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, "\u3000 \t" * 5000, " " * 10_000, " " * 9_999, "\x1c" * 20_000])
def test_white_space_runs_of_any_length(slow, run):
    coder = byte_pair_encoder()
    for text in (run, run + "x", "a b" + run + "'s", "x" + run + "é  " + run + "\x1c", run[:-1] + "\n7 "):
        assert coder(text) == slow(text)


def test_added_token_has_its_own_id():
    contract = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    coder = byte_pair_encoder(added=True)
    draw = random.Random(8)
    parts = ["<|endoftext|>", "<|endoftext|", "|>", " ", "\n\n", "a", " b's", "é", "12", "<|endoftext|>  "]
    texts = ["a <|endoftext|> b", *["".join(draw.choices(parts, k=draw.randint(0, 9))) for _ in range(500)]]
    for text in texts:
        assert coder(text) == contract.encode(text, add_special_tokens=False).ids
    assert coder(texts[0]) == [64, 220, 50256, 275]


def test_queries_give_the_added_token_its_id(spark, tmp_path):
    contract = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    docs = documents(spark, [(1, "a <|endoftext|> b")])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    ids = np.array(contract.encode("a <|endoftext|> b", add_special_tokens=False).ids + [0], "<u4").tobytes()
    row = op1_minimum_bin_slack(spark, str(tmp_path)).first()
    assert (row["ids_crc32"], row["doc_tokens"]) == (zlib.crc32(ids), len(ids) // 4)
    assert bytes(packed(spark, docs, str(tmp_path)).first()["ids"]) == ids


def test_pieces_are_the_documents(spark, slow):
    rows = awkward(4000) + [(i, words(i % 700, i)) for i in range(100, 400)] + [(500, "<|endoftext|> don't  stop\n\n ")]
    found = pack_documents(documents(spark, rows).repartition(3), pool=64).collect()
    want = Counter()
    for key, text in rows:
        ids = slow(text or "") + [0]
        want[key, np.array(ids, "<u4").tobytes()] += 1
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in found:
        assert len(r["ids"]) == 4 * r["length"] > 0
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], bytes(r["ids"])))
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    assert sum(sum(n for _, n in s) < 1024 for s in sequences.values()) <= 3
    got = Counter()
    for (key, total), parts in pieces.items():
        joined = b"".join(b for _, b in sorted(parts))
        assert len(joined) % (4 * total) == 0
        copies = len(joined) // (4 * total)
        if copies == 1:
            got[key, joined] += 1
        else:
            got[key, sorted(parts)[0][1]] += copies
    assert got == want


def test_empty_table(spark):
    assert pack_documents(documents(spark, [(1, "x")]).where("false")).count() == 0


def test_pieces_leave_in_bounded_batches(spark, monkeypatch):
    tasks = []
    monkeypatch.setattr("pyspark.sql.classic.dataframe.DataFrame.mapInArrow", lambda self, task, schema: tasks.append(task))
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("Task", (), {"partitionId": lambda self: 2})())
    pack_documents(documents(spark, []))
    (task,) = tasks
    texts = [words(20, i) for i in range(3000)] + [words(400_000), None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3002)), pa.array(texts)], names=["doc_id", "text"])
    parts = list(task(iter([batch])))
    assert len(parts) > 3 and max(p.num_rows for p in parts) <= 1024
    got = Counter()
    for row in pa.Table.from_batches(parts).to_pylist():
        got[row["doc_id"]] += row["length"]
    assert got == {i: len(byte_pair_encoder()(t or "")) + 1 for i, t in enumerate(texts)}
