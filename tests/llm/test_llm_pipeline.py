"""The pipeline's stages, each on its own input, against the brute-force forms of the operators."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import __spark_entry__ as entry
import corpus_pipeline
from helpers import WORD
from pyspark.sql import functions as F
from test_llm_language import A, B, spoken
from test_llm_lines import brute as brute_lines
from test_llm_minhash import brute as brute_groups
from test_llm_minhash import edited
from test_llm_mixing import targets

from tabulark.llm.packing import byte_pair_encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def rows():
    line = "a line of forty characters and more that many documents share"
    out = [(i, spoken(i, 60, A if i % 2 else B), "aa" if i % 2 else "bb", f"s{i % 4}") for i in range(60)]
    out += [(100 + i, edited(out[i][1], i, 1), out[i][2], "s1") for i in range(12)]
    out += [(200 + i, out[0][1], "bb", "hot") for i in range(20)]
    out += [(300 + i, f"{line}\n{spoken(900 + i, 40, A)}", "aa", None) for i in range(8)]
    out += [(400, "123 456 !!", None, "s0"), (401, None, None, "s0"), (402, "", "aa", "s0"), (403, "ka", "aa", "s2")]
    return [(*r, 0) for r in out]


def stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name}"
        stage(spark, held[-1], folder).write.parquet(path)
        held.append(spark.read.parquet(path))
    return held


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs, named, lines, single, mixed, packed = stages(spark, str(tmp_path))
    assert all(d.columns == docs.columns for d in (named, lines, single, mixed))

    assert {r["doc_id"] for r in docs.collect()} - {r["doc_id"] for r in named.collect()} == {400, 401, 402}
    assert sorted(texts(lines)) == sorted((k, t) for k, t, _, _ in brute_lines(texts(named)))
    stay = {k for k, _, kept in brute_groups(texts(lines)) if kept}
    assert sorted(texts(single)) == sorted((k, t) for k, t in texts(lines) if k in stay)

    sizes, taken, size_of = defaultdict(int), defaultdict(int), {}
    for r in single.collect():
        size_of[r["doc_id"]] = len(WORD.findall(r["text"]))
        sizes[r["source"]] += size_of[r["doc_id"]]
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert max(copies.values()) <= 2 and set(copies) <= set(size_of)
    for r in mixed.collect():
        taken[r["source"]] += size_of[r["doc_id"]]
    for source, aim in targets(sizes).items():
        assert abs(taken[source] - aim) <= 60

    ids = Counter()
    for r in mixed.collect():
        ids[r["doc_id"]] += len(byte_pair_encoder()(r["text"])) + 1
    got = {r["doc_id"]: r["n"] for r in packed.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert got == dict(ids)
    whole = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).collect()
    assert max(r["n"] for r in whole) <= 1024

    run = corpus_pipeline.run(spark, str(tmp_path))
    assert run.columns == packed.columns
    assert run.agg(F.sum("length")).first()[0] == sum(ids.values())


def test_registered_names():
    numbers = [int(m[1]) for n in entry.queries() if (m := re.match(r"op(\d+)_", n))]
    assert sorted(numbers) == list(range(1, 14))
    assert "pipeline" in entry.queries() and corpus_pipeline.ORACLE_SQL is None


def test_queries_run_and_match_their_sql(spark, sf):
    from pathlib import Path

    import duckdb

    duck = duckdb.connect()
    for path in Path(sf).glob("*.parquet"):
        duck.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    for name, sql in entry.MORE_SQL.items():
        found = entry.queries()[name](spark, sf)
        wanted = duck.execute(sql).df()
        key = wanted.columns[0]
        mine = sorted(map(str, found.select(*wanted.columns).toPandas().sort_values(key).itertuples(index=False, name=None)))
        assert mine == sorted(map(str, wanted.itertuples(index=False, name=None)))
