from __future__ import annotations

import datetime

import pytest
from pyspark.sql import functions as F

from tabulark.functions.recode import emphasis, fold_rare, inverted, recode
from tabulark.operators import project, setops
from tabulark.session import pin, shared_folder, spread
from tabulark.sources import files
from tabulark.streaming import jobs


def test_csv_keeps_awkward_cells(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b", c', None), (2, "line\\n", 2.5)], "id int, s string, v double")
    back = files.round_trip(rows, str(tmp_path / "x"))
    assert sorted(back.collect()) == sorted(rows.collect())
    assert back.schema == rows.schema
    guessed = files.read_csv(spark, str(tmp_path / "x"))
    assert dict(guessed.dtypes) == {"id": "int", "s": "string", "v": "double"}


def test_empty_category_list_means_all(spark):
    docs = spark.createDataFrame([("a",), ("b",)], "k string")
    assert files.load_corpus(docs, "k", []).count() == 2
    assert files.load_corpus(docs, "k", ["a"]).count() == 1


def test_unwanted_lines_go(spark):
    docs = spark.createDataFrame([("From: me\n\n> quoted\nkept text\n-- \nname",)], "t string")
    assert files.cleaned_corpus(docs, "t").first()["t"] == "kept text"


def test_prediction_store_reads_only_chosen_models(spark, tmp_path):
    long = spark.createDataFrame([(i, m, float(i)) for i in range(3) for m in "abc"], "id int, model string, pred double")
    files.write_predictions(long, str(tmp_path / "p"))
    chosen = files.read_predictions(spark, str(tmp_path / "p"), ["a", "c"])
    assert chosen.count() == 6
    assert "PartitionFilters: [model" in chosen._jdf.queryExecution().toString()


def test_read_many(spark, tmp_path):
    paths = {}
    for name in "ab":
        paths[name] = str(tmp_path / name)
        files.write_csv(spark.createDataFrame([(1, 0.5)], "id int, pred double"), paths[name])
    assert sorted(r["model"] for r in files.read_many(spark, paths, "id int, pred double").collect()) == ["a", "b"]


def test_submission_is_keyed(spark):
    ids = spark.createDataFrame([(2,), (1,)], "id int")
    scored = spark.createDataFrame([(1, 0.1), (2, 0.2)], "id int, prediction double")
    assert {r["id"]: r["prediction"] for r in files.submission(ids, scored, "id").collect()} == {1: 0.1, 2: 0.2}


def test_recodes(spark):
    rows = spark.createDataFrame([("F",), ("P",), (None,)], "s string")
    got = rows.select(recode(F.col("s"), {"F": "done"}).alias("r"), fold_rare(F.col("s"), ["F"]).alias("f")).collect()
    assert [r["r"] for r in got] == ["done", "P", None]
    assert [r["f"] for r in got] == ["F", "other", "other"]
    assert inverted({0: "x", 1: "y", 4: "x"}) == {"x": 4, "y": 1}
    weights = rows.limit(2).select(emphasis(F.col("s"), "F").alias("w"), emphasis(F.col("s"), "all").alias("a")).collect()
    assert [(r["w"], r["a"]) for r in weights] == [(0.8, 0.8), (0.15, 0.8)]


def test_too_many_levels_are_refused(spark):
    with pytest.raises(ValueError, match="more than 5"):
        project.distinct_values(spark.range(6), "id", 5)


def test_parts_come_back(spark):
    parts = {"train": spark.range(3), "test": spark.range(3, 5)}
    both = setops.stacked(parts)
    assert both.count() == 5
    assert sorted(r["id"] for r in setops.part_of(both, "test").collect()) == [3, 4]


def test_columns_by_kind(spark):
    rows = spark.createDataFrame([(1, "a", datetime.date(2024, 1, 1))], "n int, s string, d date")
    assert project.columns_by_kind(rows) == {"number": ["n"], "text": ["s"], "other": ["d"]}


def test_spread_leaves_wide_scans_alone(spark):
    wide = spark.range(0, 100, 1, 32)
    assert spread(wide, "id") is wide
    assert spread(spark.range(0, 100, 1, 1), "id").count() == 100


def test_pinned_rows_live_in_the_shared_folder(spark):
    assert shared_folder(spark) == spark.sparkContext.getCheckpointDir()
    pinned = pin(spark.range(4))
    assert "ExistingRDD" in pinned._jdf.queryExecution().toString()
    assert pinned.count() == 4


def moment(minute):
    return datetime.datetime(2024, 1, 1, 0, 0) + datetime.timedelta(minutes=minute)


def test_late_rows_are_left_out(spark, tmp_path):
    """One file per batch: the last one brings a row behind the watermark, which lags a batch."""
    schema = "ts timestamp, value double"
    batches = [
        [(moment(5), 1.0), (moment(15), 3.0)],
        [(moment(200), 5.0)],
        [(moment(210), 6.0)],
        [(moment(7), 100.0), (moment(400), 7.0)],
    ]
    for i, batch in enumerate(batches):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in" / f"part{i}"))
    stream = (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
        .parquet(str(tmp_path / "in"))
    )
    stats = jobs.window_statistics(stream, "ts", "value", "1 hour", late="10 minutes")
    got = {r["window_start"]: (r["n"], r["mean_value"]) for r in jobs.drained(stats, "late").collect()}
    assert got == {moment(0): (2, 2.0), moment(180): (2, 5.5)}


def test_file_stream_reads_files_and_folders(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "t.parquet"))
    spark.range(9).write.parquet(str(tmp_path / "other.parquet"))
    assert jobs.drained(jobs.file_stream(spark, str(tmp_path), "t"), "copy").count() == 5
