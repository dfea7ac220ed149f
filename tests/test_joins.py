from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tabulark.operators import joins


@pytest.fixture(scope="module")
def sides(spark):
    big = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    small = big.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where("k <> 'k7'")
    return big, small


def pairs(df):
    return sorted((r["id"], r["k"], r["n"]) for r in df.select("id", "k", "n").collect())


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("weight", [None, "n"])
def test_salted_join_equals_plain_join(sides, how, weight):
    big, small = sides
    want = {(r["id"], r["k"]): r["n"] for r in big.join(small, "k", how).collect()}
    got = joins.salted_join(big, small, ["k"], how, weight).collect()
    assert {(r["id"], r["k"]): r["n"] for r in got} == want
    assert len(got) == len(want)


def test_lookup_without_room_takes_the_shuffle_path(sides):
    big, small = sides
    small_enough = joins.lookup(big, small, ["k"], weight="n")
    too_big = joins.lookup(big, small, ["k"], weight="n", most_bytes=10)
    assert pairs(small_enough) == pairs(too_big)
    assert "BroadcastHashJoin" in small_enough._jdf.queryExecution().toString()


def test_measured_bytes(spark):
    table = spark.createDataFrame([("abc", 1), ("é", 2)], "s string, i int")
    assert joins.measured_bytes(table) == 2 * (joins.ROW_BYTES + 8) + 3 + 2
    assert joins.measured_bytes(table.limit(0)) == 0


def test_null_keys_meet(spark):
    left = spark.createDataFrame([(None, 1), (2, 2)], "k int, a int")
    right = spark.createDataFrame([(None, 10), (2, 20)], "k int, b int")
    assert joins.null_safe_join(left, right, ["k"]).count() == 2


def test_bounded_rows_refuses_more(spark):
    with pytest.raises(ValueError, match="more than 3"):
        joins.bounded_rows(spark.range(5), 3, "ids")
