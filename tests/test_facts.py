"""Facts of fitted models fail on spoiled results."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabulark.plans import facts


def values(df):
    return df.first().asDict()


def test_lengths(spark):
    placed = spark.createDataFrame([(1, 0, 0.6), (1, 1, 0.8), (2, 0, 1.0)], "doc_id long, dimension int, value double")
    assert values(facts.length_facts(placed)) == {"documents": 2, "ids": 3, "unit_length": True}
    assert not values(facts.length_facts(placed.withColumn("value", F.col("value") * 2)))["unit_length"]
    assert values(facts.length_facts(placed.limit(0))) == {"documents": 0, "ids": None, "unit_length": False}


def test_singular_values(spark):
    good = spark.createDataFrame([(0, 3.0), (1, 1.0)], "dimension int, value double")
    assert all(values(facts.value_facts(good, 2, 12)).values())
    assert not values(facts.value_facts(good, 1, 12))["dimensions"]
    assert not values(facts.value_facts(good.withColumn("dimension", -F.col("dimension")), 2, 12))["falling"]
    assert not values(facts.value_facts(good, 2, 9))["within"] and not values(facts.value_facts(good, 2, 99))["within"]
    assert not any(values(facts.value_facts(good.limit(0), 2, 12)).values())


def test_clusters(spark):
    good = spark.createDataFrame([(i, i % 2, "ab"[i % 2]) for i in range(20)], "doc_id long, cluster int, lang string")
    assert values(facts.cluster_facts(good)) == {"documents": 20, "clusters": 2, "agree": True}
    assert not values(facts.cluster_facts(good.withColumn("cluster", (F.col("doc_id") / 10).cast("int"))))["agree"]
    assert values(facts.cluster_facts(good.limit(0)))["documents"] == 0


def test_cluster_terms(spark):
    rows = [(c, r, f"t{c}{r}", 1.0 / r) for c in range(2) for r in (1, 2, 3)]
    found = spark.createDataFrame(rows, "cluster int, rank int, term string, weight double")
    known = found.select("term")
    assert values(facts.term_facts(found, known)) == {"clusters": 2, "rows": 6, "ranked": True, "known": True}
    assert not values(facts.term_facts(found.withColumn("weight", -F.col("weight")), known))["ranked"]
    assert not values(facts.term_facts(found, known.where("term <> 't01'")))["known"]
    assert not values(facts.term_facts(found.limit(0), known))["ranked"]


def test_binary_scores(spark):
    rows = [(i, float(i % 2), 0.9 if i % 2 else 0.1, float(i % 2)) for i in range(20)]
    good = spark.createDataFrame(rows, "doc_id long, quality double, score double, prediction double")
    assert values(facts.binary_facts(good)) == {"rows": 20, "documents": 20, "in_range": True, "tells": True}
    assert not values(facts.binary_facts(good.withColumn("quality", 1 - F.col("quality"))))["tells"]
    assert not values(facts.binary_facts(good.withColumn("prediction", 1 - F.col("prediction"))))["in_range"]
    assert not values(facts.binary_facts(good.limit(0)))["tells"]


def test_class_probabilities(spark):
    rows = [(d, "ab"[d % 2], c, 0.8 if c == "ab"[d % 2] else 0.2) for d in range(10) for c in "ab"]
    good = spark.createDataFrame(rows, "doc_id long, label string, class string, p double")
    assert values(facts.class_facts(good)) == {"documents": 10, "rows": 20, "whole": True, "tells": True}
    assert not values(facts.class_facts(good.withColumn("p", 1 - F.col("p"))))["tells"]
    assert not values(facts.class_facts(good.withColumn("p", F.col("p") * 2)))["whole"]
    assert not values(facts.class_facts(good.limit(0)))["whole"]


def test_errors(spark):
    good = spark.createDataFrame([(i, i % 2, float(i), i + 0.1) for i in range(10)], "doc_id long, fold int, target double, prediction double")
    assert values(facts.error_facts(good)) == {"rows": 10, "documents": 10, "folds": 2, "targets": 45.0, "tells": True}
    assert not values(facts.error_facts(good.withColumn("prediction", F.lit(4.5))))["tells"]
    assert not values(facts.error_facts(good.limit(0)))["tells"]


def test_curves(spark):
    rows = [(0, p, n, e) for p, es in (("train", [4.0, 3.0, 2.0, 1.0]), ("valid", [4.0, 2.0, 3.0, 3.0])) for n, e in enumerate(es, 1)]
    good = spark.createDataFrame(rows, "fold int, part string, iteration int, mse double")
    assert values(facts.curve_facts(good, 9, 2)) == {"fold": 0, "gapless": True, "falls": True, "waited": True}
    assert not values(facts.curve_facts(good, 9, 3))["waited"]
    assert not values(facts.curve_facts(good.where("iteration <> 2"), 9, 2))["gapless"]
    assert not values(facts.curve_facts(good.withColumn("mse", -F.col("mse")), 9, 2))["falls"]


def test_plain_curves(spark):
    rows = [(p, n, e / n) for p, e in (("train", 4.0), ("test", 5.0)) for n in (1, 2, 3)]
    good = spark.createDataFrame(rows, "part string, iteration int, mse double")
    assert values(facts.plain_curve_facts(good)) == {"first": 1, "gapless": True, "improved": True}
    assert not values(facts.plain_curve_facts(good.withColumn("mse", F.lit(1.0))))["improved"]
    assert not values(facts.plain_curve_facts(good.where("part = 'train'")))["gapless"]
    assert not values(facts.plain_curve_facts(good.limit(0)))["gapless"]


def test_topics(spark):
    rows = [(t, r, f"w{t}{r}", 1.0 / r) for t in range(2) for r in (1, 2, 3)]
    good = spark.createDataFrame(rows, "topic int, rank int, term string, weight double")
    assert all(r["ranked"] and r["terms"] == 3 for r in facts.topic_facts(good).collect())
    assert not any(r["ranked"] for r in facts.topic_facts(good.withColumn("rank", 4 - F.col("rank"))).collect())
    assert facts.topic_facts(good.limit(0)).count() == 0
    main = spark.createDataFrame([(i, 0.5, "a, b") for i in (2, 1)], "doc_id long, share double, keywords string")
    assert values(facts.main_topic_facts(main))["strongest"]
    assert not values(facts.main_topic_facts(main.withColumn("share", F.lit(0.01))))["strongest"]
    assert not values(facts.main_topic_facts(main.limit(0)))["strongest"]


def test_selection(spark):
    names = ["x", "y"]
    judge = spark.createDataFrame([(3.0,)], "spread double")
    schema = "step int, candidate string, rmse double, kept boolean"
    good = spark.createDataFrame([(0, "", 0.9, True), (1, "x", 0.8, True), (2, "y", 0.85, False)], schema)
    assert values(facts.selection_facts(good, names, judge)) == {"tried": 2, "in_order": True, "greedy": True, "tells": True, "spread": 3.0}
    assert not values(facts.selection_facts(good.withColumn("kept", F.lit(True)), names, judge))["greedy"]
    assert not values(facts.selection_facts(good, names[::-1], judge))["in_order"]
    assert not values(facts.selection_facts(good.withColumn("rmse", F.col("rmse") * 2), names, judge))["tells"]
    empty = values(facts.selection_facts(good.limit(0), names, judge))
    assert not empty["in_order"] and not empty["greedy"] and not empty["tells"]


def test_search(spark):
    rare = spark.createDataFrame([(0.4,)], "rare double")
    good = spark.createDataFrame([(0, 2.0, 0.3, 2), (1, 3.0, 0.1, 1), (2, 4.0, 0.3, 2)], "run int, depth double, loss double, rank int")
    flags = facts.search_facts(good, ["depth"], rare).collect()
    assert len(flags) == 3 and all(r["placed"] and r["tells"] for r in flags)
    assert not all(r["placed"] for r in facts.search_facts(good.withColumn("rank", F.col("run") + 1), ["depth"], rare).collect())
    assert not any(r["tells"] for r in facts.search_facts(good.withColumn("loss", F.col("loss") + 0.4), ["depth"], rare).collect())
