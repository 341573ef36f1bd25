"""Properties that must hold on any data, checked against brute force."""

import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from checks import queries as Q
from mailtriage.operators import lookalike as LA, metrics as M, ordering as O, quality as QA
from mailtriage.operators.lookup import is_small, lookup

SF = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


@pytest.fixture(scope="module")
def words():
    rng = random.Random(5)
    return sorted({"".join(rng.choice("abc.-") for _ in range(rng.randint(1, 7))) for _ in range(160)})


@pytest.mark.parametrize("most", [1, 2])
def test_edit_neighbours_equal_brute_force(frame, words, most):
    left, right = words[::2], words[1::2]
    got = LA.edit_neighbours(frame("left string", *[(w,) for w in left]), frame("right string", *[(w,) for w in right]), most=most)
    expected = {(a, b, distance(a, b)) for a in left for b in right if distance(a, b) <= most}
    assert {tuple(r) for r in got.collect()} == expected
    assert got.count() == len(expected)


def test_nearest_sites_equal_brute_force(frame, words, monkeypatch):
    monkeypatch.setattr(LA, "BLOCK_SITES", 7)  # several blocks
    asked = words[::2] + ["a-completely-different-name.example"]
    sites = words[1::2]
    got = LA.nearest_sites(frame("domain string", *[(w,) for w in asked]), frame("domain string", *[(w,) for w in sites]))
    expected = {a: min((distance(a, s), s) for s in sites) for a in asked}
    assert {r["domain"]: (r["distance"], r["closest"]) for r in got.collect()} == expected


@pytest.mark.parametrize("small", [True, False])
def test_lookup_with_a_hot_key(spark, small):
    facts = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    dim = spark.createDataFrame([("hot", 1), ("1", 2)], "k string, v int")
    got = lookup(facts, dim, "k", F.col("id"), small)
    assert got.count() == 3000
    assert got.where("v = 1").count() == 1000 and got.where("v = 2").count() == 1
    assert is_small(dim, 1000) and not is_small(dim, 10)


def test_numbered_is_gapless(spark):
    rows = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k"))
    got = sorted(map(tuple, O.numbered(rows, [F.col("k").desc()], "n").select("n", "k").collect()))
    assert [n for n, _ in got] == list(range(1, 1001))
    assert [k for _, k in got] == sorted((k for _, k in got), reverse=True)


@pytest.mark.parametrize("buckets", [1, 4, 1 << 16])
def test_split_is_exact(spark, buckets):
    rows = spark.range(1003).select("id", F.when(F.col("id") % 10 == 0, 1).otherwise(0).alias("label"))
    got = O.stratified_split(rows, "id", "label", buckets=buckets)
    assert got.count() == 1003
    counts = {r["label"]: (r["t"], r["n"]) for r in got.groupBy("label").agg(
        F.count_if("is_test").alias("t"), F.count("*").alias("n")).collect()}
    assert counts == {0: (180, 902), 1: (20, 101)}
    picked = {r["id"] for r in got.where("is_test").collect()}
    again = {r["id"] for r in O.stratified_split(rows.repartition(7), "id", "label").where("is_test").collect()}
    assert picked == again


@pytest.mark.parametrize("buckets", [2, 256])
def test_auc_equals_evaluator_with_ties(spark, buckets):
    rows = spark.range(2000).select(
        ((F.col("id") * 7919 % 101) / 100).alias("p"), F.when(F.col("id") * 31 % 17 < F.col("id") % 9, 1).otherwise(0).alias("label"))
    exact = BinaryClassificationEvaluator(rawPredictionCol="v", numBins=0).evaluate(
        rows.withColumn("v", array_to_vector(F.array(1 - F.col("p"), "p"))))
    assert M.roc_auc(rows, buckets=buckets).first()[0] == pytest.approx(exact, abs=5e-5)


def test_dedupe_keeps_first_copy_of_a_hot_message(spark):
    rows = spark.range(900).select(F.col("id").alias("email_id"), F.when(F.col("id") % 3 == 0, "same").otherwise(
        F.col("id").cast("string")).alias("message"))
    kept = QA.drop_duplicate_messages(rows)
    assert kept.count() == 601
    assert kept.where("message = 'same'").first()["email_id"] == 0


@pytest.fixture(scope="module")
def scored(spark):
    return Q._verdicts(spark, SF).cache()


def test_verdict_bounds(scored):
    assert scored.where("final_label = 'Spam' and (overall_score < 60 or risk_level = 'Low')").count() == 0
    assert scored.where("final_label = 'Safe' and (overall_score > 43.4 or risk_level <> 'Low')").count() == 0
    assert scored.where("final_label = 'Safe' and size(suspicious_urls) > 0").count() == 0
    assert scored.where("keyword_score < 0 or keyword_score > 100 or abs(keyword_score * 20 - round(keyword_score * 20)) > 1e-9").count() == 0
    assert scored.where("size(reasons) > 5 or size(checks_breakdown) <> 5").count() == 0
    assert scored.count() == scored.select("email_id").distinct().count() == 200


def test_reputation_bounds(spark):
    rep = Q.domain_reputation(spark, SF)
    assert rep.where("in_spam + in_ham <> total_occurrences or legitimacy_score not between 0 and 100").count() == 0


def test_plans_use_pushdown_and_no_cross_join(spark):
    plan = Q.domain_reputation(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "ReadSchema: struct<doc_id:bigint,text:string,source:string>" in plan
    for name in ("close_sites", "nearest_sites", "brand_imitations", "link_assessment"):
        plan = Q.REGISTRY[name][0](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
