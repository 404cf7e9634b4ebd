"""Verdicts are read strictly, and joins say what they lack."""

import json

from pyspark.sql import functions as F

from millrace.functions import verdicts
from millrace.operators.joins import one_to_one
from millrace.operators.scorecard import DIMENSIONS


def verdict(**change):
    return {**dict.fromkeys(DIMENSIONS, 4), "rationales": dict.fromkeys(DIMENSIONS, "why "), **change}


def test_strict_verdicts(spark):
    good = json.dumps(verdict())
    bad = [json.dumps(verdict(factual=x)) for x in ("5", 5.5, True, 0, 6, None)]
    bad += [json.dumps(verdict(extra=1)), json.dumps({**verdict(), "rationales": {}}), json.dumps(verdict(rationales=dict.fromkeys(DIMENSIONS, " "))), f"```{good}```", "[]", "", None, "{"]
    rows = spark.createDataFrame([(good,)] + [(b,) for b in bad], "t string").select("t", verdicts.parse_verdict(F.col("t")).alias("v")).collect()
    assert rows[0].v.factual == 4 and rows[0].v.rationales["format"] == "why"
    assert [r.t for r in rows[1:] if r.v is not None] == []


def test_one_dimension(spark):
    rows = spark.createDataFrame([('{"format": 3, "rationale": "x"}',), ('{"format": 3}',), ('{"format": 9, "rationale": "x"}',)], "t string").select(verdicts.parse_dimension(F.col("t"), "format").alias("v")).collect()
    assert tuple(rows[0].v) == (3, "x") and rows[1].v is None and rows[2].v is None


def test_asking_back(spark):
    texts = [{"response": {"response": json.dumps({"clarify": True})}}, {"response": {"response": {"clarify": True}}}, {"response": {"response": json.dumps({"clarify": "true"})}}, {"response": {"response": "plain"}}, {}]
    got = spark.createDataFrame([(json.dumps(t),) for t in texts], "p string").select(verdicts.asked_back(F.col("p")).alias("b")).collect()
    assert [r.b for r in got][:2] == [True, True] and [r.b for r in got][3:] == [False, False]


def test_rule_based_scores(spark):
    rows = [("5 and 7", "five and seven", "5 and 7", "SELECT (1)"), ("5 and 7", "x", "only 5", "SELECT (1"), ("red fox", "a b c d e", "", "drop"), ("red fox", "red fox", "Red fox!", None)]
    df = spark.createDataFrame(rows, "e string, r string, a string, s string").select(verdicts.rule_based_scores(*map(F.col, "eras")).alias("v"))
    assert [tuple(r.v) for r in df.collect()] == [(5, 3, 5, 5), (3, 1, 5, 3), (1, 1, 1, 2), (5, 5, 5, 1)]


def test_keys_and_seeds():
    assert verdicts.cache_key("a", "b") != verdicts.cache_key("ab", "") and verdicts.cache_key("a")[2] == "/"
    assert verdicts.child_seed(42, "x") == verdicts.child_seed(42, "x") != verdicts.child_seed(43, "x")


def test_one_to_one_joins(spark):
    a, b = spark.createDataFrame([(1, "x"), (2, "y")], "k int, v string"), spark.createDataFrame([(1, "p"), (1, "q"), (3, "r")], "k int, w string")
    _, checks = one_to_one(a, b, ["k"])
    assert {r.check_name: r.violations for r in checks.collect()} == {"left rows with the same k": 0, "right rows with the same k": 1, "left rows without a partner": 1, "right rows without a partner": 1}
    joined, checks = one_to_one(a, a.select("k", F.col("v").alias("w")), ["k"])
    assert joined.count() == 2 and checks.where("not passed").count() == 0
