"""Canonical answers and scorers."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import answers, ownership, scoring


def text(spark, rows, schema):
    return answers.answer(spark.createDataFrame(rows, schema)).text


def test_golden_answer_strings(spark):
    assert text(spark, [(28731,)], "value int") == "28731"
    assert text(spark, [(Decimal("26677920.2600"),)], "total_amount decimal(19,4)") == "26677920.26"
    assert text(spark, [("Standard", 6229)], "entity string, n long") == "Standard | 6229"
    assert text(spark, [("Awareness", 35726.0), ("Retention", 34685.0)], "entity string, points double") == "Awareness | 35726; Retention | 34685"
    assert text(spark, [("South", 46072, 22797, -50.52)], "entity string, a long, b long, pct_change double") == "South | 46072 | 22797 | -50.52"


def test_cells():
    assert answers.cell(None) == "" and answers.cell(True) == "true"
    assert answers.cell(datetime.datetime(2026, 1, 2)) == "2026-01-02"
    assert answers.cell(datetime.datetime(2026, 1, 2, 3, 4, 5, 6)) == "2026-01-02T03:04:05"
    assert answers.cell(Decimal("2.005"), "amount") == "2.01" and answers.cell(Decimal("2.500")) == "2.500"
    assert answers.cell(Decimal("7.00")) == "7" and answers.cell(0.125, "corporate_share_rate") == "0.13"


def test_blocked_results(spark):
    assert answers.answer(spark.createDataFrame([(None,)], "v int")).status == "blocked"
    assert answers.answer(spark.createDataFrame([], "v int, w int")).hash is None
    assert answers.answer(spark.createDataFrame([(None, 1)], "a int, b int")).text == " | 1"


def test_digest_ignores_order_and_sees_changes(spark):
    df = spark.range(100).select("id", (F.col("id") * 2).alias("v"))
    same, other = df.repartition(7).orderBy(F.desc("id")), df.withColumn("v", F.when(F.col("id") == 5, 0).otherwise(F.col("v")))
    one = answers.table_digest(df).first()
    assert one == answers.table_digest(same).first() and one != answers.table_digest(other).first()
    assert answers.stale({"a": 1, "b": 2}, {"a": 1, "b": 3}) == ["b: 2 is now 3"]
    assert answers.fingerprint({"a": 1, "b": 2}) == answers.fingerprint({"b": 2, "a": 1})


def test_even_sample():
    assert answers.even_sample(list("abcdefg"), 3) == ["a", "d", "g"] and answers.even_sample([1, 2], 5) == [1, 2]


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        ("28731", "There are 28,731 of them", True, True, True),
        ("28731", "about 28732", False, False, False),
        ("yes", " YES ", True, True, True),
        ("a | 1; b | 2", "A | 1; b | 2", True, True, True),
        ("a | 1; b | 2", "b | 2; a | 1", False, False, False),
        ("a | 1; b | 2", "a has 1, b has 2", True, False, True),
        ("5", "", False, False, False),
    ]
    return spark.createDataFrame(rows, "g string, a string, scalar boolean, tabular boolean, ordered boolean")


def test_modes(scored):
    g, a = F.col("g"), F.col("a")
    got = scored.select("*", scoring.scalar_exact(g, a).alias("s"), scoring.table_exact(g, a).alias("t"), scoring.judge_plus_exact(g, a, F.lit(None).cast("boolean")).alias("o"), scoring.judge_plus_exact(g, a, F.lit(False)).alias("veto"))
    for r in got.collect():
        assert (r.s, r.t, r.o) == (r.scalar, r.tabular, r.ordered), r
        assert not r.veto


#: Golden text, answer, result, and what is not met.
OWNED = [
    ("Awareness | 35726; Retention | 34685", "Awareness led with 35,726 and Retention had 34,685", "pass", []),
    ("Awareness | 35726; Retention | 34685", "Awareness had 34,685 and Retention led with 35,726", "fail", ["label:Awareness", "label:Retention"]),
    # a label after its value is only believed where no other stands before the value
    ("Awareness | 35726", "35,726 for Awareness; 34,685 for Retention", "pass", []),
    ("Awareness | 35726; Retention | 34685", "35,726 for Awareness; 34,685 for Retention", "fail", ["label:Retention"]),
    ("28731", "28,731.00 in all", "pass", []),
    ("4182650.00", "4,182,000", "fail", ["value:4182650.00"]),
    ("2026-04-01 | 5", "On April 1, 2026 there were 5", "pass", []),
    ("2026", "It was on 2026-04-01", "fail", ["value:2026"]),
    ("2026-02-30", "on 2026-02-30", "not_applicable", []),
    ("5", None, "error", []),
    ("a", " ", "error", []),
    ("", "x", "not_applicable", []),
    (None, "x", "not_applicable", []),
    ("1 | 2", "2", "fail", ["value:1"]),
    # each number is spent once
    ("A | 5; B | 5", "A 5 and B", "fail", ["value:5"]),
    ("5; 5", "5 only", "fail", ["value:5"]),
    ("+5 | 007", "5 and 7.0", "pass", []),
    # without regard to spaces
    ("CustomerEducation | 12", "Customer Education led with 12 campaigns", "pass", []),
    ("North | 35; South | 34; FarEast | 33", "North led with 35, then South at 34 and Far East at 33.", "pass", []),
    ("South | 35; Far East | 34; North | 33", "North led with 35, then South at 34 and Far East at 33.", "fail", ["label:Far East", "label:North", "label:South"]),
    ("South | 35; Far East | 34; North | 33", "South | 35; Far East | 34; North | 33", "pass", []),
    ("a.b (c)* | 3", "A.B (c)* is 3, axb (c) is 4", "pass", []),
    ("Standard | 6229", "6,229 cases fall under Standard.", "pass", []),
    ("Ann Lee — 1,000.50", "Bob closed 1000.5", "fail", ["label:Ann Lee"]),
    ("x | 28731", "x: 28,731", "pass", []),
    ("2026-04-01", "on April 1st, 2026", "pass", []),
    ("2026-04-01 | x", "the 1st April 2026, x", "pass", []),
    ("A | 5", f"A {'z' * 150} 5", "fail", ["label:A"]),
    # a label has 60 characters at most, and a sentence is none
    ("x" * 61, "other", "not_applicable", []),
    ("All is well.", "other", "not_applicable", []),
    ("x" * 60, "other", "fail", ["label:" + "x" * 60]),
    ("5 apples", "there are 5", "pass", []),
    ("7", "-7", "fail", ["value:7"]),
]
ITSELF = ["28731", "Standard | 6229", "Awareness | 35726; Retention | 34685", "South | 46072 | 22797 | -50.52"]


def matched(spark, pairs, policy=ownership.Policy()):
    """The verdicts on pairs of texts, in their order."""
    rows = spark.createDataFrame([(i, g, a, "own") for i, (g, a) in enumerate(pairs)], "i int, g string, a string, text string").repartition(2)
    return [r["match"] for r in ownership.match_owned(rows, "g", "a", policy=policy).orderBy("i").collect()]


def test_labels_own_their_values(spark):
    for (golden, answer, result, unmet), got in zip(OWNED, matched(spark, [c[:2] for c in OWNED]), strict=True):
        assert (got.result, got.unsatisfied) == (result, unmet), (golden, answer, got)


def test_an_answer_matches_itself_and_no_step_beside_it(spark):
    changed = [g[:-1] + str((int(g[-1]) + 1) % 10) for g in ITSELF]
    assert {m.result for m in matched(spark, [(g, g) for g in ITSELF])} == {"pass"}
    assert {m.result for m in matched(spark, list(zip(ITSELF, changed, strict=True)))} == {"fail"}


def test_failures_are_told(spark):
    near, far, many, met = matched(spark, [("South | 35; North | 33", "North 35, South 33"), ("A | 5", f"A {'z' * 150} 5"), ("1 | 2 | 3 | 4 | 5 | 6", "none"), ("5; 5", "5 only")])
    assert near.detail.count("stands by values that another label owns") == 2
    assert far.detail == "label 'A' stands 152 characters from its nearest value, more than 120"
    assert many.detail == "value '1' is missing; value '2' is missing; value '3' is missing; value '4' is missing; and 2 more"
    assert met.satisfied == met.unsatisfied == ["value:5"]


def test_policies(spark):
    policy = ownership.Policy
    assert matched(spark, [("Ann Lee — 1,000.50", "Bob closed 1000.5")], policy(labels=False))[0].result == "pass"
    assert [m.result for m in matched(spark, [("x | 28731", "x: 28,731"), ("x | 28731", "x: 28731")], policy(as_written=True))] == ["fail", "pass"]
    assert matched(spark, [("2026-04-01", "on April 1st, 2026")], policy(prose_dates=False))[0].result == "fail"
    assert matched(spark, [("A | 5", f"A {'z' * 150} 5")], policy(near=200))[0].result == "pass"
