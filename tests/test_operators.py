"""Quality rules, windows, synthesis and families on small fixtures with one thing wrong at a time."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from millrace.functions import money
from millrace.operators import quality as q
from millrace.operators import scorecard, synth, windows
from millrace.plans.catalog import FAMILIES
from millrace.plans.families import bind, literal


def violations(df):
    return df.first().violations


def test_rules_pass_clean_data_and_find_one_edit(spark):
    clean = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    assert violations(q.primary_key(clean, ["k"], "pk")) == 0
    assert violations(q.primary_key(clean.unionAll(clean.limit(1)), ["k"], "pk")) == 1
    assert violations(q.primary_key(clean, ["v"], "pk")) == 1
    assert violations(q.unique(clean, ["v"], "u")) == 0
    assert violations(q.not_null(clean, ["k", "v"], "nn")) == 1
    assert violations(q.in_domain(clean, "v", ["a"], "d")) == 1


def test_null_orphan_and_valid_references(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99), (4, 77)], "k int, p int")
    parent = spark.createDataFrame([(10,), (11,)], "id int")
    assert violations(q.foreign_key(child, "p", parent, "id", "fk")) == 2
    classes = {r["class"]: r.n for r in q.reference_classes(child, "p", parent, "id", F.col("p") == 99).collect()}
    assert classes == {"empty": 1, "valid": 1, "declared orphan": 1, "unexpected orphan": 1}


def test_empty_tables_break_no_rule(spark):
    none = spark.createDataFrame([], "k int, v int, d date, e date, s string")
    for rule in (q.primary_key(none, ["k"], "x"), q.not_null(none, ["k"], "x"), q.sequence(none, ["k"], "v", "x"), q.no_overlap(none, ["k"], "d", "e", "x"), q.grid(none, "k", "v", "x"), q.fixed_scale(none, "s", 5, 2, "x"), q.acyclic(none, "k", "v", "x"), q.row_cap([none], 1, "x")):
        assert violations(rule) == 0


def test_overlap_with_open_end(spark):
    day = datetime.date
    rows = [("a", day(2026, 1, 1), None), ("a", day(2026, 2, 1), day(2026, 3, 1)), ("b", day(2026, 1, 1), day(2026, 2, 1)), ("b", day(2026, 2, 1), day(2026, 3, 1))]
    assert violations(q.no_overlap(spark.createDataFrame(rows, "k string, s date, e date"), ["k"], "s", "e", "o")) == 1


def test_cycles(spark):
    tree = [(1, None), (2, 1), (3, 2)]
    assert violations(q.acyclic(spark.createDataFrame(tree, "k int, p int"), "k", "p", "c")) == 0
    assert violations(q.acyclic(spark.createDataFrame([*tree, (4, 5), (5, 4)], "k int, p int"), "k", "p", "c")) == 2


def test_partial_sums_may_be_less(spark):
    rows = [(1, Decimal("0.5")), (1, Decimal("0.5")), (2, Decimal("0.4")), (2, None), (3, Decimal("0.4"))]
    df = spark.createDataFrame(rows, "k int, w decimal(5,4)")
    assert violations(q.sums_to(df, ["k"], "w", F.lit(1).cast("decimal(5,4)"), "s")) == 1


def test_gate_names_what_failed(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    checks = q.gate([q.unique(df, ["k"], "keys"), q.not_null(df, ["k"], "nulls")])
    with pytest.raises(ValueError, match="keys: 1"):
        q.assert_all_passed(checks)


def test_conversion_rounds_once(spark):
    df = spark.createDataFrame([(Decimal("1.0001"), Decimal("0.549995")), (Decimal("1"), None)], "a decimal(19,4), r decimal(19,6)")
    got = [r[0] for r in df.select(money.convert(F.col("a"), F.col("r"))).collect()]
    assert got == [Decimal("0.5500"), None]


def test_quarters_and_zero_base(spark):
    row = spark.range(1).select(*money.quarter_bounds(F.lit("2026-05-17").cast("date")), money.percent_change(F.lit(0), F.lit(5)).alias("p")).first()
    assert tuple(row) == (datetime.date(2026, 4, 1), datetime.date(2026, 7, 1), None)


def test_allocation_is_exact(spark):
    df = spark.createDataFrame([(1, 1, 1.0), (1, 2, 1.0), (1, 3, 1.0)], "g int, n int, w double")
    assert [r.units for r in windows.allocate(df, ["g"], ["n"], "w", F.lit(100)).orderBy("n").collect()] == [34, 33, 33]


def test_defects_are_exact_and_repeatable(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit(5).alias("v"), F.lit(1.5).alias("x"))
    n = synth.count_of(1000, 2.5)
    assert n == 25 and synth.count_of(3, 0.1) == 1
    once = synth.inject_nulls(df, "k", "v", n, protected=F.col("k") < 10)
    again = synth.inject_nulls(df.repartition(7), "k", "v", n, protected=F.col("k") < 10)
    missing = {r.k for r in once.where("v is null").collect()}
    assert len(missing) == n and min(missing) >= 10 and missing == {r.k for r in again.where("v is null").collect()}
    assert synth.inject_outliers(df, "k", "x", 7, 100, 200).where("x between 100 and 200").count() == 7
    more = synth.near_duplicates(df, "k", 10, {"v": F.col("v") + 1})
    assert more.count() == 1010 and {r.k for r in more.where("v = 6").collect()} == set(range(1000, 1010))
    groups = synth.disjoint_groups(df, "k", {"a": 5, "b": 3}, 42, "s")
    assert groups.select("k").distinct().count() == 8


def test_double_entry_balances(spark):
    t = spark.createDataFrame([(i, Decimal(i)) for i in range(1, 50)], "t int, amount decimal(19,4)")
    lines = synth.double_entry(t, "t", "amount", 10)
    assert violations(q.balanced(t, lines, "t", "amount", "debit_amount", "credit_amount", "b")) == 0
    assert violations(q.exclusive(lines, "debit_amount", "credit_amount", "e")) == 0
    assert lines.groupBy("t").agg(F.count_distinct("account_id").alias("n")).where("n <> 2").count() == 0


def test_shifting_a_tree(spark):
    day = datetime.date
    root = spark.createDataFrame([(1, day(2026, 1, 1)), (2, day(2026, 1, 1))], "p int, d date")
    child = spark.createDataFrame([(7, 1, day(2026, 2, 1)), (8, 2, None)], "t int, p int, d date")
    out = synth.shift_tree(root, "p", spark.createDataFrame([(1, 3)], "p int, days int"), {"child": (child, "p", ["d"])}, ["d"])
    assert sorted(map(tuple, out["root"].collect())) == [(1, day(2026, 1, 4)), (2, day(2026, 1, 1))]
    assert sorted(map(tuple, out["child"].collect())) == [(7, 1, day(2026, 2, 4)), (8, 2, None)]


def test_typos(spark):
    words = spark.createDataFrame([("abc",), ("aab",), ("aaa",), ("x",), ("",)], "w string")
    assert [r[0] for r in words.select(synth.transpose_typo(F.col("w"))).collect()] == ["acb", "aba", "aaaa", "xx", ""]


def test_typos_of_long_and_odd_texts_without_a_pass_for_every_place(spark):
    long = "ab" * 20_000
    texts = spark.createDataFrame([(1, long), (2, "a" * 40_000), (3, "ab\n\n"), (4, "é😀😀"), (5, "$\\"), (6, None)], "k int, w string")
    out = texts.select("k", synth.transpose_typo(F.col("w")).alias("w"))
    assert dict(map(tuple, out.collect())) == {1: long[:-2] + "ba", 2: "a" * 40_001, 3: "a\nb\n", 4: "😀é😀", 5: "\\$", 6: None}
    mail = texts.select(synth.email_typo(F.concat(F.lower("w"), F.lit("@x.org"))).alias("m"))
    assert "lambda" not in mail._jdf.queryExecution().optimizedPlan().toString()
    assert {r.m for r in mail.where("length(m) < 100").collect()} == {"a\nb\n@x.org", "😀é😀@x.org", "\\$@x.org"}


def test_rebalanced_lines_are_dealt_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(synth, "TASK_LINES", 50)
    lines = spark.range(400).selectExpr("id div 4 as k", "id as n", "cast(1 + id % 7 as decimal(18,2)) as a")
    totals = spark.range(0, 100, 3).selectExpr("id as k", "cast(10 as decimal(18,2)) as total")
    out = synth.rebalance(lines, ["k"], ["n"], "a", totals, "total")
    assert out.rdd.getNumPartitions() == 8
    wanted = {}
    for k in range(100):
        cents = [100 * (1 + i % 7) for i in range(4 * k, 4 * k + 4)]
        if k % 3 == 0:
            floors = [1000 * c // sum(cents) for c in cents]
            cents = [f + (i < 1000 - sum(floors)) for i, f in enumerate(floors)]
        wanted |= {4 * k + i: c for i, c in enumerate(cents)}
    assert {r.n: int(r.a * 100) for r in out.collect()} == wanted
    assert synth.rebalance(lines.limit(0), ["k"], ["n"], "a", totals, "total").count() == 0


def test_weights_must_add_up():
    with pytest.raises(ValueError):
        synth.choose(F.lit(0.1), {"a": 0.5})


def test_parameters_with_quotes_and_unknown_ones():
    assert literal("O'Hara") == "'O''Hara'" and bind("a = :x", {"x": True}) == "a = true"
    with pytest.raises(KeyError):
        bind("a = :y", {})


def test_anti_joins_are_planned_as_such(spark):
    t = {"accounts": spark.createDataFrame([(1, "East"), (2, "East")], "account_id int, region string"), "contacts": spark.createDataFrame([(5, 1)], "contact_id int, account_id int")}
    df = FAMILIES["crm:T3-01"].frame(t, region="East")
    assert df.first().value == 1
    assert "LeftAnti" in df._jdf.queryExecution().toString()


def test_scorecard_denominators(spark):
    rows = [("d", "T1", "pass", 5), ("d", "T1", "fail", 3), ("d", "T2", "error", None), ("d", "T2", "clarification", None), ("d", "T2", "not_applicable", 1)]
    df = spark.createDataFrame(rows, "domain string, tier string, result string, factual int").select("*", *(F.col("factual").alias(d) for d in scorecard.DIMENSIONS[1:]), F.lit(False).alias("off_contract"), F.lit(None).cast("string").alias("null_handling"), F.lit(False).alias("judge_failed"))
    all_ = scorecard.roll_up(df).where("tier = 'ALL'").first()
    assert (all_.exact_match_pct, all_.exact_match_eligible, all_.platform_errors) == (50.0, 2, 1)
    assert (all_.judge_factual, all_.judge_overall) == (3.0, (5 + 3 + 1 + 2.5) / 4)
    t2 = scorecard.roll_up(df).where("tier = 'T2'").first()
    assert t2.exact_match_pct is None


def test_calibration_defeats_constant_judges(spark):
    rows = [(i, "factual", 1 + 4 * (i % 2), 1 + 4 * (i % 2)) for i in range(12)]
    good = scorecard.calibration(spark.createDataFrame(rows, "anchor_id int, dimension string, human int, judge int")).first()
    assert good.passed and not good.constant_ok
    dull = scorecard.calibration(spark.createDataFrame([(i, "factual", 3, 3) for i in range(12)], "anchor_id int, dimension string, human int, judge int")).first()
    assert dull.constant_ok and not dull.passed


def test_whole_units_are_shared_exactly(spark):
    df = spark.range(100)
    for total, least, most in ((100, 1, None), (777, 1, None), (777, 2, 9), (900, 1, 9), (103, 1, 2), (0, 0, 5)):
        units = [r.units for r in synth.allocate_whole(df, "id", total, least, most).collect()]
        assert len(units) == 100 and sum(units) == total and min(units) >= least and (most is None or max(units) <= most)
    with pytest.raises(ValueError, match="cannot be shared"):
        synth.allocate_whole(df, "id", 901, 1, 9)


def test_pairs_cover_both_sides_before_they_repeat(spark):
    a, b = spark.range(12).withColumnRenamed("id", "a"), spark.range(8).withColumnRenamed("id", "b")
    for n in (0, 5, 12, 30, 96):
        pairs = [tuple(r) for r in synth.unique_pairs(a, b, "a", "b", n).collect()]
        assert len(set(pairs)) == len(pairs) == n
        assert len({x for x, _ in pairs}) == min(n, 12) and len({y for _, y in pairs}) == min(n, 8)
    with pytest.raises(ValueError, match="97 pairs"):
        synth.unique_pairs(a, b, "a", "b", 97)


def test_chosen_rows_are_the_first_of_all_draws(spark):
    df = spark.range(3_000)
    draws = sorted((r.d, r.id) for r in df.select("id", synth.draw(7, "s", F.col("id")).alias("d")).collect())
    for n in (0, 1, 40, 2_999, 5_000):
        got = {r.id: r["rank"] for r in synth.chosen(df, "id", n, 7, "s").collect()}
        assert got == {k: i for i, (_, k) in enumerate(draws[:n], 1)}


def test_gates_find_what_is_wrong(spark):
    deep = [(i, i - 1 if i else None, "A") for i in range(40)]
    tree = lambda rows: spark.createDataFrame(rows, "k int, p int, t string")
    assert violations(q.acyclic(tree(deep), "k", "p", "x")) == 0
    assert violations(q.acyclic(tree([*deep, (50, 51, "A"), (51, 50, "A"), (52, 50, "A"), (53, 99, "A")]), "k", "p", "x")) == 3
    assert violations(q.same_as_parent(tree([(1, None, "A"), (2, 1, "B"), (3, 1, "A"), (4, 9, "C")]), "k", "p", "t", "x")) == 1
    parents, children = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string"), spark.createDataFrame([(1, "a"), (1, "b"), (1, None), (2, "c"), (2, None), (3, "z")], "k int, v string")
    assert violations(q.agrees(children, parents, "k", "v", "x")) == 3 and violations(q.agrees(children, parents, "k", "v", "x", required=False)) == 2
    orders = spark.createDataFrame([(1, "Shipped"), (2, "Shipped"), (3, "Delivered"), (4, "Delivered"), (5, "Pending")], "k int, s string")
    shipped = spark.createDataFrame([(1, "Lost"), (3, "Lost"), (4, "Delivered")], "k int, t string")
    assert violations(q.evidence(orders, shipped, "k", "s", {"Shipped": F.lit(True), "Delivered": F.col("t") == "Delivered"}, "x")) == 2
    assert q.shape({"a": orders}, {"a": ["k", "s"]}, "d") == [] and len(q.shape({"a": orders}, {"a": ["s", "k"], "b": []}, "d")) == 2
    same = {r.table: r.same for r in q.reproducible({"a": orders, "b": shipped}, {"a": orders.repartition(3), "b": shipped.limit(2)}).collect()}
    assert same == {"a": True, "b": False}
    assert violations(q.same_pairs(parents, children, ["k", "v"], "x")) == 4 and violations(q.one_each(children, "k", "v", "x")) == 1


def test_exact_money_refuses_floats(spark):
    from pyspark.errors import SparkRuntimeException

    df = spark.range(1)
    assert df.select(money.quantise(F.lit("2.345"), 10, 2).alias("x")).first().x == Decimal("2.35") == df.select(money.quantise(F.lit(Decimal("-2.345")), 10, 2).alias("x")).first().x * -1
    for bad in (F.lit(2.5), F.lit(float("nan"))):
        with pytest.raises(SparkRuntimeException, match="exact number"):
            df.select(money.quantise(bad, 10, 2)).collect()
    assert df.select(money.minor_units(F.lit(Decimal("12.30"))).alias("x")).first().x == 1230
    with pytest.raises(SparkRuntimeException, match="more than 2 decimals"):
        df.select(money.minor_units(F.lit(Decimal("12.305")))).collect()
    due = df.select(money.due_at(F.lit("2026-01-30").cast("date"), F.lit("Low")).alias("x"), money.due_at(F.lit("2026-01-30").cast("date"), F.lit("?")).alias("y")).first()
    assert due.x == datetime.datetime(2026, 2, 2) and due.y is None
