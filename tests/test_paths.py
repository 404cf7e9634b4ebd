"""Join-path counts, audits of near duplicates, and gates that share their passes."""

import collections
import itertools
import random

import pytest
from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.operators.paths import Hop, near_duplicate_audit, path_counts, path_rules


@pytest.fixture(scope="module")
def chain(spark):
    rng = random.Random(2)
    pick = lambda n: rng.choice([None, *range(n)])
    a = [(i, pick(8)) for i in range(20)]
    b = [(pick(8), pick(5), i) for i in range(30)]
    c = [(pick(5), pick(4)) for i in range(25)]
    d = [(pick(4), "x") for i in range(6)] + [(2, "y")] * 5
    names = ("id long, x long", "x long, y long, b_id long", "y long, z long", "z long, v string")
    return [spark.createDataFrame(rows, n).repartition(3) for rows, n in zip((a, b, c, d), names, strict=True)], (a, b, c, d)


@pytest.mark.parametrize("keep", list(itertools.product([False, True], repeat=3)))
def test_path_counts(chain, keep):
    (a, b, c, d), rows = chain
    hops = [Hop(b, ("x",), ("x",), keep[0]), Hop(c, ("y",), ("y",), keep[1]), Hop(d, ("z",), ("z",), keep[2])]
    links = [(1, 0), (1, 0), (1, 0)]
    for n in (1, 2, 3):
        now, free = [(r,) for r in rows[0]], 0
        for i in range(n):
            out = []
            for path in now:
                key = path[-1][links[i][0]] if path[-1] is not None else None
                partners = [r for r in rows[i + 1] if key is not None and r[links[i][1]] == key]
                free += i == 0 and not partners
                out += [(*path, r) for r in partners] or ([(*path, None)] if keep[i] else [])
            now = out
        got = path_counts(a, hops[:n], "p").first()
        assert (got.joined_rows, got.unmatched_rows) == (len(now), free)


def test_path_rules(chain):
    (a, b, _, d), _ = chain
    good, none = path_counts(a, [Hop(b, ("x",), ("x",), True)], "ab"), path_counts(a.where("false"), [Hop(b, ("x",), ("x",))], "none")
    full = "non_empty_with_unmatched_parent_rows"
    assert sorted(map(tuple, path_rules(good, full).collect())) == [("ab.joined_rows", 0), ("ab.unmatched_parent_rows", 0)]
    assert sorted(map(tuple, path_rules(none, full).collect())) == [("none.joined_rows", 1), ("none.unmatched_parent_rows", 1)]
    assert len(path_rules(good, "non_empty").collect()) == 1
    with pytest.raises(ValueError):
        path_rules(good, "other")
    with pytest.raises(ValueError):
        path_counts(a, [], "empty")


def test_path_with_composite_keys(spark):
    a = spark.createDataFrame([(1, "u"), (1, "v"), (2, None)], "i long, s string")
    b = spark.createDataFrame([(1, "u"), (1, "u"), (2, None), (None, "v")], "j long, t string")
    got = path_counts(a, [Hop(b, ("i", "s"), ("j", "t"))], "p").first()
    assert (got.joined_rows, got.unmatched_rows) == (2, 2)


def test_near_duplicate_audit(spark):
    rng = random.Random(8)
    base = [(i, rng.choice("ab"), f"m{i}", rng.choice([None, 1, 2])) for i in range(40)]
    rows = base + [(i, s, m + "!", n) for i, s, m, n in base[:7]] + [(i, s, m, 9) for i, s, m, n in base[20:23]] + base[30:33] + [(99, None, "", None), (99, "", "", None)]
    df = spark.createDataFrame(rows, "i long, s string, m string, n long").repartition(3)
    got = {r.column: (r.groups, r.rows, r.permitted) for r in near_duplicate_audit(df, ["i", "s", "m", "n"], ["m"]).collect()}
    for k, name in enumerate(("i", "s", "m", "n")):
        met = collections.defaultdict(list)
        for r in rows:
            met[r[:k] + r[k + 1 :]].append(r[k])
        several = [v for v in met.values() if len(set(v)) > 1]
        assert got[name] == (len(several), sum(map(len, several)), name == "m")
    assert got["m"][0] >= 7 and got["s"][0] == 1
    assert {r.groups for r in near_duplicate_audit(df.where("false"), ["i", "s"]).collect()} == {0}


def test_a_gate_counts_the_rules_of_a_table_in_one_pass_for_each_key(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice([None, *range(30)]), rng.choice(["A", "B", None]), rng.choice([None, 1, 2, 3]), i % 5) for i in range(200)]
    spark.createDataFrame(rows, "k long, s string, n long, m long").write.parquet(f"{tmp_path}/t")
    t = spark.read.parquet(f"{tmp_path}/t")
    rules = lambda t: [
        q.unique(t, ["k"], "unique"), q.primary_key(t, ["k"], "key"), q.at_most(t, "k", F.col("s") == "A", 1, "most"), q.even_groups(t, ["k"], "even"), q.sequence(t, ["k"], "n", "sequence"), q.one_each(t, "k", "s", "each"), q.sums_to(t, ["k"], "n", F.lit(6), "sums"),
        q.where_violated(t, "where", F.col("n") > 1), q.exclusive(t, "k", "n", "exclusive"), q.chronology(t, "n", "m", "chronology"), q.in_domain(t, "s", ["A"], "domain"), q.status_date(t, "s", ["A"], "n", "status"),
        q.even_groups(t, ["s", "n"], "other key"), q.not_null(t, ["n"], "apart"),
    ]
    apart = {r.check_name: r.violations for rule in rules(t) for r in rule.collect()}
    gate = q.gate(rules(t))
    assert {r.check_name: r.violations for r in gate.collect()} == apart and len(apart) == 14
    plan = gate._jdf.queryExecution().optimizedPlan().toString()
    # one for each of two keys, the rows with the first, and one for the rule that does not say what it counts
    assert plan.count("Relation [") == 3
    empty = {r.check_name: r.violations for r in q.gate(rules(t.where("false"))).collect()}
    assert empty == {name: 0 for name in apart}
