"""Plans that can and cannot be carried out, and room for defects in tables, against plain search."""

import itertools
import random

import pytest

from millrace.operators.capacity import Wanted, defect_capacity
from millrace.plans import crm_tables, finance_tables
from millrace.sources.feasibility import Bridge, Defect, Grid, Plan, Relation, Window, infeasible, table_order

GOOD = Plan(
    {"a": 10, "b": 40, "c": 5, "ab": 60, "g": 30},
    [Relation("b", "a", 2, 8, 50), Relation("c", "c", required=False), Relation("ab", "a", 1), Relation("ab", "b", 1)],
    [Bridge("ab", "a", "b")],
    [Grid("g", {"days": 6, "names": 5})],
    {"made": Window("2024-01-01", "2024-01-31", 20), "used": Window("2024-01-10", "2024-02-10", 12, "made", 29)},
    {"null": Defect("b", 50, 60, "x"), "odd": Defect("b", 50, 100, "x"), "late": Defect("b", 100)},
)


def changed(**parts):
    return Plan(**{f: parts.get(f, getattr(GOOD, f)) for f in ("targets", "relations", "bridges", "grids", "windows", "defects")})


def test_a_plan_that_fits():
    assert infeasible(GOOD) == []
    order, behind = table_order(GOOD)
    assert not behind and order.index("a") < order.index("b") < order.index("ab")
    for targets in crm_tables.TARGETS.values():
        assert infeasible(crm_tables.Crm(targets).plan) == []
    for targets in finance_tables.TARGETS.values():
        assert infeasible(finance_tables.Finance(targets).plan) == []


@pytest.mark.parametrize(
    "plan, said",
    [
        (changed(targets={**GOOD.targets, "b": 9}), "b of a: 9 rows for 5 parents with at least 2"),
        (changed(targets={**GOOD.targets, "b": 41}), "b of a: 41 rows for 5 parents with at most 8"),
        (changed(targets={**GOOD.targets, "a": 1}), "b of a: 40 rows without a parent"),
        (changed(targets={**GOOD.targets, "ab": 401}), "ab: 401 pairs of 10 a and 40 b"),
        (changed(targets={**GOOD.targets, "ab": 39}), "ab: 39 pairs cannot cover 10 a and 40 b"),
        (changed(targets={**GOOD.targets, "g": 31}), "g: 31 rows for 6 days times 5 names"),
        (changed(targets={"a": 1}), "ab: there is no target"),
        (changed(targets={**GOOD.targets, "c": -1}), "c: -1 rows"),
        (changed(relations=[Relation("a", "b"), Relation("b", "a")]), "a: no order of tables puts parents first"),
        (changed(relations=[Relation("c", "c")]), "c: no order of tables puts parents first"),
        (changed(relations=[Relation("b", "a", 3, 2)]), "b of a: from 3 to 2 children"),
        (changed(relations=[Relation("b", "a", parents=101)]), "b of a: 101 percent of the parents"),
        (changed(windows={"w": Window("2024-01-01", "2024-01-10", 11)}), "window w: 10 days from 2024-01-01 to 2024-01-10, not 11"),
        (changed(windows={**GOOD.windows, "used": Window("2024-01-10", "2024-02-10", 13, "made", 29)}), "window used: 12 days from 2024-01-30 to 2024-02-10, not 13"),
        (changed(windows={"w": Window("2024-01-01", "2024-01-10", after="v")}), "window w: there is no window v"),
        (changed(windows={"w": Window("2024-01-01", "2024-01-10", after="w")}), "window w: it has to follow itself"),
        (changed(defects={"d": Defect("b", 50, 49)}), "defect d: 20 rows of 19"),
        (changed(defects={"d": Defect("b", 60, apart="x"), "e": Defect("b", 41, apart="x")}), "defects d, e: 41 rows of 40"),
        (changed(defects={"d": Defect("z", 1)}), "defect d: there is no table z"),
        (changed(defects={"d": Defect("b", 101)}), "defect d: percents are from 0 to 100"),
    ],
)
def test_one_broken_figure_at_a_time(plan, said):
    assert said in infeasible(plan)


def test_domains_refuse_what_they_cannot_make():
    crm, finance = crm_tables.TARGETS["dev"], finance_tables.TARGETS["dev"]
    for bad in ({"contact_campaigns": 299}, {"contact_campaigns": 15_001}, {"accounts": 0}):
        with pytest.raises(ValueError):
            crm_tables.Crm(crm | bad)
    with pytest.raises(ValueError, match="window"):
        crm_tables.Crm(crm, today="2022-06-01")
    with pytest.raises(ValueError, match="window rates"):
        finance_tables.Finance(finance | {"fx_rates": 5000})


def test_room_for_defects(spark):
    draw = random.Random(5)
    for _ in range(4):
        rows = [tuple(draw.choice([True, False, False, None]) for _ in range(3)) for _ in range(draw.randint(4, 7))]
        percents = [draw.choice([0, 15, 30, 45, 60]) for _ in range(3)]
        df = spark.createDataFrame(rows, "a boolean, b boolean, c boolean")
        found = {r.defect: r for r in defect_capacity(df, {n: Wanted(p, n) for n, p in zip("abc", percents, strict=True)}).collect()}
        wanted = [found[n].wanted for n in "abc"]
        assert wanted == [0 if p == 0 else max(1, -(-len(rows) * p // 100)) for p in percents]
        assert [found[n].eligible for n in "abc"] == [sum(r[i] is True for r in rows) for i in range(3)]
        # every way to give each row one defect at most
        ways = itertools.product(*([None, *(i for i in range(3) if r[i])] for r in rows))
        possible = any(all(w.count(i) >= wanted[i] for i in range(3)) for w in ways)
        assert possible == all(found[n].feasible for n in "abc")


def test_room_in_an_empty_table(spark):
    empty = spark.createDataFrame([], "a boolean")
    assert [tuple(r) for r in defect_capacity(empty, {"d": Wanted(50, "a")}).collect()] == [("d", 0, 0, 0, True)]
    with pytest.raises(ValueError, match="more than 8"):
        defect_capacity(empty, {str(i): Wanted(1, "a") for i in range(9)})
