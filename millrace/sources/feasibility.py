"""Whether a generator's plan can be carried out, found from its figures alone before anything runs."""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import combinations
from math import prod

from millrace.operators.synth import count_of


@dataclass(frozen=True)
class Relation:
    """child refers to parent; `parents` percent of the parents have `least` to `most` children, the others none."""

    child: str
    parent: str
    least: int = 0
    most: int | None = None
    parents: float = 100
    required: bool = True


@dataclass(frozen=True)
class Bridge:
    """A table with each pair of a left and a right row at most once, and with all rows of both sides if `covers`."""

    table: str
    left: str
    right: str
    covers: bool = True


@dataclass(frozen=True)
class Grid:
    """A table with one row for every combination of its sides."""

    table: str
    sides: Mapping[str, int]


@dataclass(frozen=True)
class Window:
    """Dates from first to last, both included, on `days` different days, each at least `lag` days after one of the window `after`."""

    first: str
    last: str
    days: int = 1
    after: str | None = None
    lag: int = 0


@dataclass(frozen=True)
class Defect:
    """percent of a table's rows get the defect, out of the `eligible` percent that may; no row gets two of a group `apart`."""

    table: str
    percent: float
    eligible: float = 100
    apart: str | None = None


@dataclass(frozen=True)
class Plan:
    targets: Mapping[str, int]
    relations: Sequence[Relation] = ()
    bridges: Sequence[Bridge] = ()
    grids: Sequence[Grid] = ()
    windows: Mapping[str, Window] = field(default_factory=dict)
    defects: Mapping[str, Defect] = field(default_factory=dict)


def table_order(plan: Plan) -> tuple[list[str], list[str]]:
    """(tables with parents before their children, tables that are on or behind a cycle of required relations)."""
    above = {t: {r.parent for r in plan.relations if r.child == t and r.required and r.parent in plan.targets} for t in plan.targets}
    order: list[str] = []
    while ready := [t for t in above if t not in order and above[t] <= set(order)]:
        order += ready
    return order, [t for t in above if t not in order]


def _relations(plan: Plan) -> Iterator[str]:
    for r in plan.relations:
        what, n, rows = f"{r.child} of {r.parent}", plan.targets[r.child], plan.targets[r.parent]
        having = rows if r.parents == 100 else rows * r.parents // 100
        if not 0 <= r.parents <= 100:
            yield f"{what}: {r.parents} percent of the parents"
        elif r.most is not None and r.most < r.least:
            yield f"{what}: from {r.least} to {r.most} children"
        elif n and r.required and not having:
            yield f"{what}: {n} rows without a parent"
        elif r.required and n < having * r.least:
            yield f"{what}: {n} rows for {int(having)} parents with at least {r.least}"
        elif r.required and r.most is not None and n > having * r.most:
            yield f"{what}: {n} rows for {int(having)} parents with at most {r.most}"


def _pairs(plan: Plan) -> Iterator[str]:
    for b in plan.bridges:
        n, left, right = (plan.targets[t] for t in (b.table, b.left, b.right))
        if n > left * right:
            yield f"{b.table}: {n} pairs of {left} {b.left} and {right} {b.right}"
        if b.covers and n < max(left, right):
            yield f"{b.table}: {n} pairs cannot cover {left} {b.left} and {right} {b.right}"
    for g in plan.grids:
        if plan.targets[g.table] != prod(g.sides.values()):
            yield f"{g.table}: {plan.targets[g.table]} rows for {' times '.join(f'{n} {s}' for s, n in g.sides.items())}"


def _windows(plan: Plan) -> Iterator[str]:
    earliest: dict[str, datetime.date] = {}

    def start(name: str, seen: tuple[str, ...] = ()) -> datetime.date:
        w = plan.windows[name]
        if name not in earliest:
            own = datetime.date.fromisoformat(w.first)
            chained = w.after in plan.windows and w.after not in (*seen, name)
            earliest[name] = max(own, start(w.after, (*seen, name)) + datetime.timedelta(days=w.lag)) if chained else own
        return earliest[name]

    for name, w in plan.windows.items():
        if w.after is not None and w.after not in plan.windows:
            yield f"window {name}: there is no window {w.after}"
        left = (datetime.date.fromisoformat(w.last) - start(name)).days + 1
        if left < w.days:
            yield f"window {name}: {max(left, 0)} days from {start(name)} to {w.last}, not {w.days}"
        at, seen = w.after, {name}
        while at in plan.windows and at not in seen:
            seen.add(at)
            at = plan.windows[at].after
        if at == name:
            yield f"window {name}: it has to follow itself"


def _defects(plan: Plan) -> Iterator[str]:
    groups: dict[tuple, dict[str, tuple[int, int]]] = {}
    for name, d in plan.defects.items():
        rows = plan.targets.get(d.table)
        if rows is None:
            yield f"defect {name}: there is no table {d.table}"
        elif not (0 <= d.percent <= 100 and 0 <= d.eligible <= 100):
            yield f"defect {name}: percents are from 0 to 100"
        else:
            wanted, may = count_of(rows, d.percent) if d.percent else 0, int(rows * d.eligible // 100)
            groups.setdefault((d.table, d.apart or f"only {name}"), {})[name] = (wanted, may)
    for (table, _), some in groups.items():
        for name, (wanted, may) in some.items():
            if wanted > may:
                yield f"defect {name}: {wanted} rows of {may}"
        if sum(w for w, _ in some.values()) > plan.targets[table]:
            yield f"defects {', '.join(some)}: {sum(w for w, _ in some.values())} rows of {plan.targets[table]}"


def infeasible(plan: Plan) -> list[str]:
    """All that makes a plan impossible; empty if its figures leave room for the rows, pairs, dates and defects it names."""
    named = {t for r in plan.relations for t in (r.child, r.parent)} | {t for b in plan.bridges for t in (b.table, b.left, b.right)} | {g.table for g in plan.grids}
    out = [f"{t}: there is no target" for t in sorted(named - set(plan.targets))] + [f"{t}: {n} rows" for t, n in plan.targets.items() if n < 0]
    if out:
        return out
    out = [f"{t}: no order of tables puts parents first" for t in table_order(plan)[1]]
    for check in (_relations, _pairs, _windows, _defects):
        out += check(plan)
    return out


def require_feasible(plan: Plan) -> None:
    """An error that names all that makes a plan impossible."""
    if found := infeasible(plan):
        raise ValueError("; ".join(found))


def subsets(names: Sequence[str], most: int = 8) -> list[tuple[str, ...]]:
    """All subsets but the empty one; more than `most` names are an error, as their subsets are too many to count."""
    if len(names) > most:
        raise ValueError(f"a group has {len(names)} defects, more than {most}")
    return [s for n in range(1, len(names) + 1) for s in combinations(names, n)]
