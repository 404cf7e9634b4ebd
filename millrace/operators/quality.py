"""Declarative data-quality rules.

Every rule is a DataFrame (check_name string, violations long) of one row; `gate` unions
them and adds passed. Rules never raise for bad data. Each is one aggregation or
one anti join, so that it distributes over the keys that it checks. Rules about rows, and about groups of
one key, also say what they count, so that a gate counts all of them on a table in one pass for each key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import cut


def _result(df: DataFrame, name: str, violations: Column | None = None) -> DataFrame:
    count = F.count("*") if violations is None else violations
    return df.agg(F.coalesce(count, F.lit(0)).cast("long").alias("violations")).select(F.lit(name).alias("check_name"), "violations")


@dataclass(frozen=True)
class Counted:
    """What a rule counts on one table: for each group of keys (none: for each row) a number of violations, from aggregates that `of` takes by name."""

    name: str
    df: DataFrame
    keys: tuple[str, ...]
    aggregates: Mapping[str, Column]
    of: Callable[[Callable[[str], Column]], Column]


def where_violated(df: DataFrame, name: str, condition: Column) -> DataFrame:
    """Rows that meet the condition; a null condition is no violation."""
    out = _result(df.where(condition), name)
    out._counted = Counted(name, df, (), {}, lambda _: condition.cast("long"))
    return out


def _grouped(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, Column], name: str, of: Callable[[Callable[[str], Column]], Column]) -> DataFrame:
    """The violations of all groups."""
    groups = df.groupBy(*keys).agg(*(a.alias(f"_0_{n}") for n, a in aggregates.items()))
    out = _result(groups, name, F.sum(of(lambda n: F.col(f"_0_{n}")).cast("long")))
    out._counted = Counted(name, df, tuple(keys), aggregates, of)
    return out


def _fused(rules: Sequence[Counted]) -> list[DataFrame]:
    """All rules on one table: an aggregation for each key, of which the first takes the rules about rows along."""
    df, rows = rules[0].df, [r for r in rules if not r.keys]
    by_keys: dict[tuple[str, ...], list[Counted]] = {}
    for r in rules:
        if r.keys:
            by_keys.setdefault(r.keys, []).append(r)
    out = []
    for keys, own in (by_keys or {(): []}).items():
        taken, rows = rows, []
        own_rows = [F.sum(r.of(F.col)).alias(f"_row{i}") for i, r in enumerate(taken)]
        if not keys:
            counts = df.agg(*own_rows)
        else:
            parts = [a.alias(f"_{i}_{n}") for i, r in enumerate(own) for n, a in r.aggregates.items()]
            groups = df.groupBy(*keys).agg(*parts, *own_rows)
            sums = [F.sum(r.of(lambda n, i=i: F.col(f"_{i}_{n}")).cast("long")).alias(f"_group{i}") for i, r in enumerate(own)]
            counts = groups.agg(*sums, *(F.sum(f"_row{i}").alias(f"_row{i}") for i in range(len(taken))))
        named = [(r.name, f"_group{i}") for i, r in enumerate(own)] + [(r.name, f"_row{i}") for i, r in enumerate(taken)]
        one = F.array(*(F.struct(F.lit(n).alias("check_name"), F.coalesce(F.col(c), F.lit(0)).cast("long").alias("violations")) for n, c in named))
        out.append(counts.select(F.explode(one).alias("r")).select("r.*"))
    return out


def unique(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Keys, nulls left out, that occur more than once."""
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    return _grouped(df, keys, {"n": F.count("*")}, name, lambda c: known & (c("n") > 1))


def primary_key(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows with a null in the key, and keys that occur more than once."""
    null = reduce(lambda a, b: a | b, (F.col(k).isNull() for k in keys))
    return _grouped(df, keys, {"n": F.count("*")}, name, lambda c: F.when(null, c("n")).when(c("n") > 1, 1).otherwise(0))


def not_null(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Nulls in any of the columns, in one pass."""
    return _result(df, name, F.sum(reduce(lambda a, b: a + b, (F.col(c).isNull().cast("int") for c in columns))))


def foreign_key(child: DataFrame, key: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Child rows with a key that no parent has; null keys are no violation."""
    return _result(child.where(F.col(key).isNotNull()).join(parent.select(F.col(parent_key).alias(key)), key, "left_anti"), name)


def in_domain(df: DataFrame, column: str, values: Iterable, name: str) -> DataFrame:
    return where_violated(df, name, ~F.col(column).isin(*values))


def reference_classes(child: DataFrame, key: str, parent: DataFrame, parent_key: str, declared: Column | None = None) -> DataFrame:
    """(class, n): empty, valid, declared orphan and unexpected orphan references."""
    known = parent.select(F.col(parent_key).alias("_parent")).distinct()
    joined = child.join(known, child[key] == known["_parent"], "left")
    expected = F.lit(False) if declared is None else F.coalesce(declared, F.lit(False))
    kind = F.when(F.col(key).isNull(), "empty").when(F.col("_parent").isNotNull(), "valid").when(expected, "declared orphan").otherwise("unexpected orphan")
    return joined.groupBy(kind.alias("class")).agg(F.count("*").alias("n"))


def join_path(left: DataFrame, right: DataFrame, on: Column, required: str, name: str) -> DataFrame:
    """A declared join path: `matched` and `unmatched` want rows of that kind, `both` wants both, `complete` wants no unmatched row."""
    matched = left.join(right, on, "left_semi").agg(F.count("*").alias("m"))
    free = left.join(right, on, "left_anti").agg(F.count("*").alias("u"))
    m, u = F.col("m") == 0, F.col("u") == 0
    bad = {"matched": m.cast("long"), "unmatched": u.cast("long"), "both": m.cast("long") + u.cast("long"), "complete": F.col("u")}[required]
    # two rows of one aggregate each
    return matched.crossJoin(F.broadcast(free)).select(F.lit(name).alias("check_name"), bad.cast("long").alias("violations"))


def complete_unique_lookup(left: DataFrame, right: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Left rows without a match, and keys that several right rows have."""
    missing = left.join(right.select(*keys), list(keys), "left_anti").agg(F.count("*").alias("n"))
    several = right.groupBy(*keys).agg(F.count("*").alias("_c")).where("_c > 1").agg(F.count("*").alias("n"))
    return _result(missing.unionAll(several), name, F.sum("n"))


def many_to_many(bridge: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """1 for each direction in which no key has several partners."""
    one = lambda x, y: bridge.groupBy(x).agg(F.count_distinct(y).alias("n")).where("n > 1").agg((F.count("*") == 0).cast("long").alias("n"))
    return _result(one(a, b).unionAll(one(b, a)), name, F.sum("n"))


def row_cap(tables: Iterable[DataFrame], most: int, name: str) -> DataFrame:
    """Tables with more than `most` rows."""
    counts = reduce(DataFrame.unionAll, (t.agg(F.count("*").alias("n")) for t in tables))
    return _result(counts, name, F.sum((F.col("n") > most).cast("long")))


def sums_to(df: DataFrame, keys: Sequence[str], amount: str, expected: Column, name: str) -> DataFrame:
    """Groups whose sum differs from what is expected; a group with a null amount may have less but not more."""
    sums = {"s": F.coalesce(F.sum(amount), F.lit(0)), "partial": F.max(F.col(amount).isNull().cast("int")), "e": F.max(expected)}
    return _grouped(df, keys, sums, name, lambda c: (c("s") > c("e")) | ((c("partial") == 0) & (c("s") < c("e"))))


def balanced(parents: DataFrame, lines: DataFrame, key: str, total: str, debit: str, credit: str, name: str) -> DataFrame:
    """Parents with lines whose debits, credits and total are not all equal."""
    sums = lines.groupBy(key).agg(F.coalesce(F.sum(debit), F.lit(0)).alias("_debits"), F.coalesce(F.sum(credit), F.lit(0)).alias("_credits"))
    wrong = (F.col("_debits") != F.col("_credits")) | (F.col("_debits") != F.col("_total"))
    return _result(parents.select(key, F.col(total).alias("_total")).join(sums, key).where(wrong), name)


def exclusive(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Rows in which not exactly one of two columns is null."""
    return where_violated(df, name, F.col(a).isNull() == F.col(b).isNull())


def chronology(df: DataFrame, earlier: str, later: str, name: str) -> DataFrame:
    return where_violated(df, name, F.col(later) < F.col(earlier))


def contained(child: DataFrame, parent: DataFrame, key: str, moment: str, start: str, end: str, name: str) -> DataFrame:
    """Child rows outside their parent's window; an open end is no bound."""
    joined = child.select(key, moment).join(parent.select(key, start, end), key)
    return _result(joined.where((F.col(moment) < F.col(start)) | (F.col(moment) > F.col(end))), name)


def no_overlap(df: DataFrame, keys: Sequence[str], start: str, end: str, name: str, order: Sequence[str] = ()) -> DataFrame:
    """Intervals [start, end) that begin before an earlier one of their group ends; a null end never ends."""
    before = Window.partitionBy(*keys).orderBy(start, end, *order).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.coalesce(F.col(end), F.lit("9999-12-31").cast("date"))).over(before)
    return _result(df.withColumn("_reached", reached).where(F.col(start) < F.col("_reached")), name)


def sequence(df: DataFrame, keys: Sequence[str], number: str, name: str) -> DataFrame:
    """Groups whose numbers are not 1 .. n, each once."""
    groups = {"n": F.count("*"), "d": F.count_distinct(number), "lo": F.min(number), "hi": F.max(number)}
    return _grouped(df, keys, groups, name, lambda c: (c("lo") != 1) | (c("hi") != c("n")) | (c("d") != c("n")))


def grid(df: DataFrame, a: str, b: str, name: str) -> DataFrame:
    """Pairs of the values of two columns that no row has."""
    # counts: all pairs less those there are; no pair is listed
    return _result(df, name, F.count_distinct(a) * F.count_distinct(b) - F.count_distinct(F.struct(a, b)))


def acyclic(df: DataFrame, key: str, parent: str, name: str) -> DataFrame:
    """Rows that climb their parents forever: those of a cycle, and those below one; a valid hierarchy may have any depth.

    The steps climbed double each round, until no row has an ancestor left or more steps are made than there are rows.
    """
    climb = cut(df.select(F.col(key).alias("k"), F.col(parent).alias("p")).where("p is not null"))
    rows, steps = climb.count(), 1
    while steps <= rows:
        climb = cut(climb.alias("x").join(climb.alias("y"), F.col("x.p") == F.col("y.k")).select(F.col("x.k").alias("k"), F.col("y.p").alias("p")))
        steps *= 2
        if climb.isEmpty():
            break
    return _result(climb, name)


def same_as_parent(df: DataFrame, key: str, parent: str, column: str, name: str) -> DataFrame:
    """Rows whose column differs from that of their parent in the same table."""
    above = df.select(F.col(key).alias("_above"), F.col(column).alias("_value"))
    return _result(df.join(above, F.col(parent) == F.col("_above")).where(~F.col(column).eqNullSafe(F.col("_value"))), name)


def agrees(child: DataFrame, parent: DataFrame, key: str, column: str, name: str, required: bool = True) -> DataFrame:
    """Child rows whose value is another than their parent's, or that have one where the parent has none.

    A null in the child is no violation, unless the column is required to be the parent's.
    """
    joined = child.select(key, F.col(column).alias("_own")).join(parent.select(key, F.col(column).alias("_given")), key)
    wrong = ~F.col("_own").eqNullSafe(F.col("_given"))
    return _result(joined.where(wrong if required else F.col("_own").isNotNull() & wrong), name)


def member(child: DataFrame, pairs: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Child rows, all keys known, that are in no pair."""
    known = child.select(*keys).where(reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys)))
    return _result(known.join(pairs.select(*keys), list(keys), "left_anti"), name)


def one_each(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """Keys with several values."""
    return _grouped(df, [key], {"n": F.count_distinct(value)}, name, lambda c: c("n") > 1)


def same_pairs(a: DataFrame, b: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Distinct combinations that only one of two tables has."""
    sides = a.select(*columns, F.lit(1).alias("_side")).unionAll(b.select(*columns, F.lit(2).alias("_side")))
    return _result(sides.groupBy(*columns).agg(F.count_distinct("_side").alias("_n")).where("_n < 2"), name)


def lag_within(df: DataFrame, lag: Column, least: int, most: int, name: str) -> DataFrame:
    """Rows whose lag is outside [least, most]; a null lag is no violation."""
    return where_violated(df, name, ~lag.between(least, most))


def some(df: DataFrame, name: str) -> DataFrame:
    """1 if there is no row at all, where a question needs one."""
    return _result(df, name, (F.count("*") == 0).cast("long"))


def evidence(parents: DataFrame, children: DataFrame, key: str, status: str, demands: Mapping[str, Column], name: str) -> DataFrame:
    """Parents in a status that demands a child of some kind, which none of theirs is."""
    kinds = {s: f"_has_{i}" for i, s in enumerate(demands)}
    seen = children.groupBy(key).agg(*(F.max(demands[s].cast("int")).alias(c) for s, c in kinds.items()))
    missing = reduce(lambda a, b: a | b, ((F.col(status) == s) & (F.coalesce(F.col(c), F.lit(0)) == 0) for s, c in kinds.items()))
    return _result(parents.select(key, status).join(seen, key, "left").where(missing), name)


def at_most(df: DataFrame, key: str, counted: Column, most: int, name: str) -> DataFrame:
    """Keys for which more than `most` rows meet a condition."""
    return _grouped(df, [key], {"n": F.sum(counted.cast("int"))}, name, lambda c: c("n") > most)


def even_groups(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Groups with an odd number of rows."""
    return _grouped(df, keys, {"n": F.count("*")}, name, lambda c: c("n") % 2 == 1)


def covered(df: DataFrame, windows: DataFrame, key: str, moment: str, start: str, end: str, least: int, name: str) -> DataFrame:
    """How many windows [start, end) too few, of `least`, hold a moment of their key."""
    hit = windows.alias("w").join(df.select(F.col(key).alias("_key"), F.col(moment).alias("_moment")), (F.col(f"w.{key}") == F.col("_key")) & (F.col("_moment") >= F.col(f"w.{start}")) & (F.col("_moment") < F.col(f"w.{end}")), "left_semi")
    return _result(hit, name, F.greatest(F.lit(0), F.lit(least) - F.count("*")))


def shape(tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]], name: str) -> list[str]:
    """What differs from a contract of tables, their order, and their columns in order; schemas only, no data is read."""
    out = [] if list(tables) == list(columns) else [f"{name}: tables {list(tables)} instead of {list(columns)}"]
    return out + [f"{name}.{t}: columns {tables[t].columns} instead of {list(c)}" for t, c in columns.items() if t in tables and tables[t].columns != list(c)]


def reproducible(first: Mapping[str, DataFrame], again: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, same) of two runs of a generator: equal if the digests of all rows are, in whatever order they come."""
    from millrace.functions.answers import table_digest

    digest = lambda t, df, n: table_digest(df).select(F.lit(t).alias("table"), F.col("rows").alias(f"rows{n}"), F.col("digest").alias(f"digest{n}"))
    sides = [reduce(DataFrame.unionAll, [digest(t, df, n) for t, df in tables.items()]) for n, tables in (("", first), ("2", again))]
    joined = sides[0].join(sides[1], "table", "full")
    return joined.select("table", "rows", F.col("digest").eqNullSafe(F.col("digest2")).alias("same"))


def fixed_scale(df: DataFrame, column: str, digits: int, scale: int, name: str) -> DataFrame:
    """Texts that are not numbers of exactly `scale` decimals that fit `digits` digits."""
    return where_violated(df, name, F.col(column).isNotNull() & ~F.col(column).rlike(rf"^-?\d{{1,{digits - scale}}}\.\d{{{scale}}}$"))


def appears_once(df: DataFrame, column: str, values: Sequence, name: str) -> DataFrame:
    """Boundary values that are missing or repeated."""
    counts = df.where(F.col(column).isin(*values)).groupBy(column).agg(F.count("*").alias("n"))
    return _result(counts, name, F.lit(len(values)) - F.coalesce(F.sum((F.col("n") == 1).cast("int")), F.lit(0)))


def exact_count(df: DataFrame, condition: Column, expected: int, name: str) -> DataFrame:
    """How far the number of rows that meet the condition is from what is expected."""
    return _result(df, name, F.abs(F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)) - F.lit(expected)))


def duplicate_groups(df: DataFrame, keys: Sequence[str], stable: Sequence[str], varying: Sequence[str]) -> DataFrame:
    """(groups, rows, changed, exact): groups of repeated business keys, those whose stable columns differ, and those without any variation."""
    g = df.groupBy(*keys).agg(F.count("*").alias("n"), F.count_distinct(F.struct(*stable)).alias("s"), F.count_distinct(F.struct(*varying)).alias("v")).where("n > 1")
    return g.agg(F.count("*").alias("groups"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum((F.col("s") > 1).cast("long")), F.lit(0)).alias("changed"), F.coalesce(F.sum((F.col("v") == 1).cast("long")), F.lit(0)).alias("exact"))


def status_date(df: DataFrame, status: str, filled: Sequence[str], date: str, name: str) -> DataFrame:
    """Rows whose date is null in a status that has one, or set in one that has none."""
    return where_violated(df, name, F.col(status).isin(*filled) != F.col(date).isNotNull())


def gate(rules: Iterable[DataFrame]) -> DataFrame:
    """(check_name, violations, passed) of all rules; what rules count on the same table object is counted in one pass for each key."""
    by_table: dict[int, list[Counted]] = {}
    parts = []
    for rule in rules:
        counted = getattr(rule, "_counted", None)
        if counted is None:
            parts.append(rule)
        else:
            by_table.setdefault(id(counted.df), []).append(counted)
    for own in by_table.values():
        parts += _fused(own)
    return reduce(DataFrame.unionAll, parts).withColumn("passed", F.col("violations") == 0)


def assert_all_passed(checks: DataFrame) -> None:
    """Raise one error that names every failed check; the rules, not the data, bound what comes to the driver."""
    failed = [f"{r.check_name}: {r.violations}" for r in checks.where(~F.col("passed")).orderBy("check_name").collect()]
    if failed:
        raise ValueError("failed checks: " + "; ".join(failed))
