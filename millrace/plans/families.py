"""Parameterised question families: one declaration gives a DataFrame plan and independent SQL text.

A family names its tables, joins, conditions and measure. `frame` builds the plan with
DataFrame operations (anti joins as left_anti, residual conditions in the join,
top-k as a take-ordered limit); `sql` writes the same question for another engine,
with anti joins as LEFT JOIN .. IS NULL. Parameters are `:name` in conditions.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The quarters that period comparisons take, half-open; and the day that counts as today.
BEFORE, SINCE, UNTIL, TODAY = "2026-01-01", "2026-04-01", "2026-07-01", "2026-08-01"


def literal(value) -> str:
    """A SQL literal of a parameter, with quotes doubled."""
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, (int, float)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def bind(text: str, params: Mapping) -> str:
    """text with each :name replaced; an unknown name is an error."""
    return re.sub(r"(?<![:\w]):([a-z_]+)", lambda m: literal(params[m[1]]), text)


@dataclass(frozen=True)
class Join:
    table: str
    on: str
    how: str = "inner"
    #: The name under which the table takes part, if not its own.
    alias: str = ""
    #: A column of the table that is never null, for the SQL form of an anti join.
    key: str = ""

    @property
    def name(self) -> str:
        return self.alias or self.table


@dataclass(frozen=True)
class Measure:
    kind: str
    of: str = ""
    digits: int | None = None

    def sql(self) -> str:
        whole = {"count": "COUNT(*)", "distinct": f"COUNT(DISTINCT {self.of})", "sum": f"SUM({self.of})"}
        if self.kind == "percent":
            return f"CAST(ROUND(CAST(100 AS DOUBLE) * SUM(CASE WHEN {self.of} THEN 1 ELSE 0 END) / NULLIF(COUNT(*), 0), {self.digits}) AS DOUBLE)"
        if self.digits is None:
            return f"CAST({whole[self.kind]} AS BIGINT)"
        return f"CAST(ROUND({whole[self.kind]}, {self.digits}) AS DOUBLE)"

    def column(self) -> Column:
        if self.kind == "count":
            return F.count("*").cast("long")
        if self.kind == "distinct":
            return F.count_distinct(F.expr(self.of)).cast("long")
        if self.kind == "percent":
            hits, rows = F.count(F.when(F.expr(self.of), 1)).cast("double"), F.count("*")
            return F.round(F.lit(100.0) * hits / F.nullif(rows, F.lit(0)), self.digits)
        total = F.sum(F.expr(self.of))
        return total.cast("long") if self.digits is None else F.round(total, self.digits).cast("double")


COUNT = Measure("count")


def total(of: str, digits: int | None = None) -> Measure:
    return Measure("sum", of, digits)


def percent(condition: str) -> Measure:
    return Measure("percent", condition, 2)


def distinct(of: str) -> Measure:
    return Measure("distinct", of)


@dataclass(frozen=True)
class Family:
    """One question family.

    by: what the answer is broken down by, as (entity, *other grouping columns).
    periods: (date, amount) compares two quarters instead of measuring.
    """

    id: str
    question: str
    table: str
    joins: tuple[Join, ...] = ()
    where: str = ""
    measure: Measure = COUNT
    by: tuple[str, ...] = ()
    top: int | None = None
    order: str = "value"
    having: str = ""
    periods: tuple[str, str] | None = None
    digits: int | None = None
    params: Mapping = field(default_factory=dict)

    def _joined(self, tables: Mapping[str, DataFrame], params: Mapping) -> DataFrame:
        df = tables[self.table].alias(self.table)
        left = [j for j in self.joins if j.how == "left"]
        if self.where and left:
            df = df.where(bind(self.where, params))
        for j in self.joins:
            how = {"anti": "left_anti"}.get(j.how, j.how)
            df = df.join(tables[j.table].alias(j.name), F.expr(bind(j.on, params)), how)
        return df.where(bind(self.where, params)) if self.where and not left else df

    def frame(self, tables: Mapping[str, DataFrame], **params) -> DataFrame:
        """The answer: value, or entity and value, or the columns of a comparison."""
        params = {**self.params, **params}
        df = self._joined(tables, params)
        if self.periods:
            return self._compared(df)
        if not self.by:
            return df.agg(self.measure.column().alias("value"))
        keys = [F.expr(k).alias(f"k{i}") for i, k in enumerate(self.by)]
        out = df.groupBy(*keys).agg(self.measure.column().alias("value"))
        if self.having:
            out = out.where(bind(self.having, params))
        entity = F.col("k0").cast("string").alias("entity")
        order = [F.col("k0").asc_nulls_last()] if self.order == "entity" else [F.col("value").desc_nulls_last(), F.col("k0").asc_nulls_last(), *(F.col(f"k{i}").asc_nulls_last() for i in range(1, len(self.by)))]
        out = out.orderBy(*order)
        return (out.limit(self.top) if self.top else out).select(entity, "value")

    def _compared(self, df: DataFrame) -> DataFrame:
        day, amount = (F.expr(x) for x in self.periods)
        kind = "long" if self.digits is None else "double"
        bucket = lambda lo, hi: F.coalesce(F.sum(F.when((day >= F.lit(lo).cast("date")) & (day < F.lit(hi).cast("date")), amount)), F.lit(0))
        within = df.where((day >= F.lit(BEFORE).cast("date")) & (day < F.lit(UNTIL).cast("date")))
        sums = [bucket(BEFORE, SINCE).alias("a"), bucket(SINCE, UNTIL).alias("b")]
        out = within.groupBy(F.expr(self.by[0]).alias("k0")).agg(*sums) if self.by else within.agg(*sums)
        value = lambda c: c.cast(kind) if self.digits is None else F.round(c, self.digits).cast(kind)
        a, b = F.col("a"), F.col("b")
        pct = F.round((b - a).cast("double") * 100.0 / F.nullif(a.cast("double"), F.lit(0.0)), 2)
        cols = [value(a).alias("before_total"), value(b).alias("after_total"), value(b - a).alias("absolute_change"), pct.alias("pct_change"), F.when(b > a, "increase").when(b < a, "decrease").otherwise("no change").alias("direction")]
        if not self.by:
            return out.select(*cols)
        out = out.select(F.col("k0").cast("string").alias("entity"), *cols).orderBy(F.col("pct_change").desc_nulls_last(), F.col("entity").asc_nulls_last())
        return out.limit(self.top) if self.top else out

    def sql(self, **params) -> str:
        """The same question as SQL text over the same tables."""
        params = {**self.params, **params}
        text, conditions = f"FROM {self.table}", [bind(self.where, params)] if self.where else []
        for j in self.joins:
            name = f"{j.table} AS {j.alias}" if j.alias else j.table
            text += f" {'INNER' if j.how == 'inner' else 'LEFT'} JOIN {name} ON {bind(j.on, params)}"
            if j.how == "anti":
                conditions.append(f"{j.name}.{j.key} IS NULL")
        within = " AND ".join(f"({c})" for c in conditions)
        if self.periods:
            return self._compared_sql(text, within)
        text += f" WHERE {within}" if within else ""
        if not self.by:
            return f"SELECT {self.measure.sql()} AS value {text}"
        keys = ", ".join(f"{k} AS k{i}" for i, k in enumerate(self.by))
        groups = ", ".join(self.by)
        inner = f"SELECT {keys}, {self.measure.sql()} AS value {text} GROUP BY {groups}"
        order = "k0 ASC NULLS LAST" if self.order == "entity" else "value DESC NULLS LAST, " + ", ".join(f"k{i} ASC NULLS LAST" for i in range(len(self.by)))
        outer = f"SELECT CAST(k0 AS VARCHAR) AS entity, value FROM ({inner}) AS g"
        outer += f" WHERE {bind(self.having, params)}" if self.having else ""
        return f"{outer} ORDER BY {order}" + (f" LIMIT {self.top}" if self.top else "")

    def _compared_sql(self, text: str, within: str) -> str:
        day, amount = self.periods
        span = f"{day} >= DATE '{BEFORE}' AND {day} < DATE '{UNTIL}'"
        bucket = lambda lo, hi: f"COALESCE(SUM(CASE WHEN {day} >= DATE '{lo}' AND {day} < DATE '{hi}' THEN {amount} END), 0)"
        key = f"{self.by[0]} AS k0, " if self.by else ""
        inner = f"SELECT {key}{bucket(BEFORE, SINCE)} AS a, {bucket(SINCE, UNTIL)} AS b {text} WHERE {span}" + (f" AND {within}" if within else "") + (f" GROUP BY {self.by[0]}" if self.by else "")
        value = lambda x: f"CAST({x} AS BIGINT)" if self.digits is None else f"CAST(ROUND({x}, {self.digits}) AS DOUBLE)"
        cols = f"{value('a')} AS before_total, {value('b')} AS after_total, {value('b - a')} AS absolute_change, ROUND(CAST(b - a AS DOUBLE) * 100 / NULLIF(CAST(a AS DOUBLE), 0), 2) AS pct_change, CASE WHEN b > a THEN 'increase' WHEN b < a THEN 'decrease' ELSE 'no change' END AS direction"
        if not self.by:
            return f"SELECT {cols} FROM ({inner}) AS p"
        return f"SELECT CAST(k0 AS VARCHAR) AS entity, {cols} FROM ({inner}) AS p ORDER BY pct_change DESC NULLS LAST, entity ASC NULLS LAST" + (f" LIMIT {self.top}" if self.top else "")
