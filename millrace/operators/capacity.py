"""Room for defects in tables that are there, before any is put in."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.feasibility import subsets


@dataclass(frozen=True)
class Wanted:
    """percent of a table's rows, at least one unless it is zero, out of those that meet the condition `eligible`."""

    percent: float
    eligible: str


def defect_capacity(df: DataFrame, defects: Mapping[str, Wanted]) -> DataFrame:
    """(defect, eligible, wanted, lacking, feasible) for defects of one table of which no row gets two.

    Rows can be shared out among the defects exactly if every subset of them wants at most as many as are eligible for any of it, so
    all subsets are counted, in one pass that is combined before its one row is shuffled. lacking is the
    greatest shortage of a subset that the defect is in. A null condition is not met; an empty table has no room for any row, and wants none.
    """
    names, groups = list(defects), subsets(list(defects))
    met = {n: F.coalesce(F.expr(d.eligible), F.lit(False)) for n, d in defects.items()}
    flagged = df.select(*(met[n].alias(f"m{i}") for i, n in enumerate(names)))
    place = {n: F.col(f"m{i}") for i, n in enumerate(names)}
    counts = flagged.agg(F.count("*").alias("rows"), *(F.count_if(reduce(lambda a, b: a | b, (place[n] for n in s))).alias(f"any{i}") for i, s in enumerate(groups)))

    def wanted(name: str):
        p = float(defects[name].percent)
        return F.when((F.col("rows") == 0) | F.lit(p == 0), 0).otherwise(F.greatest(F.lit(1), F.ceil(F.col("rows") * F.lit(p) / 100))).cast("long")

    def lacking(name: str):
        short = [reduce(lambda a, b: a + b, map(wanted, s)) - F.col(f"any{i}") for i, s in enumerate(groups) if name in s]
        return F.greatest(F.lit(0).cast("long"), *short)

    rows = [F.struct(F.lit(n).alias("defect"), F.col(f"any{groups.index((n,))}").alias("eligible"), wanted(n).alias("wanted"), lacking(n).alias("lacking")) for n in names]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*").withColumn("feasible", F.col("lacking") == 0)
