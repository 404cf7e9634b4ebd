"""Ordered computations: running balances, rankings within groups, allocations and recurrences."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rolling_balance(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, name: str = "balance") -> DataFrame:
    """Each row with the sum of its group's amounts up to it; the order must be total."""
    return df.withColumn(name, F.sum(amount).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def repeats_after_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows that repeat an earlier row's keys."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n > 1").drop("_n")


def all_repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row whose keys occur more than once."""
    return df.join(df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n"), list(keys), "left_semi")


def latest(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """One row of each group: the one with the largest `by`."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(by)).alias("_r")).select(*keys, "_r.*")


def allocate(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str, units: Column, name: str = "units") -> DataFrame:
    """A group's whole units shared by weight: floors first, then one more from the first row on, so that the total is exact."""
    group, line = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy(*order)
    # whole division of exact products, at any size
    df = df.withColumn("_all", F.sum(weight).over(group).cast("decimal(19,0)")).withColumn("_share", units.cast("decimal(19,0)") * F.col(weight).cast("decimal(19,0)"))
    df = df.withColumn("_floor", F.expr("cast(_share div _all as bigint)")).drop("_share", "_all").withColumn("_left", units - F.sum("_floor").over(group)).withColumn("_n", F.row_number().over(line))
    return df.withColumn(name, (F.col("_floor") + (F.col("_n") <= F.col("_left")).cast("long")).cast("long")).drop("_floor", "_left", "_n")


def mean_reverting(df: DataFrame, keys: Sequence[str], order: str, shock: str, anchor: str, pull: str = "0.05", scale: int = 6) -> DataFrame:
    """rate: previous - (previous - anchor) * pull + shock, rounded half up to `scale` decimals at each step.

    Each group is one series of bounded length, such as a currency pair's days; the
    recurrence is exact decimal arithmetic, which no window function has.
    """
    unit, k = Decimal(1).scaleb(-scale), Decimal(pull)

    def run(pdf):
        pdf = pdf.sort_values(order, kind="stable")
        rates, now = [], None
        for a, s in zip(pdf[anchor], pdf[shock], strict=True):
            now = Decimal(a) if now is None else now
            now = (now - (now - Decimal(a)) * k + Decimal(s)).quantize(unit, ROUND_HALF_UP)
            rates.append(now)
        return pdf.assign(rate=rates)

    return df.groupBy(*keys).applyInPandas(run, df.drop("rate").schema.add("rate", f"decimal(19,{scale})"))
