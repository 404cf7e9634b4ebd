"""Joins that first make sure of what they count on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import quality


def one_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The inner join, and the checks (check_name, violations, passed) that every row has exactly one partner."""
    name = ", ".join(keys)
    rules = [quality.unique(left, keys, f"left rows with the same {name}"), quality.unique(right, keys, f"right rows with the same {name}")]
    for side, a, b in (("left", left, right), ("right", right, left)):
        missing = a.join(b.select(*keys), list(keys), "left_anti")
        rules.append(missing.agg(F.count("*").alias("violations")).select(F.lit(f"{side} rows without a partner").alias("check_name"), "violations"))
    return left.join(right, list(keys)), quality.gate(rules)


def budget_actuals(budgets: DataFrame, daily: DataFrame) -> DataFrame:
    """budgets with the sum of their account's daily amounts in [period_start, period_end), 0 without any.

    daily (account_id, day, amount) is an aggregate already, so a budget meets each day once.
    """
    d = daily.select(F.col("account_id").alias("_account"), F.col("day").alias("_day"), F.col("amount").alias("_amount"))
    on = (F.col("account_id") == F.col("_account")) & (F.col("_day") >= F.col("period_start")) & (F.col("_day") < F.col("period_end"))
    sums = budgets.join(d, on, "left").groupBy(*budgets.columns).agg(F.coalesce(F.sum("_amount"), F.lit(0)).alias("actual"))
    return sums
