"""Summaries of columns in one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def summarise(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """(column, known, missing, least, most, mean, distinct) of numeric columns, a row for each; an empty column has nulls."""
    c = lambda n: F.col(f"`{n}`")
    one = lambda n: F.struct(F.lit(n).alias("column"), F.count(c(n)).alias("known"), (F.count("*") - F.count(c(n))).alias("missing"), F.min(c(n)).cast("double").alias("least"), F.max(c(n)).cast("double").alias("most"), F.round(F.avg(c(n)), digits).cast("double").alias("mean"), F.count_distinct(c(n)).alias("distinct"))
    return df.agg(F.array(*map(one, columns)).alias("all")).select(F.explode("all").alias("s")).select("s.*")
