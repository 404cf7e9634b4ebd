"""Counts along declared join paths, and audits of near duplicates, without the joins or comparisons they speak of."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Hop:
    """A join of a path: the table joined, the columns before and in it that have to be equal, and whether rows without a partner stay."""

    df: DataFrame
    left: tuple[str, ...]
    right: tuple[str, ...]
    keep: bool = False


def _known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(c).isNotNull() for c in columns))


def _named(columns: Sequence[str]) -> list[Column]:
    return [F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)]


def path_counts(first: DataFrame, hops: Sequence[Hop], name: str) -> DataFrame:
    """(path, joined_rows, unmatched_rows): the rows of the joins of a path of tables, and the first table's rows without a partner in the second.

    From the last table backwards, each key gets the number of rows that the rest of the path makes of it; a table is
    aggregated once and joined with the next one's keys, so that no step has more rows than a table. `left` names columns of the table
    before, `right` of the hop's own. Null keys have no partner; empty tables count as 0.
    """
    if not hops:
        raise ValueError("a path needs a join")
    rest: DataFrame | None = None
    exact = "decimal(38,0)"
    # a row without a partner stays if this join and all after it, which have nothing to go by, keep such rows
    alone = lambda i: F.lit(int(all(h.keep for h in hops[i:]))).cast(exact)
    for i in reversed(range(len(hops))):
        hop = hops[i]
        rows, times = hop.df, F.lit(1).cast(exact)
        if rest is not None:
            after = hops[i + 1]
            rows = rows.select(*_named(hop.right), *(F.col(c).alias(f"_n{j}") for j, c in enumerate(after.left)))
            rows = rows.join(rest, [F.col(f"_n{j}") == F.col(f"_r{j}") for j in range(len(after.left))], "left")
            times = F.coalesce("_times", alone(i + 1))
        else:
            rows = rows.select(*_named(hop.right))
        keys = [f"_k{j}" for j in range(len(hop.right))]
        rest = rows.where(_known(keys)).groupBy(*(F.col(k).alias(f"_r{j}") for j, k in enumerate(keys))).agg(F.sum(times).cast(exact).alias("_times"))
    hop = hops[0]
    joined = first.select(*_named(hop.left)).join(rest, [F.col(f"_k{j}") == F.col(f"_r{j}") for j in range(len(hop.left))], "left")
    times = F.coalesce("_times", alone(0))
    return joined.agg(F.coalesce(F.sum(times), F.lit(0)).cast("long").alias("joined_rows"), F.coalesce(F.sum(F.col("_times").isNull().cast("long")), F.lit(0)).alias("unmatched_rows")).select(F.lit(name).alias("path"), "joined_rows", "unmatched_rows")


def path_rules(counts: DataFrame, required: str) -> DataFrame:
    """(check_name, violations) of a path: `non_empty` wants joined rows, `non_empty_with_unmatched_parent_rows` unmatched ones as well."""
    checks = {"joined_rows": F.col("joined_rows") == 0}
    if required == "non_empty_with_unmatched_parent_rows":
        checks["unmatched_parent_rows"] = F.col("unmatched_rows") == 0
    elif required != "non_empty":
        raise ValueError(required)
    one = F.array(*(F.struct(F.concat(F.col("path"), F.lit(f".{n}")).alias("check_name"), bad.cast("long").alias("violations")) for n, bad in checks.items()))
    return counts.select(F.explode(one).alias("r")).select("r.*")


def _digest(columns: Sequence[str]) -> Column:
    texts = [F.col(c).cast("string") for c in columns]
    return F.sha2(F.concat(*(F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts), F.lit("")), 256)


def near_duplicate_audit(df: DataFrame, columns: Sequence[str], permitted: Sequence[str] = ()) -> DataFrame:
    """(column, groups, rows, permitted): rows that are equal in all of `columns` but one, by the column in which they differ.

    Every row is sent once for each column, as a digest of the others, so that rows which differ in that column alone meet; no
    pair is compared. Exact copies alone make no group; a null is a value of its own. Columns that are not permitted to vary are
    reported as such. Every column has a row, with 0 where nothing differs.
    """
    entry = [F.struct(F.lit(c).alias("column"), _digest([x for x in columns if x != c]).alias("others"), _digest([c]).alias("own")) for c in columns]
    sent = df.select(F.explode(F.array(*entry)).alias("e")).select("e.*")
    # copies are combined first, so that a value that many rows share is one row
    values = sent.groupBy("column", "others", "own").agg(F.count("*").alias("n"))
    groups = values.groupBy("column", "others").agg(F.sum("n").alias("rows"), F.count("*").alias("kinds")).where("kinds > 1")
    found = groups.groupBy("column").agg(F.count("*").alias("groups"), F.sum("rows").alias("rows"))
    names = df.sparkSession.createDataFrame([(c, c in permitted) for c in columns], "column string, permitted boolean")
    none = F.lit(0).cast("long")
    return names.join(F.broadcast(found), "column", "left").select("column", F.coalesce("groups", none).alias("groups"), F.coalesce("rows", none).alias("rows"), "permitted")
