"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch


def connected(edges: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (a long, b long); root is the smallest node that it reaches.

    Each round maps every neighbour onto the smallest one with aggregations
    (combined before the shuffle) and joins; no neighbour list is ever gathered.
    Loops and repeated edges are allowed; an empty table gives an empty table.
    """
    now = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now, before = scratch.table(now, "edges"), None
    for _ in range(most_rounds):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # written, so that the join with it is of two plain exchanges and can be split at a star's centre
        least = scratch.table(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "least")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).distinct()
        # of a node's smaller neighbours all but the smallest are moved to it, and the node itself stays with it
        moved = small.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).unionAll(low.select("a", F.col("m").alias("b"))).distinct()
        after = scratch.table(moved, "edges")
        sums = lambda t: t.agg(F.count("*"), F.expr("sum(cast(xxhash64(a, b) as decimal(38)))")).first()
        mark = sums(after)
        scratch.drop(now, least)
        same, now, before = mark == before, after, mark
        if same:
            break
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root"))).distinct()
