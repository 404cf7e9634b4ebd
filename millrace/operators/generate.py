"""Tables made from scratch: dense keys, attributes as functions of keys, and exact totals of children.

A table is a range of keys from 1 on, so that a foreign key is arithmetic on the number of parents, and whatever
a child has to know of its parent is drawn again from the parent's key instead of being joined. Only how many children each
parent has goes through the data: cumulative weights, rounded down, give every parent a run of child
numbers, and all runs together exactly the total.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import synth

#: Keys of one window when weights are added up.
BUCKET_KEYS = 1 << 16


@dataclass(frozen=True)
class Draws:
    """Draws of one table: every stream is a function of the seed, its name and a key."""

    seed: int
    table: str

    def u(self, stream: str, *key: Column) -> Column:
        return synth.uniform(self.seed, f"{self.table}.{stream}", *key)

    def whole(self, stream: str, least: int, most: int | Column, *key: Column) -> Column:
        """From least to most, both included."""
        return F.least(F.floor(self.u(stream, *key) * (most - F.lit(least) + 1)).cast("long") + least, F.lit(most).cast("long"))

    def one(self, stream: str, values: Sequence[str], *key: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), self.whole(stream, 1, len(values), *key).cast("int"))

    def weighted(self, stream: str, weights: Mapping[str, float], *key: Column) -> Column:
        return synth.choose(self.u(stream, *key), weights)

    def chance(self, stream: str, p: float, *key: Column) -> Column:
        return self.u(stream, *key) < p

    def moment(self, stream: str, start: Column, end: Column, *key: Column) -> Column:
        """A second from start to end, both included; start where end is before it."""
        seconds = F.greatest(F.lit(0), F.unix_timestamp(end) - F.unix_timestamp(start))
        return F.timestamp_seconds(F.unix_timestamp(start) + F.least(seconds, F.floor(self.u(stream, *key) * (seconds + 1)).cast("long")))

    def word(self, stream: str, syllables: Sequence[str], n: int, *key: Column) -> Column:
        """A name of n syllables."""
        return F.initcap(F.concat(*(self.one(f"{stream}{i}", syllables, *key) for i in range(n))))


def keys(spark: SparkSession, n: int, name: str) -> DataFrame:
    """(name): 1 to n, dense, without a sort."""
    return spark.range(1, n + 1).withColumnRenamed("id", name)


def fan_out(parents: DataFrame, key: str, weight: str, total: int, least: int = 0, most: int | None = None) -> DataFrame:
    """(key, units, first): `total` children over all parents by whole weights, each with `least` and more; first is the number of children before.

    Weights are added up in two steps, over runs of keys and within them. A total below what `least` asks for, more than `most` for a
    parent, or weights that are all 0, are errors. Keys are whole numbers, each once.
    """
    own = parents.select(key, F.col(weight).cast("long").alias("_w"), F.floor(F.col(key) / BUCKET_KEYS).alias("_bucket"))
    sums = own.groupBy("_bucket").agg(F.sum("_w").alias("_sum"), F.count("*").alias("_many"))
    line = Window.orderBy("_bucket")
    # one row for each 65,536 keys
    sums = sums.select("_bucket", (F.sum("_sum").over(line) - F.col("_sum")).alias("_before"), (F.sum("_many").over(line) - F.col("_many")).alias("_place"))
    every, rows = parents.agg(F.coalesce(F.sum(F.col(weight).cast("long")), F.lit(0)), F.count("*")).first()
    rest = total - least * rows
    if rest < 0 or (rest and not every):
        raise ValueError(f"{total} children cannot be shared by {rows} parents with at least {least} each and weights of {every}")
    within = Window.partitionBy("_bucket").orderBy(key)
    lined = own.join(sums, "_bucket").withColumn("_upto", F.col("_before") + F.sum("_w").over(within)).withColumn("_n", F.col("_place") + F.row_number().over(within) - 1)
    share = lambda c: F.call_function("div", F.lit(rest).cast("decimal(19,0)") * c.cast("decimal(19,0)"), F.lit(max(1, every)).cast("decimal(19,0)"))
    begin, end = share(F.col("_upto") - F.col("_w")), share(F.col("_upto"))
    out = lined.select(key, (end - begin + least).alias("units"), (begin + F.col("_n") * least).alias("first"))
    if most is not None and out.where(F.col("units") > most).limit(1).count():
        raise ValueError(f"a parent has more than {most} children")
    return out


def children(shared: DataFrame, name: str) -> DataFrame:
    """A row for each child of fan_out's parents, with `name`, dense from 1, and position, from 0 within its parent."""
    rows = shared.where("units > 0").withColumn("position", F.explode(F.sequence(F.lit(0).cast("long"), F.col("units") - 1)))
    return rows.withColumn(name, F.col("first") + F.col("position") + 1).drop("first")


def turned(x: Column, n: int, seed: int) -> Column:
    """A permutation of 0 to n - 1: numbers that follow each other are spread."""
    step = max(1, int(n * 0.6180339887))
    while gcd(step, n) > 1:
        step += 1
    return F.pmod(x * step + seed, F.lit(n))


def at_boundaries(df: DataFrame, key: str, anchor: str, values: Sequence[str], derived: Mapping[str, Column], seed: int = 42) -> DataFrame:
    """df in which the first drawn row's anchor is the first value, and so on, each once.

    derived gives the columns that depend on the anchor as expressions of `_from` and `_to`, the anchor before and
    after; other rows stay as they are. More values than rows are an error.
    """
    if df.limit(len(values)).count() < len(values):
        raise ValueError(f"{len(values)} boundaries for fewer rows")
    kind = df.schema[anchor].dataType
    ranked = synth.chosen(df, key, len(values), seed, f"boundary:{anchor}")
    to = F.element_at(F.array(*map(F.lit, values)), F.col("rank")).cast(kind)
    joined = df.join(F.broadcast(ranked.withColumn("_to", to).select(key, "_to")), key, "left").withColumn("_from", F.col(anchor))
    moved = F.col("_to").isNotNull()
    new = {c: F.when(moved, e).otherwise(F.col(c)) for c, e in derived.items()}
    return joined.withColumns({**new, anchor: F.coalesce("_to", anchor)}).select(*df.columns)


@dataclass(frozen=True)
class Level:
    """A table of a tree: its rows' own key, the key of their parent (none for roots), a date that is not before the parent's, and which dates are redrawn."""

    df: DataFrame
    key: str
    parent: str | None
    date: str
    free: Column


def redrawn_dates(levels: Sequence[Level], first: str, last: str, seed: int = 42) -> list[DataFrame]:
    """The levels' tables, roots first, in which free dates are drawn anew so that no row is before its parent or after its children.

    Bounds go up the tree first: the greatest date that a row may have is the least fixed date below it, by one aggregation for each level.
    Then dates go down: each free row is drawn between its parent's new date and its own greatest. Fixed dates and dates
    without a parent's bound stay within [first, last]; where fixed dates contradict each other a free one between them takes the
    parent's. Null dates that are fixed bound nothing; rows whose parent is missing are bounded by first. Rows that share a key are one parent.
    """
    limits: list[DataFrame | None] = []
    below = None
    for level in reversed(levels):
        limits.append(below)
        if level.parent:
            fixed = F.when(~level.free, F.col(level.date)).cast("date")
            own = level.df.select(F.col(level.key).alias("_key"), F.col(level.parent).alias("_up"), fixed.alias("_limit"))
            if below is not None:
                own = own.join(below.withColumnRenamed("_limit", "_below"), "_key", "left").withColumn("_limit", F.least("_limit", "_below"))
            below = own.groupBy(F.col("_up").alias("_key")).agg(F.min("_limit").alias("_limit"))
    out, above = [], None
    for i, (level, limit) in enumerate(zip(levels, reversed(limits), strict=True)):
        rows, low, high = level.df, F.lit(first).cast("date"), F.lit(last).cast("date")
        if limit is not None:
            rows, high = rows.join(limit.withColumnRenamed("_key", level.key), level.key, "left"), F.coalesce("_limit", high)
        if above is not None:
            rows, low = rows.join(above.withColumnRenamed("_key", level.parent), level.parent, "left"), F.coalesce("_above", low)
        span = F.greatest(F.lit(0), F.datediff(high, low))
        drawn = F.date_add(low, F.floor(synth.uniform(seed, f"redrawn:{i}:{level.date}", F.col(level.key)) * (span + 1)).cast("int"))
        rows = rows.withColumn(level.date, F.when(level.free, drawn.cast(level.df.schema[level.date].dataType)).otherwise(F.col(level.date)))
        out.append(rows.select(*level.df.columns))
        above = out[-1].groupBy(F.col(level.key).alias("_key")).agg(F.max(F.col(level.date).cast("date")).alias("_above"))
    return out
