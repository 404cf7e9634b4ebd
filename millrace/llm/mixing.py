"""Mixing sources to target weights by a time-varying curriculum.

Targets: weights share a demand; no target passes `most` times its source's size,
and what is over is shared again. Within a source, documents lie on one line of
cumulative words, in the order of a hash of their id. A document is taken as often as
the target reaches it. A schedule gives each source's relative weight over time, as a line through
knots. Its integral says how much of the source's target is met at a time; the inverse of that is
the time of every copy. The sum of the integrals of all sources, each times its target, is the cumulative
demand for words, and what it is at the copy's time, as a part of the whole, is the copy's
training position: so many words come before it. The result is range-sorted by position; the ranges are drawn from
keys and positions alone, so that texts are joined once.

Cumulative sums are taken in two steps, over buckets of the hash and within each
bucket, so that no source is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import Words, slices

#: Rows of one source in a bucket of the hash, about.
BUCKET_ROWS = 20_000
#: Text of a task that sorts a part of the run, about.
PART_BYTES = 16 << 20
Knots = tuple[tuple[float, float], ...]
#: Relative weights over time, by the place of a source's weight in the list of weights: the first sources fade, the second stay, the third grow.
SCHEDULE: tuple[Knots, ...] = (((0, 1.5), (1, 0.5)), ((0, 1), (1, 1)), ((0, 0.5), (1, 1.5)))


def _sizes(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text"):
                columns = [part.column(c) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(Words(part.column("_text")).counts())], names=[*keep, "size"])

    return run


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """(source, source_size, target, place, shares) of sizes (source, size); one row for each source.

    shares are the parts of all targets that sources of each place have, 0 if no source has a word.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    src = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    place = (F.row_number().over(by_name) - 1) % len(weights)
    src = src.withColumn("place", place).withColumn("w", F.element_at(F.array(*map(F.lit, weights)), F.col("place") + 1)).withColumn("cap", most * F.col("source_size"))
    by_room = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    upto = by_room.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = by_room.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    demand = F.sum("source_size").over(everything) * share[0] / share[1]
    src = src.withColumn("level", (demand - (F.sum("cap").over(upto) - F.col("cap"))) / (F.sum("w").over(everything) - (F.sum("w").over(upto) - F.col("w"))))
    # sources are full from the one with the least room for its weight; the first that isn't sets the level of the rest
    open_ = F.col("level") <= F.col("cap") / F.col("w")
    level = F.first(F.when(open_, F.col("level")), ignorenulls=True).over(everything)
    fills = F.max(open_.cast("int")).over(upto) == 1
    src = src.withColumn("target", F.when(fills, level * F.col("w")).otherwise(F.col("cap").cast("double")))
    of = lambda p: F.coalesce(F.try_divide(F.sum(F.when(F.col("place") == p, F.col("target"))).over(everything), F.sum("target").over(everything)), F.lit(0.0))
    return src.select("source", "source_size", "target", "place", F.array(*map(of, range(len(weights)))).alias("shares"))


def _segments(knots: Knots) -> list[tuple[float, float, float, float, float]]:
    """(time, weight, slope, what is met by then, what is met at its end) of each part of a schedule; all of it is 1."""
    if len(knots) < 2 or knots[0][0] != 0 or knots[-1][0] != 1 or any(a[0] >= b[0] for a, b in zip(knots, knots[1:], strict=False)) or min(w for _, w in knots) < 0:
        raise ValueError(f"{knots}: knots go from time 0 to 1 with weights of 0 or more")
    total = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(knots, knots[1:], strict=False))
    if not total:
        raise ValueError(f"{knots}: no weight at any time")
    out, met = [], 0.0
    for (t, w), (u, v) in zip(knots, knots[1:], strict=False):
        end = met + (u - t) * (w + v) / 2 / total
        out.append((float(t), w / total, (v - w) / (u - t) / total, met, end))
        met = end
    return out


def _pieces(x: Column, ends: list[float], values: list[Column]) -> Column:
    """Of each part's value that of the first part that reaches x."""
    out = values[-1]
    for end, value in reversed(list(zip(ends[:-1], values[:-1], strict=True))):
        out = F.when(x <= end, value).otherwise(out)
    return out


def met_by(t: Column, knots: Knots) -> Column:
    """The part of a source's target that its schedule meets by a time."""
    parts = _segments(knots)
    ends = [*(p[0] for p in parts[1:]), 1.0]
    return _pieces(t, ends, [met + (t - begin) * (w + slope * (t - begin) / 2) for begin, w, slope, met, _ in parts])


def when_met(q: Column, knots: Knots) -> Column:
    """The time by which a part q of a source's target is met, the inverse of met_by."""
    values = []
    for begin, w, slope, met, _ in (parts := _segments(knots)):
        rest = q - met
        values.append(F.when(rest <= 0, F.lit(begin)).otherwise(begin + 2 * rest / (w + F.sqrt(F.greatest(F.lit(0.0), w * w + 2 * slope * rest)))))
    return F.least(F.lit(1.0), _pieces(q, [p[-1] for p in parts], values))


def _lined(docs: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int, whole: bool, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(_id, _hash, size, source_size, target, place, shares, start, rounds, taken) per row; start is its place on the source's line of words."""
    scratch = Scratch(docs.sparkSession, "mixing")
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(F.col(text_col)).alias("_hash"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("_text"))
    sized = rows.mapInArrow(_sizes(["_id", "_hash", "source"]), f"_id {kind}, _hash long, source string, size long")
    sized = scratch.table(sized.withColumn("hash", F.md5(F.coalesce(F.col("_id").cast("string"), F.lit("")))), "sizes")
    targets = scratch.table(source_targets(sized, weights, share, most), "targets")

    digits, n = 1, sized.count()
    while 16**digits * BUCKET_ROWS < n:
        digits += 1
    placed = sized.withColumn("bucket", F.substring("hash", 1, digits))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    sums = placed.groupBy("source", "bucket").agg(F.sum("size").alias("in_bucket"))
    before = F.sum("in_bucket").over(Window.partitionBy("source").orderBy("bucket")) - F.col("in_bucket")
    starts = sums.withColumn("bucket_start", before)
    starts = starts.join(targets, same(starts, targets)).select(starts["source"], "bucket", "bucket_start", "source_size", "target", "place", "shares")
    within = Window.partitionBy("source", "bucket").orderBy("hash", F.col("_id").asc_nulls_first(), "size", "_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lined = placed.withColumn("upto", F.sum("size").over(within))
    lined = lined.join(starts, same(lined, starts) & (lined["bucket"] == starts["bucket"])).select("_id", "_hash", "size", "source_size", "target", "place", "shares", (F.col("bucket_start") + F.col("upto") - F.col("size")).alias("start"))
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    lined = lined.withColumn("rounds", rounds.cast("long")).withColumn("rest", F.col("target") - F.col("rounds") * F.col("source_size"))
    if whole:
        extra = F.when(F.col("start") + F.col("size") / 2 <= F.col("rest"), F.col("size")).otherwise(0)
    else:
        extra = F.greatest(F.lit(0), F.least(F.col("size"), F.floor(F.col("rest") + 0.5).cast("long") - F.col("start")))
    taken = (F.col("rounds") * F.col("size") + extra).cast("long")
    return lined.withColumn("taken", taken)


def _position(round_: Column, schedule: tuple[Knots, ...]) -> Column:
    """Where in the run the middle of a document's copy in a round is, in words."""
    begin = round_ * F.col("source_size") + F.col("start")
    part = F.least(F.col("size"), F.col("taken") - round_ * F.col("size"))
    met = F.least(F.lit(1.0), (begin + part / 2) / F.col("target"))
    time = F.lit(None).cast("double")
    for place, knots in enumerate(schedule):
        time = F.when(F.col("place") == place, when_met(met, knots)).otherwise(time)
    demand = [F.col("shares")[place] * met_by(time, knots) for place, knots in enumerate(schedule)]
    return F.round(sum(demand[1:], demand[0]), 9)


def _scheduled(weights: tuple[int, ...], schedule: tuple[Knots, ...]) -> tuple[Knots, ...]:
    """A schedule for each weight; a shorter one is repeated."""
    return tuple(schedule[i % len(schedule)] for i in range(len(weights)))


def mix_sources(docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), schedule: tuple[Knots, ...] = SCHEDULE, share: tuple[int, int] = (3, 2), most: int = 2, whole: bool = False, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(id, size, source_size, target, taken, position) per row of docs, sorted by position.

    size is the number of words; taken how many words the mix takes, repeats counted, at most
    `most` x size. The one document of a source where its target ends is taken
    in part; with whole=True it is taken once more or not, whichever comes
    nearer. position is the first copy's place in the run: the part of all words that come before its middle, null where nothing is
    taken. Sources go by code point, null last and a source of its own; weights repeat over them,
    and of schedule, knots (time, relative weight) from time 0 to 1, there is one for each weight.
    Null or empty texts have size 0 and are never taken; a null id is hashed as
    an empty string; of repeated ids the smaller text comes first. Other columns are
    ignored. An empty table gives no rows.
    """
    out = _lined(docs, weights, share, most, whole, id_col, text_col, source_col)
    position = F.when(F.col("taken") > 0, _position(F.lit(0), _scheduled(weights, schedule)))
    return out.select(F.col("_id").alias(id_col), "size", "source_size", "target", "taken", position.alias("position")).repartitionByRange("position", id_col).sortWithinPartitions("position", id_col)


def curriculum(docs: DataFrame, *, weights: tuple[int, ...] = (5, 2, 1), schedule: tuple[Knots, ...] = SCHEDULE, share: tuple[int, int] = (3, 2), most: int = 2, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of docs as the mix takes them: each as often as it is taken, whole, sorted by training position.

    Takes what mix_sources takes. Rows that are never taken, and with them null and empty
    texts, are left out; null ids are ids like others. Rows that share their id and their text are all taken as
    often as the one that is taken most. The columns are those of docs, whatever their names.
    """
    taken = _lined(docs, weights, share, most, True, id_col, text_col, source_col).where("taken > 0")
    rounds = F.explode(F.sequence(F.lit(0), (F.col("taken") / F.col("size") - 1).cast("int"))).alias("round")
    copies = taken.select("*", rounds).select(F.col("_id").alias("a"), F.col("_hash").alias("b"), "round", _position(F.col("round"), _scheduled(weights, schedule)).alias("at"))
    copies = copies.groupBy("a", "b", "round").agg(F.min("at").alias("at"))
    text = docs.agg(F.sum(F.octet_length(docs[text_col].cast("string")))).first()[0] or 0
    ranges = copies.repartitionByRange(max(1, -(-text * share[0] // (share[1] * PART_BYTES))), "at", "a", "b")
    placed = Scratch(docs.sparkSession, "curriculum").table(ranges.withColumn("part", F.spark_partition_id()), "copies")
    parts = (placed.agg(F.max("part")).first()[0] or 0) + 1
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[id_col].alias("id"), F.xxhash64(docs[text_col]).alias("hash"))
    joined = rows.join(placed, rows["id"].eqNullSafe(placed["a"]) & (rows["hash"] == placed["b"]))
    return joined.select("row", "id", "hash", "at", "part").repartitionById(parts, "part").sortWithinPartitions("at", "id", "hash").select("row.*")


#: The default schedule's lines are written out: of its integral, and of the inverse.
OP9_SQL = r"""
WITH s AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS place FROM s GROUP BY source),
w AS (SELECT *, CASE place WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w, 2 * source_size AS cap FROM src),
o AS (SELECT *, CAST(cap AS DOUBLE) / w AS room, row_number() OVER (ORDER BY CAST(cap AS DOUBLE) / w, source ASC NULLS LAST) AS k, sum(source_size) OVER () AS total, sum(w) OVER () AS all_w,
  sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / w, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING) - cap AS capped, sum(w) OVER (ORDER BY CAST(cap AS DOUBLE) / w, source ASC NULLS LAST ROWS UNBOUNDED PRECEDING) - w AS w_before FROM w),
l AS (SELECT *, (CAST(total AS DOUBLE) * 3 / 2 - CAST(capped AS DOUBLE)) / CAST(all_w - w_before AS DOUBLE) AS level FROM o),
f AS (SELECT min_by(level, k) AS level, min(k) AS k FROM l WHERE level <= room),
g AS (SELECT source, source_size, place, CASE WHEN l.k >= f.k THEN f.level * w ELSE CAST(cap AS DOUBLE) END AS target FROM l, f),
t AS (SELECT *, coalesce(sum(target) FILTER (place = 0) OVER () / sum(target) OVER (), 0) AS a, coalesce(sum(target) FILTER (place = 1) OVER () / sum(target) OVER (), 0) AS b, coalesce(sum(target) FILTER (place = 2) OVER () / sum(target) OVER (), 0) AS c FROM g),
d AS (SELECT s.doc_id, s.size, t.source_size, t.target, t.place, t.a, t.b, t.c, CAST(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id ASC NULLS FIRST, s.size ROWS UNBOUNDED PRECEDING) - s.size AS BIGINT) AS start FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
r AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS rounds FROM d),
x AS (SELECT *, rounds * size + greatest(0, least(size, CAST(floor(target - rounds * source_size + 0.5) AS BIGINT) - start)) AS taken FROM r),
q AS (SELECT *, least(1.0, (start + CAST(least(size, taken) AS DOUBLE) / 2) / target) AS met FROM x),
m AS (SELECT *, least(1.0, CASE place WHEN 0 THEN 2 * met / (1.5 + sqrt(2.25 - 2 * met)) WHEN 1 THEN met ELSE 2 * met / (0.5 + sqrt(0.25 + 2 * met)) END) AS time FROM q)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN round(a * (time * (1.5 - time / 2)) + b * time + c * (time * (0.5 + time / 2)), 9) END AS position FROM m
"""
