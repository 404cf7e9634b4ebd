"""Quality rules: robust multivariate outliers.

A fixed base rule rejects short and repetitive texts. The other texts are judged
by a vector of six transformed statistics against a minimum-covariance-determinant
(MCD) estimate of their language and source: concentration steps from a
median / MAD start, each one aggregation over all documents, until the determinants stop
falling, then a cut-off on the squared Mahalanobis distance. Each estimate is drawn towards that of its language
as if PRIOR_TEXTS of the language's texts belonged to it, so that a few texts don't judge themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import Words, column_bytes, mix, per_row, slices, windows

P = 6
#: Part of a group that a concentration step keeps; most such steps; the fall of a determinant's logarithm that is worth another.
SUPPORT, STEPS, FALL = 0.75, 12, 0.02
#: Texts of its language that each group is given, and words of its language that its pooled ratios are given.
PRIOR_TEXTS, PRIOR_RATIO_WORDS = 50, 5_000
#: Tables with one row a group are broadcast up to so many rows (of 28 numbers); larger ones are joined by a shuffle.
BROADCAST_GROUPS = 20_000
#: Words of the group's pooled ratio that are added to each text's own counts.
PRIOR_WORDS = 40
#: Least standard deviation of each transformed statistic.
FLOOR = (0.06, 0.05, 0.08, 0.08, 0.25, 0.08)
#: Texts beyond this chi-squared probability (six degrees of freedom) are rejected.
CUTOFF = 0.975
#: Bins of a transformed statistic per unit, and of the squared distance per octave.
BINS, OCTAVE = 400, 64

_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_pieces", "n_lines")
_SYMBOLS, _MARKS = (np.isin(np.arange(256), np.frombuffer(x, np.uint8)) for x in (b"#*$%&|<>", b"!?\"'()[]{}=@^~_\\/+-:;`"))


def _dup_lines(raw: bytes) -> tuple[int, int]:
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines)), len(lines)


def text_counts(col) -> np.ndarray:
    """The counts of each row, in the order of _COUNTS."""
    w = Words(col)
    raw, off = w.raw, w.off
    heads = ((raw & 0xC0) != 0x80) & w.solid
    n = w.counts()
    h = w.hashes()
    five, inside = windows(h, w.first, 5)
    row = w.rows()
    covered = np.zeros(len(h) + 1, np.int32)
    if len(five):
        at = np.flatnonzero(inside)
        key = mix(five[at] + row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        np.add.at(covered, at[twice], 1)
        np.add.at(covered, at[twice] + 5, -1)
    repeat = np.cumsum(covered[:-1]) > 0
    key = mix(h + row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, first = np.unique(key, return_index=True)
    distinct = np.zeros(len(h), bool)
    distinct[first] = True
    text = raw.tobytes()
    lines = np.array([_dup_lines(text[off[i] : off[i + 1]]) for i in range(len(off) - 1)], np.int64).reshape(-1, 2)
    upper = ((raw - np.uint8(65)) < 26) | np.concatenate([[False], (raw[:-1] == 0xC3) & ((raw[1:] - np.uint8(0x80)) < 0x1F)])[: len(raw)]
    return np.stack([n, per_row(heads, off), per_row(_SYMBOLS[raw], off), lines[:, 0], per_row(repeat, w.first), per_row(upper, off), per_row(_MARKS[raw], off), per_row(distinct, w.first), lines[:, 1]], axis=1)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            got = text_counts(part.column("text"))
            keep = [part.column(i) for i in range(part.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*keep, *(pa.array(got[:, k]) for k in range(len(_COUNTS)))], names=[*part.schema.names[:-1], *_COUNTS])


def _chi2(x: float, k: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))


def chi2_quantile(q: float, k: int = P) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if _chi2(mid, k) < q else (lo, mid)
    return lo


def _vector() -> list[Column]:
    """Six statistics, smoothed by the group's pooled ratios r_*."""
    c, a = F.col, float(PRIOR_WORDS)
    smooth = lambda k, n, r: (c(k) + a * c(r)) / (c(n) + a)
    root = lambda x: F.asin(F.sqrt(F.least(F.lit(1.0), x)))
    return [
        F.log((c("word_chars") + a * c("r_chars")) / (c("n_words") + a)),
        root((c("n_symbols") + a * c("r_symbols")) / (c("word_chars") + a * c("r_chars"))),
        root((c("n_upper") + a * c("r_upper")) / (c("word_chars") + a * c("r_chars"))),
        root((c("n_marks") + a * c("r_marks")) / (c("word_chars") + a * c("r_chars"))),
        root(smooth("n_repeat_words", "n_words", "r_repeat")),
        F.log(F.greatest(c("n_pieces") + 1, F.lit(2))) / F.log(c("n_words") + 2),
    ]


def _quantile_bins(bins: DataFrame, part: float, keys: list[str]) -> DataFrame:
    """Of counts per (keys, bin), the first bin with at least that part of its key's rows up to it."""
    from pyspark.sql import Window

    up = Window.partitionBy(*keys).orderBy("bin")
    return bins.withColumn("up", F.sum("count").over(up)).withColumn("all", F.sum("count").over(Window.partitionBy(*keys))).where(F.col("up") >= part * F.col("all")).groupBy(*keys).agg(F.min("bin").alias("bin"))


_PAIRS = [(i, j) for i in range(P) for j in range(i, P)]
_MEANS, _CELLS = [f"m{i}" for i in range(P)], [f"i{i}{j}" for i, j in _PAIRS]
_SOLVED = "key string, " + ", ".join(f"{p} double" for p in _MEANS + _CELLS) + ", volume double"


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Moments of groups and their languages to (key, m_*, i_*, volume): mean, inverse covariance, and the logarithm of its determinant."""
    at = chi2_quantile(SUPPORT)
    factor = SUPPORT / _chi2(at, P + 2)
    for batch in batches:
        get = lambda names: np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names], axis=1).astype(float)  # noqa: E731, B023
        n, in_lang = get(["n"]), np.maximum(get(["l_n"]), 1)
        mean = (get([f"s{i}" for i in range(P)]) + PRIOR_TEXTS * get([f"l_s{i}" for i in range(P)]) / in_lang) / (n + PRIOR_TEXTS)
        cells = factor * (get([f"c{i}{j}" for i, j in _PAIRS]) + PRIOR_TEXTS * get([f"l_c{i}{j}" for i, j in _PAIRS]) / in_lang) / (n + PRIOR_TEXTS)
        cov = np.zeros((len(n), P, P))
        for k, (i, j) in enumerate(_PAIRS):
            cov[:, i, j] = cov[:, j, i] = np.maximum(cells[:, k], 0) + FLOOR[i] ** 2 if i == j else cells[:, k]
        inverse = np.linalg.inv(cov)
        values = [*mean.T, *(inverse[:, i, j] for i, j in _PAIRS), np.linalg.slogdet(cov)[1]]
        yield pa.RecordBatch.from_arrays([batch.column("key"), *(pa.array(v) for v in values)], names=["key", *_MEANS, *_CELLS, "volume"])


def _distance() -> Column:
    d = [F.col(f"x{i}") - F.col(f"m{i}") for i in range(P)]
    total = F.lit(0.0)
    for i, j in _PAIRS:
        total = total + d[i] * d[j] * F.col(f"i{i}{j}") * (1.0 if i == j else 2.0)
    return F.greatest(total, F.lit(0.0))


def _few(table: DataFrame) -> DataFrame:
    """A written table with a row for each group: to be broadcast if it is short enough."""
    return F.broadcast(table) if table.count() <= BROADCAST_GROUPS else table


def mcd(points: DataFrame, scratch: Scratch) -> DataFrame:
    """MCD estimates (key, m_*, i_*, volume) of points (lang, key, x0 .. x5), by aggregations only."""
    bins = points.select("key", F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), F.floor(F.col(f"x{i}") * BINS).alias("bin")) for i in range(P)))).alias("v")).select("key", "v.*").groupBy("key", "dim", "bin").agg(F.count("*").alias("count"))
    bins = scratch.table(bins, "bins")
    middle = _quantile_bins(bins, 0.5, ["key", "dim"]).select("key", "dim", ((F.col("bin") + 0.5) / BINS).alias("median"))
    away = bins.join(middle, ["key", "dim"]).select("key", "dim", F.abs(F.col("bin") - F.floor(F.col("median") * BINS)).alias("bin"), "count").groupBy("key", "dim", "bin").agg(F.sum("count").alias("count"))
    spread = _quantile_bins(away, 0.5, ["key", "dim"]).select("key", "dim", ((F.col("bin") + 0.5) / BINS * 1.4826).alias("mad"))
    start = middle.join(spread, ["key", "dim"]).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("dim", "median", "mad"))).alias("v"))
    pick = lambda i, f: F.col("v")[i][f]
    cells = (((1 / (pick(i, "mad") * pick(i, "mad") + FLOOR[i] ** 2)) if i == j else F.lit(0.0)).alias(f"i{i}{j}") for i, j in _PAIRS)
    estimate = scratch.table(start.select("key", *(pick(i, "median").alias(f"m{i}") for i in range(P)), *cells, F.lit(float("inf")).alias("volume")), "start")
    x = [F.col(f"x{i}") for i in range(P)]
    for _ in range(STEPS):
        near = points.join(_few(estimate), "key").select("lang", "key", *x, F.floor(F.log2(_distance() + 1e-6) * OCTAVE).alias("bin"))
        cut = scratch.table(_quantile_bins(near.groupBy("key", "bin").agg(F.count("*").alias("count")), SUPPORT, ["key"]).withColumnRenamed("bin", "cut"), "cut")
        sums = near.join(_few(cut), "key").where("bin <= cut").groupBy("lang", "key").agg(F.count("*").alias("n"), *(F.sum(x[i]).alias(f"s{i}") for i in range(P)), *(F.sum(x[i] * x[j]).alias(f"p{i}{j}") for i, j in _PAIRS))
        own = scratch.table(sums.select("lang", "key", "n", *(f"s{i}" for i in range(P)), *((F.col(f"p{i}{j}") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("n")).alias(f"c{i}{j}") for i, j in _PAIRS)), "moments")
        in_lang = own.groupBy("lang").agg(*(F.sum(c).alias(f"l_{c}") for c in own.columns[2:]))
        new = scratch.table(own.join(in_lang, "lang").drop("lang").mapInArrow(_solve, _SOLVED), "estimate")
        fall = new.join(estimate.select("key", F.col("volume").alias("before")), "key").agg(F.max(F.col("before") - F.col("volume"))).first()[0]
        estimate = new
        if fall is None or fall <= FALL:
            break
    return estimate


def quality_rules(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source", cutoff: float = CUTOFF) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance) per row of docs.

    base_failed: fewer than 10 words, or over 20 % of the words in repeated five-word
    windows. Others are kept unless their squared distance exceeds the cut-off.
    Null text is empty (base_failed); a null language or source is a value of its own;
    repeated rows count as often as they occur; texts that fail the base rule take no part in the
    estimates (distance null). Estimates of small groups are mostly their language's. Other columns are
    ignored. An empty table gives no rows.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "rules")
    text = docs.select(F.col(id_col).alias("_id"), F.to_json(F.struct(F.col(lang_col).alias("l"))).alias("lang"), F.to_json(F.struct(F.col(lang_col).alias("l"), F.col(source_col).alias("s"))).alias("own"), F.col(text_col).cast("string").alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    counted = text.mapInArrow(_count, f"_id {kind}, lang string, own string, " + ", ".join(f"{c} long" for c in _COUNTS))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    counted = scratch.table(counted.withColumn("base_failed", failed), "counts")

    fine = counted.where("not base_failed")
    groups = scratch.table(fine.groupBy("lang", "own").agg(*(F.sum(c).alias(c) for c in _COUNTS)), "groups")
    of = (("word_chars", "r_chars"), ("n_symbols", "r_symbols"), ("n_upper", "r_upper"), ("n_marks", "r_marks"), ("n_repeat_words", "r_repeat"))
    in_lang = groups.groupBy("lang").agg(F.sum("n_words").alias("l_words"), *(F.sum(k).alias(f"l_{k}") for k, _ in of))
    ratios = ((F.col(k) + PRIOR_RATIO_WORDS * F.col(f"l_{k}") / F.col("l_words")) / (F.col("n_words") + PRIOR_RATIO_WORDS) for k, _ in of)
    pooled = _few(scratch.table(groups.join(in_lang, "lang").select("own", *(r.alias(name) for r, (_, name) in zip(ratios, of, strict=True))), "pooled"))

    vector = [v.alias(f"x{i}") for i, v in enumerate(_vector())]
    points = scratch.table(fine.join(pooled, "own").select("lang", F.col("own").alias("key"), *vector), "points")
    estimates = _few(mcd(points, scratch))
    judged = counted.join(pooled, "own", "left").withColumns({f"x{i}": v for i, v in enumerate(_vector())}).join(estimates.withColumnRenamed("key", "own"), "own", "left")
    distance = F.when(~F.col("base_failed"), _distance())
    return judged.select(F.col("_id").alias(id_col), *_COUNTS[:5], "base_failed", (~F.col("base_failed") & F.coalesce(distance <= chi2_quantile(cutoff), F.lit(True))).alias("kept"), distance.alias("distance"))
