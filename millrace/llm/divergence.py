"""How far the sources of a language diverge in their words, from an inverted index of terms.

Every source gives every kept term a smoothed probability, so a pair of sources diverges a little even in terms
that neither has. A pair starts there, with V times the value of zero counts; then only what differs from it
is added:

* a term that one source of a pair has adds the same whatever the other source is, but for that one's
  baseline. These are summed by a source's distinct counts, not by its terms.
* a term that both have adds what is still missing. Postings (the sources of a term) are read in
  blocks; each block emits one sum for each pair that meets in it.

All values are whole numbers of billionths, and all arithmetic is exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch
from .text import Words, slices

#: Probabilities are whole numbers of 1 / SCALE.
SCALE = 1_000_000_000
#: Ranks of terms are found in so many parts of a group first.
SALT = 16
#: Pairs of postings that a task works on at a time.
BLOCK_PAIRS = 2_000_000
#: Tables with one row a group are broadcast up to so many rows (of two names and four numbers).
BROADCAST_GROUPS = 50_000

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a slice of rows: occurrences, and rows that have the term."""
    for batch in batches:
        for part in slices(batch, "text"):
            words = Words(part.column("text"), lower=True, fold=lambda raw: (raw + (((raw - np.uint8(65)) < 26).view(np.uint8) << 5), _LETTER[raw]))
            if not len(words.starts):
                continue
            # words lie end to end in the bytes that belong to words
            ends = np.concatenate([[0], np.cumsum(words.ends - words.starts)]).astype(np.int32)
            strings = pa.StringArray.from_buffers(len(words.starts), pa.py_buffer(ends), pa.py_buffer(words.bytes[words.solid].tobytes())).dictionary_encode()
            code, rows = strings.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.rows()
            group = pa.StructArray.from_arrays([part.column("lang"), part.column("source")], ["lang", "source"])
            names: dict[tuple, int] = {}
            of_row = np.array([names.setdefault((g["lang"], g["source"]), len(names)) for g in group.to_pylist()], np.int64)
            size = len(strings.dictionary)
            in_row, times = np.unique(rows * size + code, return_counts=True)
            key, at = np.unique(of_row[in_row // size] * size + in_row % size, return_inverse=True)
            n = np.bincount(at, times, len(key)).astype(np.int64)
            docs = np.bincount(at, minlength=len(key)).astype(np.int64)
            lang, source = (pa.array([g[i] for g in names], pa.string()).take(pa.array(key // size)) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([lang, source, strings.dictionary.take(pa.array(key % size)), pa.array(n), pa.array(docs)], names=["lang", "source", "term", "n", "docs"])


def _probability(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exact for any counts."""
    wide = "decimal(19,0)"
    return F.call_function("div", (n + 1).cast(wide) * F.lit(SCALE).cast("decimal(10,0)"), (total + terms).cast(wide)) + 1


def value(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q); probabilities differ by SCALE at most, so the square is below 2 ** 63."""
    return F.call_function("div", (p - q) * (p - q), q)


def _value(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, more): of all pairs of sources that share terms, what these terms add to the pair's value beside the terms of each alone."""
    for batch in batches:
        lists = batch.column("postings")
        ends = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        flat = lists.flatten()
        g, p, zero = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(3))
        # a posting meets all others of its term; postings are taken in runs with a bounded number of partners
        begin = np.repeat(np.cumsum(ends) - ends, ends)
        partners = np.repeat(ends, ends)
        upto = np.concatenate([[0], np.cumsum(partners)])
        at = 0
        while at < len(g):
            end = max(at + 1, int(np.searchsorted(upto, upto[at] + BLOCK_PAIRS, "right")) - 1)
            for first in range(0, int(partners[at]) if end == at + 1 else 1, BLOCK_PAIRS):
                many = np.minimum(partners[at:end] - first, BLOCK_PAIRS)
                x = np.repeat(np.arange(at, end), many)
                y = np.arange(len(x)) - np.repeat(np.cumsum(many) - many, many) + begin[x] + first
                x, y = x[x != y], y[x != y]
                more = _value(p[x], p[y]) - _value(p[x], zero[y]) - _value(zero[x], p[y]) + _value(zero[x], zero[y])
                order = np.lexsort((g[y], g[x]))
                a, b = g[x][order], g[y][order]
                new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, int)
                if len(new):
                    yield pa.RecordBatch.from_arrays([pa.array(a[new]), pa.array(b[new]), pa.array(np.add.reduceat(more[order], new))], names=["a", "b", "more"])
            at = end


def divergence(docs: DataFrame, *, least_docs: int = 3, ranks: int = 200, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): for each source of a language all others by divergence, and its most typical terms.

    A term is a run of ASCII letters and characters beyond ASCII; A-Z are lower-cased. A language keeps the terms
    that `least_docs` of its rows have. With n occurrences of a kept term in a source, N of all kept
    terms and V kept terms, p = 1 + floor(1e9 (n + 1) / (N + V)). Part `pair` gives every other source of the language, with
    the sum over kept terms of floor((p - q)^2 / q), q the other's p (0 where no term is kept). Part `term` gives the source's kept terms
    with p above the whole language's q, up to rank `ranks`. Ranks go by value, descending, and item, by code point.
    Null texts, languages and sources are empty ones; a source without terms has its pairs and no terms.
    Rows are counted as they are, whatever their ids. Other columns are ignored; an empty table gives no rows.
    """
    scratch = Scratch(docs.sparkSession, "divergence")
    rows = docs.select(*(F.coalesce(docs[c].cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    found = rows.mapInArrow(_terms, "lang string, source string, term string, n long, docs long")
    found = scratch.table(found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    names = scratch.table(rows.select("lang", "source").distinct(), "sources")

    # a term's postings: as many as its language has sources at most
    index = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("all"), F.collect_list(F.struct("source", "n")).alias("postings")).where(F.col("docs") >= least_docs)
    index = scratch.table(index.drop("docs"), "index")
    langs = index.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("lang_total"))
    posting = index.select("lang", "term", "all", F.explode("postings").alias("posting")).select("lang", "term", "all", "posting.source", "posting.n")
    totals = posting.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = names.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").withColumns({"total": F.coalesce("total", F.lit(0)), "terms": F.coalesce("terms", F.lit(0))})
    groups = groups.withColumn("zero", F.when(F.col("terms") > 0, _probability(F.lit(0).cast("long"), F.col("total"), F.col("terms"))))
    groups = scratch.table(groups.withColumn("id", F.monotonically_increasing_id()), "groups")
    few = F.broadcast if groups.count() <= BROADCAST_GROUPS else lambda df: df

    weighed = posting.join(few(groups), ["lang", "source"]).withColumn("p", _probability(F.col("n"), F.col("total"), F.col("terms")))

    own = weighed.withColumn("q", _probability(F.col("all"), F.col("lang_total"), F.col("terms"))).where("p > q").withColumn("value", value(F.col("p"), F.col("q")))
    best = [F.desc("value"), F.asc("term")]
    # the window's limit keeps the first rows of a part before they are shuffled
    parted = own.select("lang", "source", "term", "value", F.pmod(F.xxhash64("term"), F.lit(SALT)).alias("part"))
    parted = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source", "part").orderBy(*best))).where(F.col("rank") <= ranks)
    terms = parted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*best))).where(F.col("rank") <= ranks)
    terms = terms.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    # one row for each distinct count of a source, then for each of these and each other source
    counts = weighed.groupBy("id", "lang", "p", "zero").agg(F.count("*").alias("times"))
    other = groups.select("lang", F.col("id").alias("other"), F.col("zero").alias("other_zero"))
    alone = counts.join(few(other), "lang").where("id != other")
    exact = lambda x: (x * F.col("times")).cast("decimal(38,0)")
    base = value(F.col("zero"), F.col("other_zero"))
    of_one = alone.select(F.col("id").alias("a"), F.col("other").alias("b"), exact(value(F.col("p"), F.col("other_zero")) - base).alias("more"))
    back = value(F.col("other_zero"), F.col("zero"))
    of_other = alone.select(F.col("other").alias("a"), F.col("id").alias("b"), exact(value(F.col("other_zero"), F.col("p")) - back).alias("more"))
    met = weighed.groupBy("lang", "term").agg(F.collect_list(F.struct("id", "p", "zero")).alias("postings")).where(F.size("postings") > 1)
    of_both = met.select("postings").mapInArrow(_met, "a long, b long, more long")
    added = of_one.unionAll(of_other).unionAll(of_both.select("a", "b", F.col("more").cast("decimal(38,0)").alias("more"))).groupBy("a", "b").agg(F.sum("more").alias("more"))

    left = groups.select("lang", "source", "terms", "zero", F.col("id").alias("a"))
    right = groups.select("lang", F.col("source").alias("item"), F.col("zero").alias("other_zero"), F.col("id").alias("b"))
    pairs = left.join(few(right), "lang").where("a != b").join(added, ["a", "b"], "left")
    start = F.coalesce(F.col("terms") * value(F.col("zero"), F.col("other_zero")), F.lit(0))
    pairs = pairs.withColumn("value", (start + F.coalesce("more", F.lit(0).cast("decimal(38,0)"))).cast("long"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank")).unionAll(terms)


#: All pairs over all kept terms; kept apart from the index.
OP11_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN kept ON w.lang = kept.lang AND w.term = kept.term GROUP BY w.lang, w.source, w.term),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.n AS all_n FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
s AS (SELECT lang, source, sum(n) AS total FROM p GROUP BY lang, source),
x AS (SELECT p.lang, p.source, p.term, p.n, 1 + CAST(1000000000 AS HUGEINT) * (p.n + 1) // CAST(s.total + l.v AS HUGEINT) AS p, 1 + CAST(1000000000 AS HUGEINT) * (p.all_n + 1) // CAST(l.total + l.v AS HUGEINT) AS q FROM p JOIN s ON p.lang = s.lang AND p.source = s.source JOIN l ON p.lang = l.lang),
y AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(y.value, 0) AS BIGINT) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN y ON y.lang = a.lang AND y.source = a.source AND y.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM x WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM r WHERE part = 'pair' OR rank <= 200
"""
