"""Token counts by a map-side two-tier lookup.

The lengths of frequent words go to every worker in one compact table, made from
a bounded sample; it only saves time and never changes a count. Every other word is
encoded once by the worker that meets it and cached there. No word is ever shuffled.
"""

from __future__ import annotations

import functools
from array import array
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import SparkContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import PieceCounter, piece_counter
from .text import column_bytes, slices

#: Texts, about, from which the frequent words are taken; words in the table; words that one task reports.
SAMPLE_TEXTS, TABLE_WORDS, TASK_WORDS = 2_000, 30_000, 4_000
#: Longest word of the table, in characters; with TABLE_WORDS it bounds what is broadcast.
WORD_CHARS = 24


def _sample_words(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = piece_counter(model), Counter()
        for batch in batches:
            for text in batch.column("text").to_pylist():
                if counter.plain(text):
                    rows = counter.lines(text)
                    for words in [rows[0], *(r[1:] for r in rows[1:])]:
                        seen.update(words)
            if len(seen) > 400_000:
                seen = Counter(dict(seen.most_common(100_000)))
        top = [(w, n) for w, n in seen.most_common(TASK_WORDS) if len(w) <= WORD_CHARS]
        if top:
            words, counts = zip(*top, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts, pa.int64())], names=["word", "n"])

    return run


class FrequentLengths:
    """Words, joined by spaces, and their lengths in pieces."""

    def __init__(self, lengths: dict[str, int]):
        self.words, self.lengths = " ".join(lengths), array("H", lengths.values())

    @functools.cached_property
    def table(self) -> dict[str, int]:
        """Unpacked once in a process: a worker keeps a broadcast's value."""
        return dict(zip(self.words.split(" "), self.lengths, strict=True)) if self.lengths else {}


def frequent_lengths(docs: DataFrame, model: str, text_col: str) -> FrequentLengths:
    total = docs.count()
    if not total:
        return FrequentLengths({})
    text = docs.select(F.col(text_col).cast("string").alias("text")).where("text is not null")
    sample = text.sample(fraction=min(1.0, SAMPLE_TEXTS / total), seed=5)
    # added up by the executors; at most TABLE_WORDS words come to the driver
    seen = sample.mapInArrow(_sample_words(model), "word string, n long").where("word != ''").groupBy("word").agg(F.sum("n").alias("n"))
    words = [r.word for r in seen.orderBy(F.desc("n"), "word").limit(TABLE_WORDS).select("word").collect()]
    return FrequentLengths(dict(zip(words, PieceCounter(model)._spaced(words), strict=True)))


def token_counts(docs: DataFrame, model: str, *, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) per row of docs.

    n_tokens is what the sentencepiece model at `model` gives for the whole text,
    without begin or end tokens; model is a path that every executor has. A null or
    empty text has 0 bytes and 0 tokens. Repeated rows and null ids stay as they are;
    other columns are ignored; an empty table gives no rows.
    """
    context: SparkContext = docs.sparkSession.sparkContext
    frequent = context.broadcast(frequent_lengths(docs, model, text_col))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(model)
        counter.frequent = frequent.value.table
        for batch in batches:
            for part in slices(batch, "text"):
                _, off = column_bytes(part.column("text"))
                n = counter.count([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column("_id"), pa.array(off[1:] - off[:-1]), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=["_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"_id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("_id", id_col)
