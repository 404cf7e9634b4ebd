"""Document quality by a linear-chain conditional random field over lines.

Every line with a word is good or bad, judged by its own features and those of
its neighbours; forward-backward gives each line's marginal, and the marginals weighted by
line length make the document's share of good text, which a logistic curve turns into
a score. Labels are of documents: all lines of a good one are good; in a bad
one, lines that look like those of good documents are relabelled, in a few rounds, before
the field is trained. The model is fitted on the driver from the line features
of a bounded number of labelled documents; scoring is one pass over all texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .text import Words, per_row, slices

#: Most labelled documents that the model is fitted on, those with the smallest hashes.
FIT_DOCS = 4_000
#: Rounds of relabelling, and gradient steps.
ROUNDS, STEPS = 3, 150
#: A document is predicted good from this score on.
GOOD = 0.7

_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>=@^~_\\{}[]", np.uint8))
_MARKS = np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8))
_STOPS = np.isin(np.arange(256), np.frombuffer(b".,;:", np.uint8))
FEATURES = 11


def line_features(col) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes) of each line with a word, and of each row its first line's number."""
    w = Words(col)
    raw, off = w.raw, w.off
    n = len(raw)
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    edge[1:] |= raw == 0x0A
    begin = np.flatnonzero(edge[:n])
    if not len(begin):
        return np.zeros((0, FEATURES), np.float32), np.zeros(0), np.zeros(len(off), np.int64)
    bounds = np.append(begin, n)
    words = np.searchsorted(w.starts, bounds)
    count = np.diff(words)
    keep = count > 0
    row = np.searchsorted(off, begin, "right") - 1
    first = np.searchsorted(row[keep], np.arange(len(off)))

    heads = ((raw & 0xC0) != 0x80) & w.solid
    chars = np.maximum(per_row(heads, bounds)[keep], 1).astype(np.float32)
    size = count[keep].astype(np.float32)
    share = lambda flags: per_row(flags, bounds)[keep] / chars
    h = w.hashes()
    same = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    length = w.ends - w.starts
    upper = ((raw - np.uint8(65)) < 26) | np.concatenate([[False], (raw[:-1] == 0xC3) & ((raw[1:] - np.uint8(0x80)) < 0x1F)])[:n]
    per_word = lambda flags: per_row(flags, words)[keep] / size
    ends = _SYMBOLS[raw[w.ends - 1]] | _MARKS[raw[w.ends - 1]]
    key = np.repeat(np.arange(len(begin)), count).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ h
    _, one = np.unique(key, return_index=True)
    fresh = np.zeros(len(h), bool)
    fresh[one] = True
    features = np.stack(
        [
            np.log1p(size),
            np.log(chars / size),
            np.sqrt(share(_SYMBOLS[raw])),
            np.sqrt(share(_MARKS[raw])),
            np.sqrt(share(upper)),
            np.sqrt(per_word(same)),
            per_word(fresh),
            per_word(length <= 3),
            np.sqrt(share(_STOPS[raw])),
            np.sqrt(per_word(ends)),
            np.sqrt(share((raw - np.uint8(48)) < 10)),
        ],
        axis=1,
    ).astype(np.float32)
    return features, np.diff(bounds)[keep].astype(np.float64), first


def with_neighbours(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Features of each line, of the one before and the one after (its own at an end), and a constant."""
    n = len(x)
    at = np.arange(n)
    before, after = np.maximum(at - 1, 0), np.minimum(at + 1, max(n - 1, 0))
    heads = first[:-1][first[1:] > first[:-1]]
    tails = first[1:][first[1:] > first[:-1]] - 1
    before[heads], after[tails] = heads, tails
    return np.concatenate([x, x[before], x[after], np.ones((n, 1), x.dtype)], axis=1)


def marginals(unary: np.ndarray, first: np.ndarray, trans: np.ndarray, pairs: bool = False):
    """Of each line the probability of being good; with pairs also the expected transitions.

    unary is the score of good over bad, trans[a, b] that of b after a. All rows
    advance together, longest first.
    """
    n, rows = len(unary), np.diff(first)
    order = np.argsort(-rows, kind="stable")
    starts, lengths = first[:-1][order], rows[order]
    u = np.stack([np.zeros(n), unary], axis=1)
    alpha, beta = np.zeros((n, 2)), np.zeros((n, 2))
    active = lambda t: int(np.searchsorted(-lengths, -t, "left"))  # noqa: E731  rows with more than t lines
    longest = int(lengths[0]) if len(lengths) else 0
    for t in range(longest):
        k = active(t)
        at = starts[:k] + t
        if t == 0:
            alpha[at] = u[at]
        else:
            alpha[at] = u[at] + np.logaddexp(alpha[at - 1, :1] + trans[0], alpha[at - 1, 1:] + trans[1])
    for t in range(longest - 2, -1, -1):
        at = starts[: active(t + 1)] + t
        ahead = u[at + 1] + beta[at + 1]
        beta[at] = np.logaddexp(ahead[:, :1] + trans[:, 0], ahead[:, 1:] + trans[:, 1])
    total = alpha + beta
    p = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -500, 500)))
    if not pairs:
        return p
    inner = np.ones(n, bool)
    inner[first[1:][rows > 0] - 1] = False
    at = np.flatnonzero(inner)
    z = np.logaddexp(total[at, 0], total[at, 1])
    joint = np.exp(alpha[at][:, :, None] + trans[None] + (u[at + 1] + beta[at + 1])[:, None, :] - z[:, None, None])
    return p, joint.sum(0), at


@dataclass
class LineCRF:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    trans: np.ndarray
    slope: float
    shift: float

    def quality(self, x: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Of each row its length-weighted share of good text; 0 for a row without lines."""
        f = with_neighbours((x - self.mean) / self.scale, first)
        p = marginals(f @ self.weights, first, self.trans)
        good, all_ = (np.concatenate([[0], np.cumsum(v)]) for v in (p * size, size))
        total = all_[first[1:]] - all_[first[:-1]]
        return np.where(total > 0, (good[first[1:]] - good[first[:-1]]) / np.maximum(total, 1e-9), 0)

    def score(self, quality: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * quality + self.shift, -50, 50)))


def _adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    w, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def fit(features: list[np.ndarray], sizes: list[np.ndarray], labels: np.ndarray) -> LineCRF:
    """The field for documents of these line features; without both labels a field that finds nothing bad."""
    known = [i for i in range(len(labels)) if len(features[i])]
    y = np.array([labels[i] for i in known], float)
    if not len(known) or y.min() == y.max():
        return LineCRF(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(3 * FEATURES + 1), np.zeros((2, 2)), 0.0, float(6 * (y.mean() if len(y) else 1) - 3))
    x = np.concatenate([features[i] for i in known]).astype(float)
    size = np.concatenate([sizes[i] for i in known])
    first = np.concatenate([[0], np.cumsum([len(features[i]) for i in known])])
    rows = np.diff(first)
    mean, scale = x.mean(0), x.std(0) + 1e-3
    f = with_neighbours((x - mean) / scale, first)
    own = np.concatenate([f[:, :FEATURES], np.ones((len(f), 1))], axis=1)
    doc = np.repeat(y, rows)
    target = doc.copy()
    # each document weighs the same, and both labels do
    balance = np.where(doc == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum()) / np.repeat(rows, rows)
    w = np.zeros(own.shape[1])
    for _ in range(ROUNDS):
        w = _adam(lambda v: own.T @ ((1 / (1 + np.exp(-np.clip(own @ v, -50, 50))) - target) * balance) + 1e-4 * v, w, STEPS, 0.1)  # noqa: B023
        p = own @ w
        # in a bad document a line that looks good is good, but its worst line stays bad
        worst = np.minimum.reduceat(p, first[:-1])
        target = np.where((doc == 0) & ((p <= 0) | (p == np.repeat(worst, rows))), 0.0, 1.0)
    size_w = 3 * FEATURES + 1

    def gradient(v: np.ndarray) -> np.ndarray:
        p, expected, at = marginals(f @ v[:size_w], first, v[size_w:].reshape(2, 2), pairs=True)
        seen = np.zeros((2, 2))
        np.add.at(seen, (target[at].astype(int), target[at + 1].astype(int)), 1)
        g = np.concatenate([f.T @ ((p - target) * balance), ((expected - seen) / max(len(at), 1)).ravel() * 0.1])
        return g + 1e-4 * v

    v = _adam(gradient, np.zeros(size_w + 4), STEPS, 0.1)
    model = LineCRF(mean, scale, v[:size_w], v[size_w:].reshape(2, 2), 1.0, 0.0)
    q = model.quality(x, size, first)
    # the curve from the share of good text to the probability of a good document
    c = np.stack([q, np.ones(len(q))], axis=1)
    even = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    model.slope, model.shift = (float(z) for z in _adam(lambda z: c.T @ ((1 / (1 + np.exp(-np.clip(c @ z, -50, 50))) - y) * even) + 1e-5 * z, np.array([1.0, 0.0]), 2000, 0.1))
    return model


def is_held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def _collect_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            x, size, first = line_features(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("label"), part.column("mark"), pa.array([x[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()), pa.array([size[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary())],
                names=["label", "mark", "features", "sizes"],
            )


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> LineCRF:
    """Fit on at most FIT_DOCS labelled documents that are not held out; a document with several labels has their majority."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg(F.avg(F.col(label_col).cast("double")).alias("label"))
    chosen = known.select("_id", F.when(F.col("label") >= 0.5, 1).otherwise(0).alias("label"), F.xxhash64("_id").alias("mark")).orderBy("mark", "_id").limit(FIT_DOCS)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
    # FIT_DOCS rows at most are broadcast
    joined = texts.join(F.broadcast(chosen), "_id").select("label", "mark", "text")
    # one job, whatever the number of partitions; FIT_DOCS documents' line features come to the driver
    found = joined.mapInArrow(_collect_features, "label int, mark long, features binary, sizes binary").toArrow()
    rows = sorted(zip(*(found.column(c).to_pylist() for c in ("mark", "label", "features", "sizes")), strict=True))
    return fit([np.frombuffer(r[2], np.float32).reshape(-1, FEATURES) for r in rows], [np.frombuffer(r[3], np.float64) for r in rows], np.array([r[1] for r in rows], int))


def score_quality(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", good: float = GOOD) -> DataFrame:
    """(id, held_out, score, predicted, good_share) per row of docs.

    held_out: crc32 of the id as text, modulo 4, is 2; such rows' labels are never read (a null id is
    not held out and never labelled). score is in [0, 1]; predicted is 1 from `good` on. A null or empty text
    has no good line and gets the score of that. Repeated rows get equal scores; other columns are
    ignored; an empty table gives no rows, and without labels of both kinds all texts score alike.
    """
    model = docs.sparkSession.sparkContext.broadcast(train(docs, labels, id_col=id_col, text_col=text_col, label_col=label_col))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = model.value
        for batch in batches:
            for part in slices(batch, "text"):
                share = crf.quality(*line_features(part.column("text")))
                score = crf.score(share)
                yield pa.RecordBatch.from_arrays([part.column("_id"), part.column("held_out"), pa.array(score), pa.array((score >= good).astype(np.int32)), pa.array(share)], names=["_id", "held_out", "score", "predicted", "good_share"])

    rows = docs.select(F.col(id_col).alias("_id"), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"_id {kind}, held_out boolean, score double, predicted int, good_share double").withColumnRenamed("_id", id_col)
