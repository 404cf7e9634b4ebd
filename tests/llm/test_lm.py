"""The language model against plain Python, and its sequences against sorted arrays."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import lm
from millrace.llm.monotone import Monotone, Ranges


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 50), max_size=200), st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 60), max_size=40))
def test_monotone(values, wanted):
    values, wanted = np.sort(np.array(values, np.uint64)), np.array(wanted, np.uint64)
    m = Monotone(np.frombuffer(Monotone.pack(values), np.uint8))
    assert (m.get(np.arange(len(values))) == values).all()
    assert (m.first_of(wanted) == np.searchsorted(values, wanted)).all()


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 400), min_size=1, max_size=300, unique=True), st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 401), max_size=40))
def test_places_and_spans_of_a_sequence(values, wanted):
    values = np.sort(np.array(values, np.uint64))
    m, wanted = Monotone(np.frombuffer(Monotone.pack(values), np.uint8)), np.concatenate([values, np.array(wanted, np.uint64)])
    at = np.searchsorted(values, wanted)
    assert m.index(wanted).tolist() == [a if a < len(values) and values[a] == w else -1 for a, w in zip(at.tolist(), wanted, strict=True)]
    counts = np.cumsum(values >> np.uint64(14))
    counts = Monotone(np.frombuffer(Monotone.pack(np.sort(counts) >> np.uint64(2)), np.uint8))
    i = np.arange(len(counts) - 1)
    assert [x.tolist() for x in counts.spans(i)] == [counts.get(i).astype(np.int64).tolist(), counts.get(i + 1).astype(np.int64).tolist()]


def test_places_in_long_runs():
    values = np.concatenate([np.arange(5000), 10**9 + np.arange(5000), [2**50]]).astype(np.uint64)
    m = Monotone(np.frombuffer(Monotone.pack(values), np.uint8))
    assert (m.index(values) == np.arange(len(values))).all()
    assert (m.index(np.array([5000, 10**9 - 1, 10**9 + 5000, 2**50 - 1, 2**60], np.uint64)) == -1).all()


@pytest.mark.parametrize("keys", [[], [7], [5, 3, 5, 3, 9], [2**64 - 1, 0, 2**64 - 1], [2**63 + 1, 2**63, 2**63 + 1, 2**63 + 2, 2**63]])
def test_distinct_keys(keys):
    keys = np.array(keys, np.uint64)
    got, want = lm._distinct(keys), np.unique(keys, return_inverse=True)
    assert [x.tolist() for x in got] == [x.tolist() for x in want]


def test_contexts_in_and_out_of_order():
    for own in ([0, 0, 2, 5, 5], [4, 1, 4], []):
        assert [x.tolist() for x in lm._contexts(np.array(own, np.int64))] == [x.tolist() for x in np.unique(np.array(own, np.int64), return_inverse=True)]


def test_monotone_with_wide_gaps():
    values = np.concatenate([np.arange(5000), 10**9 + np.arange(5000) // 70, [2**50] * 300]).astype(np.uint64)
    m = Monotone(np.frombuffer(Monotone.pack(values), np.uint8))
    assert (m.get(np.arange(len(values))) == values).all()
    wanted = np.concatenate([values, values + np.uint64(1), [np.uint64(2**60)]])
    assert (m.first_of(wanted) == np.searchsorted(values, wanted)).all()


def test_ranges():
    rng = np.random.default_rng(2)
    lists = [np.sort(rng.choice(60, rng.integers(0, 9), replace=False)) for _ in range(200)]
    at = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
    r = Ranges(Monotone(np.frombuffer(Ranges.pack(np.concatenate(lists), at[:-1][np.diff(at) > 0]), np.uint8)))
    which, number = rng.integers(0, 200, 4000), rng.integers(0, 60, 4000)
    want = [at[w] + list(lists[w]).index(x) if x in lists[w] else -1 for w, x in zip(which, number, strict=True)]
    assert r.find(at[which], at[which + 1], number).tolist() == want


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


class Plain:
    """Interpolated absolute discounting by dictionaries."""

    def __init__(self, texts):
        self.one, grams = collections.Counter(), [collections.Counter(), collections.Counter()]
        for text in texts:
            w = words_of(text)
            self.one.update(w)
            s = ["<s>", *w]
            for n in (2, 3):
                grams[n - 2].update(tuple(s[i : i + n]) for i in range(len(s) - n + 1))
        self.n, self.v = sum(self.one.values()), len(self.one)
        self.levels = []
        for c in grams:
            ones, twos = (sum(x == k for x in c.values()) for k in (1, 2))
            total, kinds = collections.Counter(), collections.Counter()
            for gram, times in c.items():
                total[gram[:-1]] += times
                kinds[gram[:-1]] += 1
            self.levels.append((c, (ones + 0.5) / (ones + 2 * twos + 1), total, kinds))

    def p(self, gram):
        if len(gram) == 1:
            return (self.one[gram[0]] + 0.5) / (self.n + 0.5 * (self.v + 1))
        c, d, total, kinds = self.levels[len(gram) - 2]
        below, context = self.p(gram[1:]), gram[:-1]
        if not total[context]:
            return below
        return max(c[gram] - d, 0) / total[context] + d * kinds[context] / total[context] * below

    def score(self, text):
        s = ["<s>", *words_of(text)]
        return sum(math.log10(self.p(tuple(s[max(0, i - 2) : i + 1]))) for i in range(1, len(s)))

    def base(self, text):
        return sum(math.log10(self.p((w,))) for w in words_of(text))


@pytest.fixture(scope="module")
def texts():
    rng = np.random.default_rng(4)
    words = [f"W{i}é" if i % 3 else f"w{i}" for i in range(60)]
    out = []
    for _ in range(250):
        # words that depend on the one before
        w = [int(rng.integers(60))]
        for _ in range(rng.integers(0, 40)):
            w.append(int(rng.integers(60)) if rng.random() < 0.3 else (w[-1] * 7 + int(rng.integers(3))) % 60)
        out.append(" ".join(words[i] for i in w))
    return out + out[:30] + ["", None, " \n\t", "new words only", "the " * 9000, "one", "x" * 70000]


def frame(spark, texts):
    return spark.createDataFrame([(i if i % 50 else None if i == 50 else i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, k0 string").repartition(4)


@pytest.fixture(scope="module")
def known(spark, texts):
    """The rows, which are held out, the model by dictionaries, and the texts by id."""
    rows = frame(spark, texts).collect()
    held = {r["doc_id"]: zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 5 == 1 for r in rows}
    return rows, held, Plain([r["text"] for r in rows if not held[r["doc_id"]]]), {r["doc_id"]: r["text"] for r in rows}


def test_scores(spark, texts, known):
    rows, *rest = known
    got = lm.held_out_scores(frame(spark, texts)).collect()
    assert len(got) == len(rows)
    for r in got:
        check(r.asDict(), *rest)
    left = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in left) > sum(r["base_score"] for r in left)


def check(r, held, plain, text):
    words = words_of(text[r["doc_id"]])
    assert r["held_out"] == held[r["doc_id"]] and r["n_tokens"] == len(words) and r["train_tokens"] == plain.n
    assert r["n_known"] == sum(plain.one[w] > 0 for w in words)
    assert math.isclose(r["base_score"], plain.base(text[r["doc_id"]]), rel_tol=1e-9)
    # each token is quantised, and where the model backs off, once a level
    assert abs(r["score"] - plain.score(text[r["doc_id"]])) <= 3 * len(words) / lm.STEPS


def test_many_small_files(known, monkeypatch, tmp_path):
    """The tasks' functions in this process, with files so small that nearly every context has its own."""
    rows, held, plain, text = known
    monkeypatch.setattr(lm, "FILE_TOKENS", 40)
    monkeypatch.setattr(lm, "SLICE", 3000)
    folder = f"file://{tmp_path}"
    batch = lambda own: pa.RecordBatch.from_arrays([pa.array([r["text"] for r in own], pa.string())], names=["_text"])
    trained = batch([r for r in rows if not held[r["doc_id"]]])
    counts = collections.Counter()
    for b in lm._count_words([trained]):
        for h, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            counts[h] += n
    model = lm.Model(hash_bits=3, tokens=sum(counts.values()), texts=counts[lm.END])

    def level(files):
        files = sorted(tuple(r.values()) for f in files for r in f.to_pylist())
        sums = lambda i: np.concatenate([[0], np.cumsum([f[i] for f in files])]).astype(np.int64)
        return lm.Level({f[0]: f[1] for f in files}, {f[0]: f[4] for f in files}, sums(2), sums(3), np.array([f[0] for f in files]))

    by = collections.defaultdict(list)
    for h, n in counts.items():
        by[(h % 2**64) >> 61].append((h, n))
    model.words = level([lm._build_words(folder)((pa.scalar(k),), pa.table({"hash": pa.array([h for h, _ in v], pa.int64()), "n": pa.array([n for _, n in v], pa.int64())})) for k, v in by.items()])
    for name, count, build in (("pairs", lm._count_pairs, lm._build_pairs), ("triples", lm._count_triples, lm._build_triples)):
        pieces = collections.defaultdict(list)
        for b in count(model)([trained]):
            for k, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                pieces[k].append(p)
        merged = pa.concat_tables([lm._merged((pa.scalar(k),), pa.table({"piece": pa.array(v, pa.binary())})) for k, v in pieces.items()])
        ones, twos = sum(merged["ones"].to_pylist()), sum(merged["twos"].to_pylist())
        setattr(model, name, level(build(model, (ones + 0.5) / (ones + 2 * twos + 1), folder)(merged.select(["file", "piece"]).combine_chunks().to_batches())))
    assert len(model.pairs.files) > 20 and len(model.triples.files) > 20
    found = lm.scored(model, lm._Slice(batch(rows).column(0)))
    for row, tokens, known, base, score in zip(rows, *found, strict=True):
        check({"doc_id": row["doc_id"], "held_out": held[row["doc_id"]], "n_tokens": tokens, "n_known": known, "train_tokens": model.tokens, "base_score": base, "score": score}, held, plain, text)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a b"), (None, None)], "doc_id long, text string")
    model = lm.train(docs.where("false"))
    got = lm.score(docs, model, keep=[F.col("doc_id")]).collect()
    assert sorted((r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in got) == [(1, 0, 0, 0.0, 0.0), (3, 0, 0, 0.0, 0.0)]
    assert not lm.held_out_scores(docs.where("false")).collect()


def test_probabilities_sum_to_one(texts):
    plain = Plain(texts)
    contexts = list(plain.levels[1][2])[:20]
    assert all(math.isclose(sum(plain.p((*c, w)) for w in [*plain.one, "unseen"]), 1) for c in contexts)
