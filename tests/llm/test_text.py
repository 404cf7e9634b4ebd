"""Words, hashes, boundaries and caches against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import pieces
from millrace.llm.components import connected
from millrace.llm.queries import vocabulary
from millrace.llm.scratch import Scratch
from millrace.llm.text import WORD, Words, column_bytes, slices, windows
from millrace.llm.token_files import EliasFano

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\tÉ Z.… ", max_size=60)), max_size=12)


@given(TEXTS)
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_pattern(texts):
    w = Words(pa.array(texts, pa.string()))
    raw = w.raw.tobytes()
    got = [raw[a:b].decode() for a, b in zip(w.starts, w.ends, strict=True)]
    want = [re.findall(WORD, t or "") for t in texts]
    assert got == [x for row in want for x in row] and w.counts().tolist() == list(map(len, want))


@given(st.lists(st.text(alphabet="ab", min_size=1, max_size=40), min_size=1, max_size=40))
@settings(max_examples=100, deadline=None)
def test_hashes_tell_words_apart(words):
    h = Words(pa.array([" ".join(words)])).hashes()
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert (a == b) == (h[i] == h[j])


def test_lower_case_is_ascii_only():
    h = Words(pa.array(["ABC abc É é"]), lower=True).hashes()
    assert h[0] == h[1] and h[2] != h[3]


def test_windows_stay_in_rows():
    w = Words(pa.array(["a b c", "d e", "", "f g h i"]))
    h, inside = windows(w.hashes(), w.first, 3)
    assert inside.tolist() == [True, False, False, False, False, True, True] and len(h) == 7


def test_slices_cover_all_rows_of_a_sliced_batch():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (5, 0, 50, 3, 3)])], names=["t"]).slice(1)
    parts = list(slices(batch, "t", 10))
    assert [p.num_rows for p in parts] == [1, 1, 2] and pa.Table.from_batches(parts).column(0).to_pylist() == batch.column(0).to_pylist()
    assert column_bytes(pa.array([None, "a"]))[1].tolist() == [0, 0, 1]


@given(st.lists(st.integers(0, 5000), max_size=700).map(sorted))
@settings(max_examples=80, deadline=None)
def test_elias_fano(values):
    e = EliasFano.unpack(EliasFano.of(np.array(values, np.int64)).pack())
    assert [e[i] for i in range(len(values))] == values
    assert e.range(0, len(values)).tolist() == values
    if len(values) > 3:
        assert e.range(2, len(values) - 1).tolist() == values[2:-1]
    with pytest.raises(IndexError):
        e[len(values)]


def test_elias_fano_is_small():
    bounds = np.cumsum(np.random.default_rng(1).integers(1, 1000, 20_000))
    assert len(EliasFano.of(bounds).pack()) * 8 / len(bounds) < 2.5 + np.log2(500)


ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "a\nb", "a\n\nb", "a \nb", "a\n b", "\n", "\na", "a\tb", "a\r\nb", "don't we'll. I'm,", "x y", "x　y", "“q” — r", "<|endoftext|>", "a <|endoftext|> b", "<s> </s> <unk>", "▁x ▁", "x▁y", "1,234.5!", "word. word, word; word: word! word?", "É. é,", "​z", "a\x00b", "%%% ### a.b.c", "..", ". ,", "'s 's.", "ﬁ ﬂ", "🙂 🙂.", "漢字。漢字"]
SPACED = st.text(alphabet=st.sampled_from("ab'sé.,!?19 \n\t 　▁🙂漢<|>"), max_size=40)


@pytest.fixture(scope="module")
def byte_encoder():
    return pieces.ByteEncoder(vocabulary("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def piece_counter():
    return pieces.PieceCounter(vocabulary("piece_bpe_32k.model"), {"a": 1, "word": 1})


def byte_ids(encoder, texts):
    flat, bounds = encoder.encode(pa.array(texts, pa.string()))
    ended, cut = encoder.encode(pa.array(texts, pa.string()), 2)
    assert (ended[cut[1:] - 1] == 2).all() and np.delete(ended, cut[1:] - 1).tolist() == flat.tolist()
    return [flat[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def test_byte_ids_of_odd_texts(byte_encoder):
    want = [x.ids for x in byte_encoder.library.encode_batch(ODD, add_special_tokens=False)]
    assert byte_ids(byte_encoder, ODD) == want == byte_ids(byte_encoder, ODD)


@given(st.lists(SPACED, min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_byte_ids_are_the_library_s(byte_encoder, texts):
    assert byte_ids(byte_encoder, texts) == [x.ids for x in byte_encoder.library.encode_batch(texts, add_special_tokens=False)]


def test_full_caches_start_anew(byte_encoder, monkeypatch):
    monkeypatch.setattr(pieces, "MOST_CACHED", 3)
    texts = ["one two three four. five", "six seven one two", "one. two, four."]
    assert byte_ids(byte_encoder, texts) == [x.ids for x in byte_encoder.library.encode_batch(texts, add_special_tokens=False)]


def test_piece_counts_of_odd_texts(piece_counter):
    assert piece_counter.separable
    assert piece_counter.count(ODD) == [len(piece_counter.library.encode(t)) for t in ODD]


@given(st.lists(SPACED, min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_piece_counts_are_the_library_s(piece_counter, texts):
    assert piece_counter.count(texts) == [len(piece_counter.library.encode(t)) for t in texts]


def test_components(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))] + [(i, i + 1) for i in range(1000, 1060)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()}
    loops = {a for a, b in edges if a == b}
    assert all(find(n) == r for n, r in got.items()) and set(parent) - set(got) <= loops
    assert connected(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0
