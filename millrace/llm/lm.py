"""A trigram language model as an Elias-Fano trie in shared files, and the scores it gives to whole texts.

Three levels of files hold words, their successors, and the successors of pairs. A node's children are
one range of the next level, and monotone pointers tell where it begins. A word that follows a pair is not
stored by its number but by its rank among the successors of the pair's second word: small numbers, and the search for
the shorter context, which smoothing needs anyway, gives the rank to look for in the longer one. Probabilities
are interpolated with absolute discounting, its discounts from the counts of counts, and quantised; pointers, counts and numbers are Elias-Fano
sequences. Files are memory-mapped, so a task holds only what it touches.

Each level is counted by slices of text, combined, shuffled as packed arrays by the file that they belong to, and
written by one task a file. A file has a bounded number of occurrences of its contexts, found from
cumulative counts of the level above; where one context is more frequent, its distinct successors are what meets in a task.
"""

from __future__ import annotations

import struct
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .files import file_system, written
from .monotone import Monotone, Ranges
from .scratch import Scratch
from .text import Words, slices

#: Bytes of text that a task works on at a time.
SLICE = 6 << 20
#: Occurrences of contexts in a file, about; and words in a file of words.
FILE_TOKENS, FILE_WORDS = 2_000_000, 4_000_000
#: The end of a text, in place of a word's hash.
END = 0
#: Steps of a quantised log10 for each unit; 16 bits reach to 1e-16.
STEPS = 4096
#: Files that a worker holds open, and bytes of those that cannot be mapped.
OPEN_FILES, OPEN_BYTES = 1024, 256 << 20


# files ---------------------------------------------------------------------


def _write(uri: str, sections: list[bytes]) -> None:
    with written(uri) as out:
        out.write(struct.pack(f"<Q{len(sections)}Q", len(sections), *map(len, sections)))
        for data in sections:
            out.write(data)
            out.write(bytes(-len(data) % 8))


_open: OrderedDict[str, tuple[int, list[np.ndarray]]] = OrderedDict()


def _sections(uri: str) -> list[np.ndarray]:
    """The parts of a file; mapped where it lies in a folder of this machine or a mounted one, else read."""
    if uri in _open:
        _open.move_to_end(uri)
        return _open[uri][1]
    fs, path = file_system(uri)
    if isinstance(fs, pafs.LocalFileSystem):
        data, held = np.memmap(path, np.uint8, "r"), 0
    else:
        with fs.open_input_file(path) as f:
            data = np.frombuffer(f.read(), np.uint8)
        held = len(data)
    data = data.view(np.ndarray)
    (many,) = struct.unpack("<Q", data[:8].tobytes())
    sizes, at, parts = struct.unpack(f"<{many}Q", data[8 : 8 + 8 * many].tobytes()), 8 + 8 * many, []
    for size in sizes:
        parts.append(data[at : at + size])
        at += size + -size % 8
    _open[uri] = (held, parts)
    while len(_open) > 1 and (len(_open) > OPEN_FILES or sum(h for h, _ in _open.values()) > OPEN_BYTES):
        _open.popitem(last=False)
    return parts


def _narrow(x: np.ndarray) -> np.ndarray:
    top = int(x.max()) if len(x) else 0
    return x.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)


def packed(major: np.ndarray, minor: np.ndarray, counts: np.ndarray) -> bytes:
    """Three arrays of equal length, major ascending, compressed."""
    parts = [_narrow(x) for x in (np.diff(major, prepend=major[:1]), minor, counts)]
    body = b"".join(p.tobytes() for p in parts)
    head = struct.pack("<QQ3BQ", len(major), int(major[0]) if len(major) else 0, *(p.itemsize for p in parts), len(body))
    return head + pa.compress(body, codec="zstd", asbytes=True)


def unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, base, a, b, c, size = struct.unpack_from("<QQ3BQ", data)
    body = pa.decompress(data[struct.calcsize("<QQ3BQ") :], size, "zstd")
    at, out = 0, []
    for width in (a, b, c):
        out.append(np.frombuffer(body, f"<u{width}", n, at).astype(np.int64))
        at += n * width
    return np.cumsum(out[0]) + base, out[1], out[2]


def _quantised(p: np.ndarray) -> bytes:
    return np.clip(np.rint(-np.log10(p) * STEPS), 0, 65535).astype("<u2").tobytes()


def _log(codes: np.ndarray) -> np.ndarray:
    return codes.astype(np.float64) / -STEPS


# the model -----------------------------------------------------------------


@dataclass
class Level:
    """A level's files, a number or two for each; offsets count nodes and occurrences before a file."""

    paths: dict[int, str] = field(default_factory=dict)
    least: dict[int, int] = field(default_factory=dict)
    nodes: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    totals: np.ndarray = field(default_factory=lambda: np.zeros(1, np.int64))
    files: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))


def _by_file(files: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Which entries belong to each file."""
    if not len(files):
        return
    if (files[1:] >= files[:-1]).all():
        order = np.arange(len(files))
    else:
        # numbers of 16 bits are sorted by their digits
        order = np.argsort(files.astype(np.uint16) if 0 <= files.min() and files.max() < 1 << 16 else files, kind="stable")
    cuts = np.flatnonzero(np.diff(files[order])) + 1
    for rows in np.split(order, cuts):
        yield int(files[rows[0]]), rows


def _contexts(own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers, ascending, and of each entry which one it is; entries in order, as those of a slice are, are not sorted."""
    new = np.diff(own, prepend=-1)
    if (new < 0).any():
        return np.unique(own, return_inverse=True)
    return own[new > 0], np.cumsum(new > 0) - 1


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and of each entry which one it is: a sort of one number that holds a key's leading bits and its place."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    bits = np.uint64(len(keys).bit_length())
    over = np.uint64(max(0, int(keys.max()).bit_length() + int(bits) - 64))
    both = (keys.astype(np.uint64) >> over << bits) | np.arange(len(keys), dtype=np.uint64)
    both.sort()
    place = (both & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    ordered = keys[place]
    if over and (ordered[1:] < ordered[:-1]).any():
        return np.unique(keys, return_inverse=True)
    new = np.append(True, ordered[1:] != ordered[:-1])
    which = np.empty(len(keys), np.int64)
    which[place] = np.cumsum(new) - 1
    return ordered[new], which


@dataclass
class Model:
    """What tasks need to know of the files. Words are numbered in the order of their hashes; the start of a text is the number after the last."""

    hash_bits: int = 0
    tokens: int = 0
    texts: int = 0
    words: Level = field(default_factory=Level)
    pairs: Level = field(default_factory=Level)
    triples: Level = field(default_factory=Level)

    @property
    def vocabulary(self) -> int:
        return int(self.words.nodes[-1])

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        """Probabilities of words by their counts; one count stands for all words that are not known."""
        return (counts + 0.5) / (self.tokens + 0.5 * (self.vocabulary + 1))

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number, count, occurrences of words before it) of each hash; -1, 0, 0 for words that are not known."""
        number, count, before = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64), np.zeros(len(hashes), np.int64)
        file = (hashes >> np.uint64(64 - self.hash_bits)).astype(np.int64) if self.hash_bits else np.zeros(len(hashes), np.int64)
        for f, rows in _by_file(file):
            if f not in self.words.paths:
                continue
            keys, counts = map(Monotone, _sections(self.words.paths[f]))
            at = keys.index(hashes[rows])
            rows, at = rows[at >= 0], at[at >= 0]
            k = int(np.searchsorted(self.words.files, f))
            begin, end = counts.spans(at)
            number[rows], count[rows], before[rows] = at + self.words.nodes[k], end - begin, begin + self.words.totals[k]
        return number, count, before

    def counted(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(count, occurrences of words before it) of numbers of words, or the start."""
        count, before = np.full(len(numbers), self.texts, np.int64), np.full(len(numbers), self.tokens, np.int64)
        file = np.searchsorted(self.words.nodes, numbers, "right") - 1
        for k, rows in _by_file(np.where(numbers < self.vocabulary, file, len(self.words.files))):
            if k == len(self.words.files):
                continue
            counts = Monotone(_sections(self.words.paths[int(self.words.files[k])])[1])
            at = numbers[rows] - self.words.nodes[k]
            begin, end = counts.spans(at)
            count[rows], before[rows] = end - begin, begin + self.words.totals[k]
        return count, before

    def follow(self, first: np.ndarray, before: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of pairs of numbers: node (-1 if not known), occurrences before it, rank among the first's successors, log10 of the probability, and of what the first's unknown successors share."""
        n = len(first)
        node, total, rank, p, rest = np.full(n, -1, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)
        known = np.flatnonzero(first >= 0)
        for f, rows in _by_file(before[known] // FILE_TOKENS):
            rows = known[rows]
            if f not in self.pairs.paths:
                continue
            k = int(np.searchsorted(self.pairs.files, f))
            pointers, words, counts, codes, shares = _sections(self.pairs.paths[f])
            pointers, words, counts, codes, shares = Monotone(pointers), Ranges(Monotone(words)), Monotone(counts), codes.view("<u2"), shares.view("<u2")
            own = first[rows] - self.pairs.least[f]
            rows, own = rows[(own >= 0) & (own < len(shares))], own[(own >= 0) & (own < len(shares))]
            contexts, at = _contexts(own)
            begin, end = pointers.spans(contexts)
            rest[rows] = np.where(begin < end, _log(shares[contexts]), 0.0)[at]
            base, begin, end = words.base(begin)[at], begin[at], end[at]
            place = words.find(begin, np.where(second[rows] >= 0, end, begin), np.maximum(second[rows], 0), base)
            hit = np.flatnonzero(place >= 0)
            at = place[hit]
            node[rows[hit]], rank[rows[hit]], p[rows[hit]] = at + self.pairs.nodes[k], at - begin[hit], _log(codes[at])
            total[rows[hit]] = counts.get(at).astype(np.int64) + self.pairs.totals[k]
        return node, total, rank, p, rest

    def extend(self, node: np.ndarray, total: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of nodes of pairs and ranks among the second word's successors (-1: none): whether it is known, log10 of its probability, and of what others share."""
        n = len(node)
        known, p, rest = np.zeros(n, bool), np.zeros(n), np.zeros(n)
        some = np.flatnonzero(node >= 0)
        for f, rows in _by_file(total[some] // FILE_TOKENS):
            rows = some[rows]
            if f not in self.triples.paths:
                continue
            pointers, ranks, codes, shares = _sections(self.triples.paths[f])
            pointers, ranks, codes, shares = Monotone(pointers), Ranges(Monotone(ranks)), codes.view("<u2"), shares.view("<u2")
            own = node[rows] - self.triples.least[f]
            rows, own = rows[(own >= 0) & (own < len(shares))], own[(own >= 0) & (own < len(shares))]
            contexts, at = _contexts(own)
            begin, end = pointers.spans(contexts)
            rest[rows] = np.where(begin < end, _log(shares[contexts]), 0.0)[at]
            base, begin, end = ranks.base(begin)[at], begin[at], end[at]
            place = ranks.find(begin, np.where(rank[rows] >= 0, end, begin), np.maximum(rank[rows], 0), base)
            hit = np.flatnonzero(place >= 0)
            known[rows[hit]], p[rows[hit]] = True, _log(codes[place[hit]])
        return known, p, rest

    def successor(self, node: np.ndarray, parent: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """log10 of the probability of the successor of a node's second word that has the rank; parent: of each rank which node it belongs to."""
        second = np.zeros(len(node), np.int64)
        for k, rows in _by_file(np.searchsorted(self.pairs.nodes, node, "right") - 1):
            pointers, words, *_ = _sections(self.pairs.paths[int(self.pairs.files[k])])
            pointers, words = Monotone(pointers), Ranges(Monotone(words))
            at = node[rows] - self.pairs.nodes[k]
            begin = pointers.get(pointers.first_of(at + 1) - 1).astype(np.int64)
            second[rows] = words.get(begin, at)
        seconds, which = _distinct(second)
        _, before = self.counted(seconds)
        file, begin, out = before // FILE_TOKENS, np.zeros(len(seconds), np.int64), np.zeros(len(rank))
        for f, rows in _by_file(file):
            begin[rows] = Monotone(_sections(self.pairs.paths[f])[0]).get(seconds[rows] - self.pairs.least[f]).astype(np.int64)
        place = begin[which][parent] + rank
        for f, rows in _by_file(file[which][parent]):
            out[rows] = _log(_sections(self.pairs.paths[f])[3].view("<u2")[place[rows]])
        return out


# counting ------------------------------------------------------------------


class _Slice:
    """The tokens of a slice of rows: each row's words, then its end."""

    def __init__(self, texts):
        words = Words(texts, lower=True)
        many = words.counts()
        self.rows = len(many)
        self.lengths = many + 1
        self.ends = np.cumsum(self.lengths) - 1
        hashes = np.full(int(self.lengths.sum()), END, np.uint64)
        inside = np.ones(len(hashes), bool)
        inside[self.ends] = False
        hashes[inside] = words.hashes()
        self.hashes, self.word = _distinct(hashes)

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (first, second) by places in self.hashes, len(self.hashes) for the start, and of each token the pair that ends with it."""
        first = np.empty_like(self.word)
        first[1:] = self.word[:-1]
        first[self.ends - self.lengths + 1] = len(self.hashes)
        keys, of_token = _distinct(first * len(self.hashes) + self.word)
        return keys // max(1, len(self.hashes)), keys % max(1, len(self.hashes)), of_token

    def inner(self) -> np.ndarray:
        """Tokens with two words before them, the start included."""
        out = np.ones(len(self.word), bool)
        out[self.ends - self.lengths + 1] = False
        return np.flatnonzero(out)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "_text", SLICE):
            own = _Slice(part.column("_text"))
            yield pa.RecordBatch.from_arrays([pa.array(own.hashes.view(np.int64)), pa.array(np.bincount(own.word, minlength=len(own.hashes)).astype(np.int64))], names=["hash", "n"])


def _pieces(file: np.ndarray, major: np.ndarray, minor: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    cuts = np.flatnonzero(np.diff(file, prepend=-1))
    ends = np.append(cuts[1:], len(file))
    return pa.RecordBatch.from_arrays([pa.array(file[cuts]), pa.array([packed(major[a:b], minor[a:b], counts[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary())], names=["file", "piece"])


def _numbered(model: Model, own: _Slice) -> tuple[np.ndarray, ...]:
    """Numbers, counts and occurrences before, of a slice's distinct words, and last of the start."""
    number, count, before = model.look_up(own.hashes)
    return np.append(number, model.vocabulary), count, np.append(before, model.tokens)


def _count_pairs(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                own = _Slice(part.column("_text"))
                number, _, before = _numbered(model, own)
                first, second, of_token = own.pairs()
                yield _pieces(before[first] // FILE_TOKENS, number[first], number[second], np.bincount(of_token, minlength=len(first)))

    return run


def _count_triples(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                own = _Slice(part.column("_text"))
                number, _, before = _numbered(model, own)
                first, second, of_token = own.pairs()
                node, total, rank, _, _ = model.follow(number[first], before[first], number[second])
                inner = own.inner()
                if len(inner):
                    keys, counts = np.unique(of_token[inner - 1] * len(first) + of_token[inner], return_counts=True)
                    x, y = keys // len(first), keys % len(first)
                    # the order of pairs is that of their nodes, since words are numbered in the order of their hashes
                    yield _pieces(total[x] // FILE_TOKENS, node[x], rank[y], counts)

    return run


_MERGED = "file long, total long, ones long, twos long, piece binary"


def _merged(key: tuple, table: pa.Table) -> pa.Table:
    """All pieces of a file as one, with its counts of counts."""
    major, minor, counts = (np.concatenate(x) for x in zip(*(unpacked(p.as_buffer().to_pybytes()) for p in table.column("piece")), strict=True))
    # one key of both is sorted several times faster, where 63 bits hold it
    wide, least = int(minor.max()) + 1, int(major.min())
    order = np.argsort((major - least) * wide + minor) if (int(major.max()) - least + 1) * wide < 1 << 63 else np.lexsort((minor, major))
    major, minor, counts = major[order], minor[order], counts[order]
    new = np.flatnonzero((np.diff(major, prepend=-1) != 0) | (np.diff(minor, prepend=-1) != 0))
    counts = np.add.reduceat(counts, new)
    return pa.table({"file": pa.array([key[0].as_py()], pa.int64()), "total": pa.array([int(counts.sum())]), "ones": pa.array([int((counts == 1).sum())]), "twos": pa.array([int((counts == 2).sum())]), "piece": pa.array([packed(major[new], minor[new], counts)], pa.binary())})


# building ------------------------------------------------------------------

_FILE = "file long, path string, nodes long, total long, least long"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=["file", "path", "nodes", "total", "least"])


def _new_file(folder: str, file: int) -> str:
    import uuid

    return f"{folder}/{file:08d}-{uuid.uuid4().hex}"


def _build_words(folder: str):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        hashes, counts = table.column("hash").to_numpy().view(np.uint64), table.column("n").to_numpy()
        order = np.argsort(hashes)
        path = _new_file(folder, key[0].as_py())
        _write(path, [Monotone.pack(hashes[order]), Monotone.pack(np.concatenate([[0], np.cumsum(counts[order])]))])
        return pa.Table.from_batches([_rows([(key[0].as_py(), path, len(hashes), int(counts.sum()), 0)])])

    return run


def _children(major: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each distinct parent's children begin, and of each child which parent, counted from 0, it has."""
    begins = np.flatnonzero(np.diff(major, prepend=-1))
    return begins, np.repeat(np.arange(len(begins)), np.diff(np.append(begins, len(major))))


def _pointers(major: np.ndarray) -> bytes:
    """Where the children of each number from the least to the greatest parent begin, and where the last ones end."""
    return Monotone.pack(np.searchsorted(major, np.arange(major[0], major[-1] + 2)))


def _share(major: np.ndarray, begins: np.ndarray, shares: np.ndarray) -> bytes:
    out = np.ones(int(major[-1] - major[0]) + 1)
    out[major[begins] - major[0]] = shares
    return _quantised(out)


def _build_pairs(model: Model, discount: float, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, piece in zip(batch.column("file").to_pylist(), batch.column("piece"), strict=True):
                first, second, counts = unpacked(piece.as_buffer().to_pybytes())
                begins, parent = _children(first)
                total, kinds = np.add.reduceat(counts, begins), np.bincount(parent)
                shares = discount * kinds / total
                words, at = np.unique(second, return_inverse=True)
                p = (counts - discount) / total[parent] + shares[parent] * model.unigram(model.counted(words)[0])[at]
                path = _new_file(folder, file)
                _write(path, [_pointers(first), Ranges.pack(second, begins), Monotone.pack(np.concatenate([[0], np.cumsum(counts)])), _quantised(p), _share(first, begins, shares)])
                yield _rows([(file, path, len(first), int(counts.sum()), int(first[0]))])

    return run


def _build_triples(model: Model, discount: float, folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, piece in zip(batch.column("file").to_pylist(), batch.column("piece"), strict=True):
                node, rank, counts = unpacked(piece.as_buffer().to_pybytes())
                begins, parent = _children(node)
                total, kinds = np.add.reduceat(counts, begins), np.bincount(parent)
                shares = discount * kinds / total
                p = (counts - discount) / total[parent] + shares[parent] * 10 ** model.successor(node[begins], parent, rank)
                path = _new_file(folder, file)
                _write(path, [_pointers(node), Ranges.pack(rank, begins), _quantised(p), _share(node, begins, shares)])
                yield _rows([(file, path, len(node), int(counts.sum()), int(node[0]))])

    return run


def _level(files: DataFrame, scratch: Scratch, name: str) -> Level:
    """Runs the tasks that write a level; a row of numbers for each file comes to the driver."""
    rows = sorted(scratch.table(files, name).collect())
    sums = lambda i: np.concatenate([[0], np.cumsum([r[i] for r in rows], dtype=np.int64)]).astype(np.int64)
    return Level({r["file"]: r["path"] for r in rows}, {r["file"]: r["least"] for r in rows}, sums(2), sums(3), np.array([r["file"] for r in rows], np.int64))


def _discount(merged: DataFrame) -> float:
    """What is taken off every count, by the numbers of n-grams seen once and twice."""
    ones, twos = merged.agg(F.coalesce(F.sum("ones"), F.lit(0)), F.coalesce(F.sum("twos"), F.lit(0))).first()
    return (ones + 0.5) / (ones + 2 * twos + 1)


def train(docs: DataFrame, *, text_col: str = "text") -> Model:
    """A model of all rows of docs; its files stay in the session's shared folder.

    Words are runs of characters other than space and \\x09-\\x0D, A-Z lower-cased, compared by 64-bit hashes; each text's words are
    followed by an end. Null texts are empty ones and have an end. An empty table gives a model that knows no word.
    """
    scratch = Scratch(docs.sparkSession, "lm")
    texts = docs.select(docs[text_col].cast("string").alias("_text"))
    words = scratch.table(texts.mapInArrow(_count_words, "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n")), "counts")
    many, tokens, ends = words.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum(F.when(F.col("hash") == END, F.col("n"))), F.lit(0))).first()
    model = Model(hash_bits=max(0, (many // FILE_WORDS).bit_length()), tokens=tokens, texts=ends)
    by_hash = words.withColumn("file", F.shiftrightunsigned("hash", 64 - model.hash_bits).cast("long") if model.hash_bits else F.lit(0).cast("long"))
    model.words = _level(by_hash.groupBy("file").applyInArrow(_build_words(scratch.path("words")), _FILE), scratch, "word-files")

    for name, count, build in (("pairs", _count_pairs, _build_pairs), ("triples", _count_triples, _build_triples)):
        pieces = texts.mapInArrow(count(model), "file long, piece binary")
        merged = scratch.table(pieces.groupBy("file").applyInArrow(_merged, _MERGED), f"{name}-counts")
        files = merged.select("file", "piece").mapInArrow(build(model, _discount(merged), scratch.path(name)), _FILE)
        setattr(model, name, _level(files, scratch, f"{name}-files"))
        scratch.drop(merged)
    return model


def scored(model: Model, own: _Slice) -> tuple[np.ndarray, ...]:
    """(tokens, known ones, log10 by words alone, log10 by the model) of each row of a slice."""
    number, count, before = _numbered(model, own)
    row = np.repeat(np.arange(own.rows), own.lengths)
    alone = np.log10(model.unigram(count))
    first, second, of_token = own.pairs()
    node, total, rank, p, rest = model.follow(number[first], before[first], number[second])
    p = np.where(node >= 0, p, rest + alone[second])
    score = p[of_token]
    inner = own.inner()
    if len(inner):
        keys, at = _distinct(of_token[inner - 1] * len(first) + of_token[inner])
        x, y = keys // len(first), keys % len(first)
        known, longer, rest = model.extend(node[x], total[x], np.where(node[y] >= 0, rank[y], -1))
        score[inner] = np.where(known, longer, rest + p[y])[at]
    sums = lambda x: np.bincount(row, x, own.rows)
    return own.lengths, sums(count[own.word] > 0).astype(np.int64), sums(alone[own.word]), sums(score)


def score(docs: DataFrame, model: Model, *, keep: list[Column], text_col: str = "text") -> DataFrame:
    """keep, and n_tokens, n_known, train_tokens, base_score, score per row of docs.

    base_score is the log10 of the text's probability by the counts of its words alone, score by the model, the end included in both. An
    empty or null text has its end only. Words that the model does not know share the count of none.
    """
    names = [f"k{i}" for i in range(len(keep))]
    rows = docs.select(*(c.alias(n) for c, n in zip(keep, names, strict=True)), docs[text_col].cast("string").alias("_text"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                tokens, known, base, own = scored(model, _Slice(part.column("_text")))
                trained = np.full(part.num_rows, model.tokens, np.int64)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *map(pa.array, (tokens, known, trained, base, own))], names=[*names, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    out = rows.mapInArrow(run, f"{kinds}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
    labels = docs.select(*keep).columns
    return out.toDF(*labels, "n_tokens", "n_known", "train_tokens", "base_score", "score")


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Scores of all documents by a model of those whose crc32 of the decimal id does not leave 1 by 5; a null id counts as an empty one."""
    held = F.pmod(F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1
    return score(docs, train(docs.where(~held)), keep=[docs["doc_id"], held.alias("held_out")])
