"""Public tokenizers with caches of whole pre-tokens; results are those of the libraries.

Both kinds of vocabulary never join anything across a single space or a line end,
so a text of plainly spaced words is the sum of its words. Every text that is
spaced in another way goes to the library as a whole.
"""

from __future__ import annotations

import functools
import os

import numpy as np

from .text import Words

#: Cached pre-tokens of a worker; beyond that a cache starts anew.
MOST_CACHED = 800_000
#: Marks that stand alone after a letter or digit; first bytes of letters of two bytes (Latin but for two signs, and Cyrillic).
MARKS = ".,;:!?"
_MARK = np.isin(np.arange(256), np.frombuffer(MARKS.encode(), np.uint8))
_ALNUM = np.isin(np.arange(256), [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)])
_LEADS = np.isin(np.arange(256), [0xC3, 0xC4, 0xC5, 0xD0, 0xD1])


def _cached(cache: dict, wanted: set, encode) -> None:
    missing = [w for w in wanted if w not in cache]
    if not missing:
        return
    if len(cache) + len(missing) > MOST_CACHED:
        cache.clear()
        missing = list(wanted)
    for i in range(0, len(missing), 20_000):
        cache.update(zip(missing[i : i + 20_000], encode(missing[i : i + 20_000]), strict=True))


@functools.lru_cache(2)
def byte_encoder(path: str) -> ByteEncoder:
    """One per worker process, so that its cache outlives a task."""
    return ByteEncoder(path)


class ByteEncoder:
    """Ids of texts by a byte-level BPE of the tokenizers library.

    Words are looked up by a 63-bit hash and a bit that says whether a space stands before them, a
    whole slice of texts at a time; a cached word is a part of one long array of ids. A mark
    behind a letter or digit at a word's end is a pre-token of its own and is taken apart.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size()
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        #: The ids of a line end and of each mark; the ids of ASCII characters are looked up by their bytes.
        self.single = np.zeros(128, np.uint32)
        for c in "\n" + MARKS:
            (self.single[ord(c)],) = self._encode([c])[0]
        self.line_id = self.single[10]
        self._forget()

    def _forget(self) -> None:
        #: Sorted hashes of words, where each word's ids begin in the pool, and how many there are.
        self.keys, self.begin, self.length = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _append(self, ids: np.ndarray) -> int:
        at, self.used = self.used, self.used + len(ids)
        if self.used > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(ids)), np.uint32)])
        self.pool[at : self.used] = ids
        return at

    def _learn(self, keys: np.ndarray, words: list[str]) -> None:
        """Cache words by their keys, which are odd after a space. They are encoded as lines of one text, and lines stay apart."""
        begin, length = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        spaced = (keys & np.uint64(1)) == 1
        for some, lead in ((np.flatnonzero(spaced), " "), (np.flatnonzero(~spaced), "")):
            for i in range(0, len(some), 20_000):
                part = some[i : i + 20_000]
                ids = np.array(self._encode(["\n" + lead + f"\n{lead}".join([words[k] for k in part.tolist()])])[0], np.uint32)
                cuts = np.append(np.flatnonzero(ids == self.line_id), len(ids))
                begin[part] = self._append(ids) + cuts[:-1] + 1
                length[part] = np.diff(cuts) - 1
        at = np.searchsorted(self.keys, keys)
        self.keys, self.begin, self.length = (np.insert(old, at, new) for old, new in ((self.keys, keys), (self.begin, begin), (self.length, length)))

    def _places(self, keys: np.ndarray, word) -> np.ndarray:
        """Places of sorted distinct keys in the cache; word(i) is the word of the i-th."""
        at = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == keys[inside]
        if known.all():
            return at
        if len(self.keys) + int((~known).sum()) > MOST_CACHED:
            self._forget()
            known[:] = False
        new = np.flatnonzero(~known)
        self._learn(keys[new], [word(i) for i in new.tolist()])
        return np.searchsorted(self.keys, keys)

    def encode(self, col, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all rows of a string column, one after another and each with the end id behind it, and the rows' bounds."""
        w = Words(col)
        raw, off, rows = w.raw, w.off, len(w.off) - 1
        plain = self._plain(raw, off)
        data = raw.tobytes()
        for s in self.special:
            at = data.find(s)
            while at >= 0:
                plain[np.searchsorted(off, at, "right") - 1] = False
                at = data.find(s, at + 1)
        rest = [r for r in np.flatnonzero(~plain).tolist() if off[r + 1] > off[r]]
        whole = self._encode([data[off[r] : off[r + 1]].decode() for r in rest])

        mine = np.repeat(plain, w.counts())
        last = raw[w.ends - 1]
        marked = mine & _MARK[last] & (w.ends - w.starts > 1)
        # the byte before the mark: an ASCII letter or digit, or the end of a letter of two bytes
        one, two = raw[np.maximum(w.ends - 2, 0)], raw[np.maximum(w.ends - 3, 0)]
        marked &= _ALNUM[one] | (_LEADS[two] & (one >= 0x80) & ((two != 0xC3) | ((one != 0x97) & (one != 0xB7))) & (w.ends - w.starts > 2))
        w.ends = w.ends - marked
        starts, ends = w.starts[mine], w.ends[mine]
        heads = np.zeros(len(raw) + 1, bool)
        heads[off] = True
        lined = ~heads[starts] & (raw[starts - 1] == 0x0A) if len(starts) else np.zeros(0, bool)
        spaced = ~heads[starts] & ~lined
        keys, place = np.unique((w.hashes()[mine] & ~np.uint64(1)) | spaced, return_inverse=True)
        sample = np.zeros(len(keys), np.int64)
        sample[place] = np.arange(len(place))
        entry = self._places(keys, lambda i: data[starts[sample[i]] : ends[sample[i]]].decode())[place] if len(keys) else place

        # the ids of a word, with a line end before and a mark behind it where these belong to it
        marked, last = marked[mine], last[mine]
        length = self.length[entry]
        total = np.concatenate([[0], np.cumsum(length + lined + marked)])
        flat = np.zeros(int(total[-1]), np.uint32)
        flat[total[:-1][lined]] = self.line_id
        flat[total[1:][marked] - 1] = self.single[last[marked]]
        inner = np.ones(len(flat), bool)
        inner[total[:-1][lined]] = False
        inner[total[1:][marked] - 1] = False
        before = np.cumsum(length) - length
        flat[inner] = self.pool[np.repeat(self.begin[entry] - before, length) + np.arange(int(length.sum()))]
        first = np.concatenate([[0], np.cumsum(np.where(plain, w.counts(), 0))])
        size = total[first[1:]] - total[first[:-1]]
        size[rest] = [len(x) for x in whole]
        bounds = np.concatenate([[0], np.cumsum(size + (end_id is not None))])
        out, cached = np.zeros(int(bounds[-1]), np.uint32), np.ones(int(bounds[-1]), bool)
        if end_id is not None:
            out[bounds[1:] - 1] = end_id
            cached[bounds[1:] - 1] = False
        for r, ids in zip(rest, whole, strict=True):
            out[bounds[r] : bounds[r] + len(ids)] = ids
            cached[bounds[r] : bounds[r] + len(ids)] = False
        out[cached] = flat
        return out, bounds

    @staticmethod
    def _plain(raw: np.ndarray, off: np.ndarray) -> np.ndarray:
        """Rows whose white space is single spaces and line ends between other characters."""
        n = len(raw)
        one = (raw == 0x20) | (raw == 0x0A)
        second, third = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
        second[:-1], third[:-2] = raw[1:], raw[2:]
        odd = ((raw >= 0x09) & (raw <= 0x0D) & (raw != 0x0A)) | ((raw >= 0x1C) & (raw <= 0x1F))
        odd |= (raw == 0xC2) & ((second == 0x85) | (second == 0xA0))
        odd |= (raw == 0xE1) & (second == 0x9A)
        odd |= (raw == 0xE2) & (((second == 0x80) & ((third <= 0x8A) | ((third >= 0xA8) & (third <= 0xAF)))) | (second == 0x81))
        odd |= (raw == 0xE3) & (second == 0x80) & (third == 0x80)
        odd[:-1] |= one[:-1] & one[1:]
        total = np.concatenate([[0], np.cumsum(odd)])
        fine = total[off[1:]] == total[off[:-1]]
        full = off[1:] > off[:-1]
        edges = np.zeros(len(off) - 1, bool)
        edges[full] = one[off[:-1][full]] | one[off[1:][full] - 1]
        return fine & full & ~edges


@functools.lru_cache(2)
def piece_counter(path: str) -> PieceCounter:
    """One per worker process, so that its cache outlives a task."""
    return PieceCounter(path)


class PieceCounter:
    """Numbers of pieces of texts by a sentencepiece model, from a table of frequent words and a cache of the rest."""

    def __init__(self, path: str, frequent: dict[str, int] | None = None):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        #: A piece that goes on over a space or a line end would make words depend on each other.
        self.separable = not any("▁" in p.lstrip("▁") or "\n" in p or (p.startswith("▁▁") and p.strip("▁")) for p in pieces)
        self.frequent, self.rest, self.begins = frequent or {}, {}, {}

    def _spaced(self, words: list[str]) -> list[int]:
        return [1 if not w else len(x) for w, x in zip(words, self.library.encode(words, num_threads=1), strict=True)]

    def _begins(self, words: list[str]) -> list[int]:
        return [len(x) - 2 for x in self.library.encode([f"\n{w}" for w in words], num_threads=1)]

    def plain(self, text: str) -> bool:
        return self.separable and "  " not in text and "▁" not in text and text[:1] not in (" ", "")

    def lines(self, text: str) -> list[list[str]]:
        return [line.split(" ") for line in text.split("\n")]

    def count(self, texts: list[str]) -> list[int]:
        lines = [self.lines(t) if self.plain(t) else None for t in texts]
        spaced, begins = set(), set()
        for rows in lines:
            if rows is not None:
                spaced.update(rows[0])
                for words in rows[1:]:
                    begins.add(words[0])
                    spaced.update(words[1:])
        frequent = self.frequent
        spaced.difference_update(frequent)
        _cached(self.rest, spaced, self._spaced)
        _cached(self.begins, begins, self._begins)
        whole = iter(self.library.encode([t for t, rows in zip(texts, lines, strict=True) if rows is None], num_threads=1))
        out, rest, begin = [], self.rest, self.begins

        def length(word: str) -> int:
            n = frequent.get(word)
            return rest[word] if n is None else n

        for rows in lines:
            if rows is None:
                out.append(len(next(whole)))
                continue
            n = sum(map(length, rows[0]))
            for words in rows[1:]:
                n += 1 + begin[words[0]] + sum(map(length, words[1:]))
            out.append(n)
        return out
