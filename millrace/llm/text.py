"""Whole Arrow string columns as numpy arrays of words: spans, 64-bit hashes, counts.

A word is a maximal run of bytes other than space and \\x09-\\x0D; a word never
crosses a row. Nulls count as empty texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text that are worked on at a time; bounds a worker's memory.
SLICE_BYTES = 4 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [2**64 - 1], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def column_bytes(col) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows in them."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = pc.fill_null(col, "")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offsets, data = col.buffers()
    if len(col) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with at most `most` bytes of text each, or a single row."""
    _, off = column_bytes(batch.column(text))
    at, rows = 0, batch.num_rows
    while at < rows:
        end = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return raw + (((raw - np.uint8(65)) < 26).view(np.uint8) << 5)


class Words:
    """Words of the rows of a string column, in order: starts, ends, and of each row the first word's number."""

    def __init__(self, col, lower: bool = False, fold=None):
        """fold: gives the bytes to hash, as many as there are, and a flag for each that belongs to a word, if words are other than above; and, if there is a third array, a flag for each byte before which a word ends in any case."""
        self.raw, self.off = column_bytes(col)
        self.bytes = lower_ascii(self.raw) if lower else self.raw
        n = len(self.raw)
        if fold is None:
            solid = ~_SPACE[self.raw]
        else:
            self.bytes, solid, *cut = fold(self.raw)
        edge = np.zeros(n + 1, bool)
        if fold is not None and cut:
            edge[:n] = cut[0]
        edge[self.off] = True
        first, last = solid.copy(), solid.copy()
        if n:
            first[1:] &= ~solid[:-1] | edge[1:n]
            last[:-1] &= ~solid[1:] | edge[1:n]
        self.solid = solid
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, self.off)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def rows(self) -> np.ndarray:
        """The row of each word."""
        return np.repeat(np.arange(len(self.off) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.zeros(0, np.uint64)
        padded = np.concatenate([self.bytes, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.bytes) + 1,), "<u8", padded, strides=(1,))
        left, at = self.ends - self.starts, self.starts
        h = mix((eight[at] & _MASK[np.minimum(left, 8)]) + left.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        which, done = np.flatnonzero(left > 8), 8
        while len(which):
            left, at = self.ends[which] - self.starts[which], self.starts[which]
            part = eight[at + done] & _MASK[np.minimum(left - done, 8)]
            h[which] = mix(h[which] * np.uint64(0xD6E8FEB86659FD93) + part)
            done += 8
            which = which[left > done]
        return h


def windows(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of `width` words, and which windows lie within one row."""
    n = max(0, len(hashes) - width + 1)
    h = hashes[:n].copy()
    for k in range(1, width):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n + k])
    inside = np.ones(n, bool)
    for edge in range(1, width):
        cut = first[1:-1] - edge
        inside[cut[(cut >= 0) & (cut < n)]] = False
    return h, inside


def per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How many flags are set from off[i] to off[i + 1]."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[off[1:]] - total[off[:-1]]
