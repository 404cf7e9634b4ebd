"""Elias-Fano sequences that answer many lookups at once, over memory that may be a mapped file.

A sequence of n non-decreasing numbers keeps the low bits of each as they are and the high bits in unary.
For every 64 bits of the unary part the ones and the zeros before them are stored, so the place of any one or
zero is a binary search and a look at a word. All lookups take and give numpy arrays.
"""

from __future__ import annotations

import struct

import numpy as np

_HEAD = struct.Struct("<QQQQ")
_U = np.uint64


def _packed(values: np.ndarray, bits: int) -> np.ndarray:
    """values of `bits` bits each, end to end in 64-bit words, and one word more."""
    words = np.zeros(len(values) * bits // 64 + 2, np.uint64)
    if bits:
        at = np.arange(len(values), dtype=np.uint64) * _U(bits)
        word, off = (at >> _U(6)).astype(np.int64), at & _U(63)
        # parts of one word have no common bits, so that sums are unions
        begins = np.flatnonzero(np.diff(word, prepend=-1))
        if len(begins):
            words[word[begins]] = np.bitwise_or.reduceat(values << off, begins)
        over = np.flatnonzero(off + _U(bits) > _U(64))
        words[word[over] + 1] |= values[over] >> (_U(64) - off[over])
    return words


_EACH, _TOPS = _U(0x0101010101010101), _U(0x8080808080808080)
#: The place of the k-th one of a byte, at byte + 256 * k.
_IN_BYTE = np.array([([i for i in range(8) if byte >> i & 1] + [0] * 8)[k] for k in range(8) for byte in range(256)], np.uint8)


def _place(word: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of the k-th one of each word, from 0."""
    k = k.astype(np.uint64)
    # of each byte of a word the ones up to its end, and so how many bytes end before the k-th one
    upto = np.bitwise_count(np.ascontiguousarray(word).view(np.uint8)).view(np.uint64) * _EACH
    shift = np.bitwise_count((((k * _EACH) | _TOPS) - upto) & _TOPS).astype(np.uint64) << _U(3)
    left = k - (((upto << _U(8)) >> shift) & _U(255))
    return shift.astype(np.int64) + _IN_BYTE[(((word >> shift) & _U(255)) | (left << _U(8))).astype(np.int64)]


class Monotone:
    def __init__(self, data: np.ndarray):
        """data: bytes from pack(), as an array of uint8."""
        n, bits, low, high = _HEAD.unpack(data[: _HEAD.size].tobytes())
        self.n, self.bits = n, bits
        at = _HEAD.size
        self.low, at = data[at : at + 8 * low].view("<u8"), at + 8 * low
        self.high, at = data[at : at + 8 * high].view("<u8"), at + 8 * high
        self.ones, at = data[at : at + 4 * high].view("<u4"), at + 4 * high
        self.zeros = data[at : at + 4 * high].view("<u4")

    @staticmethod
    def pack(values: np.ndarray) -> bytes:
        v = np.asarray(values, np.uint64)
        n = len(v)
        bits = max(0, (int(v[-1]) // n).bit_length() - 1) if n else 0
        ones = (v >> _U(bits)).astype(np.int64) + np.arange(n)
        words = np.zeros((int(ones[-1]) if n else 0) // 64 + 2, np.uint64)
        begins = np.flatnonzero(np.diff(ones >> 6, prepend=-1))
        if n:
            words[ones[begins] >> 6] = np.bitwise_or.reduceat(_U(1) << (ones & 63).astype(np.uint64), begins)
        low = _packed(v & _U((1 << bits) - 1), bits)
        before = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)[:-1]])
        zeros = 64 * np.arange(len(words)) - before
        if len(words) and max(before[-1], zeros[-1]) >= 1 << 32:
            raise ValueError("a sequence of over 2 ** 32 numbers has to be split")
        body = _HEAD.pack(n, bits, len(low), len(words)) + low.astype("<u8").tobytes() + words.astype("<u8").tobytes() + before.astype("<u4").tobytes() + zeros.astype("<u4").tobytes()
        return body + bytes(-len(body) % 8)

    def _one(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.ones, i.astype(np.uint32), "right") - 1
        return (word << 6) + _place(self.high[word], i - self.ones[word])

    def _zero(self, i: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.zeros, i.astype(np.uint32), "right") - 1
        return (word << 6) + _place(~self.high[word], i - self.zeros[word])

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.bits:
            return np.zeros(len(i), np.uint64)
        at = i.astype(np.uint64) * _U(self.bits)
        word, off = (at >> _U(6)).astype(np.int64), at & _U(63)
        # in two shifts, since one of 64 places is none
        value = (self.low[word] >> off) | (self.low[word + 1] << _U(1) << (_U(63) - off))
        return value & _U((1 << self.bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at places i, as uint64."""
        i = np.asarray(i, np.int64)
        return ((self._one(i) - i).astype(np.uint64) << _U(self.bits)) | self._low(i)

    def spans(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at places i and at the places after them, as int64."""
        i = np.asarray(i, np.int64)
        at = self._one(i)
        # the next one is in the same word of the unary part, but for a few
        rest = self.high[at >> 6] >> (at & 63).astype(np.uint64) >> _U(1)
        after = at + 1 + np.bitwise_count(~rest & (rest - _U(1)))
        far = np.flatnonzero(rest == 0)
        after[far] = self._one(i[far] + 1)
        return ((at - i) << self.bits) | self._low(i).astype(np.int64), ((after - i - 1) << self.bits) | self._low(i + 1).astype(np.int64)

    def index(self, values: np.ndarray) -> np.ndarray:
        """A place of each of values, -1 if it is not there."""
        values = np.asarray(values, np.uint64)
        out = np.full(len(values), -1, np.int64)
        if not self.n or not len(values):
            return out
        last = self.get(np.array([self.n - 1]))[0]
        high = (np.minimum(values, last) >> _U(self.bits)).astype(np.int64)
        # values with these high bits are the ones that follow a zero of the unary part
        at = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) + 1, 0)
        off = at & 63
        ones = self.high[at >> 6] >> off.astype(np.uint64)
        run = np.bitwise_count(ones & ~(ones + _U(1))).astype(np.int64)
        begin = at - high
        end = begin + run
        far = np.flatnonzero(run == 64 - off)
        end[far] = self._zero(high[far]) - high[far]
        open_ = np.flatnonzero((begin < end) & (values <= last))
        begin, end, low = begin[open_], end[open_], values[open_] & _U((1 << self.bits) - 1)
        while len(open_):
            middle = (begin + end) >> 1
            found = self._low(middle)
            same, below = found == low, found < low
            out[open_[same]] = middle[same]
            begin, end = np.where(below, middle + 1, begin), np.where(below, end, middle)
            left = np.flatnonzero(~same & (begin < end))
            open_, begin, end, low = open_[left], begin[left], end[left], low[left]
        return out

    def first_of(self, values: np.ndarray) -> np.ndarray:
        """The first place whose value is not below each of values, n if there is none."""
        values = np.asarray(values, np.uint64)
        if not self.n:
            return np.zeros(len(values), np.int64)
        last = self.get(np.array([self.n - 1]))[0]
        high, low = (np.minimum(values, last) >> _U(self.bits)).astype(np.int64), np.minimum(values, last) & _U((1 << self.bits) - 1)
        # values with these high bits lie between two zeros of the unary part
        begin, end = np.zeros(len(values), np.int64), np.full(len(values), self.n, np.int64)
        some = np.flatnonzero(high > 0)
        begin[some] = self._zero(high[some] - 1) - (high[some] - 1)
        some = np.flatnonzero(high < int(last >> _U(self.bits)))
        end[some] = self._zero(high[some]) - high[some]
        open_ = np.flatnonzero(begin < end)
        while len(open_):
            middle = (begin[open_] + end[open_]) >> 1
            below = self._low(middle) < low[open_]
            begin[open_[below]] = middle[below] + 1
            end[open_[~below]] = middle[~below]
            open_ = open_[begin[open_] < end[open_]]
        return np.where(values > last, self.n, begin)

    def __len__(self) -> int:
        return self.n


class Ranges:
    """Ascending numbers in ranges; each number is stored above all of the ranges before it, so that the whole is monotone."""

    def __init__(self, values: Monotone):
        self.values = values

    @staticmethod
    def pack(numbers: np.ndarray, begins: np.ndarray) -> bytes:
        """begins: of each range that is not empty the place of its first number."""
        numbers = np.asarray(numbers, np.uint64)
        if not len(numbers):
            return Monotone.pack(numbers)
        ends = np.append(begins[1:], len(numbers))
        base = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers[ends - 1] + _U(1), dtype=np.uint64)[:-1]])
        return Monotone.pack(numbers + np.repeat(base, ends - begins))

    def base(self, begin: np.ndarray) -> np.ndarray:
        """What is added to the numbers of ranges that start at begin."""
        out = np.zeros(len(begin), np.uint64)
        some = np.flatnonzero(begin > 0)
        out[some] = self.values.get(begin[some] - 1) + _U(1)
        return out

    def get(self, begin: np.ndarray, i: np.ndarray) -> np.ndarray:
        """The numbers at places i, in ranges that start at begin."""
        return (self.values.get(i) - self.base(begin)).astype(np.int64)

    def find(self, begin: np.ndarray, end: np.ndarray, number: np.ndarray, base: np.ndarray | None = None) -> np.ndarray:
        """The place of each number in its range, -1 if it is not there; base: that of begin, if it is known."""
        out = np.full(len(begin), -1, np.int64)
        some = np.flatnonzero(begin < end)
        if not len(some):
            return out
        at = self.values.index(number[some].astype(np.uint64) + (self.base(begin[some]) if base is None else base[some]))
        # a number above all of its range may be one of the next
        out[some] = np.where(at < end[some], at, -1)
        return out
