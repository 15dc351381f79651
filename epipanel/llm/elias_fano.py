"""Elias-Fano sequences in numpy: compact, memory-mappable, searched in batches."""

from __future__ import annotations

import os

import numpy as np

_ONE = np.uint64(1)
_WORD = np.uint64(63)


class EliasFano:
    """A non-decreasing sequence of unsigned integers.

    Of n values up to u the low floor(log2(u / n)) bits are stored packed, the
    high parts in unary in a bit vector of at most about 3n bits: value i sets
    bit (high part + i). A running count of ones per 64 bits makes
    ``get`` (select) and ``successor`` possible without unpacking.
    """

    def __init__(self, n: int, low_bits: int, top: int, low: np.ndarray, high: np.ndarray, ones: np.ndarray) -> None:
        self.n, self.low_bits, self.top = n, low_bits, top  # top: the largest high part
        self.low, self.high, self.ones = low, high, ones

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        low_bits = max(0, (top // max(n, 1)).bit_length() - 1)
        low = np.zeros(n * low_bits // 64 + 2, dtype=np.uint64)
        if low_bits and n:
            part = values & np.uint64((1 << low_bits) - 1)
            bit = np.arange(n, dtype=np.uint64) * np.uint64(low_bits)
            _or_into(low, (bit >> np.uint64(6)).astype(np.int64), part << (bit & _WORD))
            shift = bit & _WORD
            over = shift + np.uint64(low_bits) > np.uint64(64)
            _or_into(low, (bit[over] >> np.uint64(6)).astype(np.int64) + 1, part[over] >> (np.uint64(64) - shift[over]))
        places = (values >> np.uint64(low_bits)) + np.arange(n, dtype=np.uint64)
        high = np.zeros((int(places[-1]) if n else 0) // 64 + 2, dtype=np.uint64)
        _or_into(high, (places >> np.uint64(6)).astype(np.int64), _ONE << (places & _WORD))
        ones = np.zeros(len(high) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(high), out=ones[1:])
        return cls(n, low_bits, top >> low_bits, low, high, ones)

    def save(self, folder: str, name: str) -> None:
        for part in ("low", "high", "ones"):
            np.save(os.path.join(folder, f"{name}.{part}.npy"), getattr(self, part))
        np.save(os.path.join(folder, f"{name}.shape.npy"), np.array([self.n, self.low_bits, self.top], dtype=np.uint64))

    @classmethod
    def open(cls, folder: str, name: str) -> EliasFano:
        """Memory-mapped, as saved."""
        path = lambda part: os.path.join(folder, f"{name}.{part}.npy")
        n, low_bits, top = np.load(path("shape")).tolist()
        return cls(n, low_bits, top, *(np.load(path(part), mmap_mode="r") for part in ("low", "high", "ones")))

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), dtype=np.uint64)
        bit = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & _WORD
        # shifting by 64 in two steps, since a shift by 64 is undefined
        value = (self.low[word] >> shift) | ((self.low[word + 1] << _ONE) << (_WORD - shift))
        return value & np.uint64((1 << self.low_bits) - 1)

    def get(self, i: np.ndarray) -> np.ndarray:
        """The values at the given places."""
        word = np.searchsorted(self.ones, i, side="right") - 1
        place = word * 64 + _select(self.high[word], i - self.ones[word])
        return (place - i).astype(np.uint64) << np.uint64(self.low_bits) | self._low(i)

    def _before(self, high: np.ndarray) -> np.ndarray:
        """How many values have a smaller high part: ones before its zero number ``high - 1``."""
        zeros = np.arange(len(self.ones), dtype=np.int64) * 64 - self.ones
        wanted = high - 1
        word = np.clip(np.searchsorted(zeros, wanted, side="right") - 1, 0, len(self.high) - 1)
        inside = np.where(wanted < 0, 0, wanted - zeros[word])
        place = word * 64 + _select(~self.high[word], np.minimum(inside, 63))
        found = place + 1 - (wanted + 1)
        return np.where(wanted < 0, 0, np.minimum(found, self.n))

    def _high(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """High parts, at most ``top``, and where they are beyond it."""
        high = x >> np.uint64(self.low_bits)
        beyond = high > np.uint64(self.top)
        return np.minimum(high, np.uint64(self.top)).astype(np.int64), beyond

    def successor(self, x: np.ndarray, least: np.ndarray | int = 0, most: np.ndarray | None = None) -> np.ndarray:
        """For each x the first place in [least, most) whose value is at least x, or ``most``."""
        x = x.astype(np.uint64)
        most = np.full(len(x), self.n, dtype=np.int64) if most is None else most
        if not self.n:
            return np.zeros(len(x), dtype=np.int64)
        high, beyond = self._high(x)
        low = np.maximum(self._before(high), least)
        end = np.minimum(np.maximum(self._before(high + 1), low), most)
        low = np.minimum(low, most)
        part = x & np.uint64((1 << self.low_bits) - 1)
        open_ = np.flatnonzero(low < end)
        while len(open_):
            middle = (low[open_] + end[open_]) // 2
            smaller = self._low(middle) < part[open_]
            low[open_[smaller]] = middle[smaller] + 1
            end[open_[~smaller]] = middle[~smaller]
            open_ = open_[low[open_] < end[open_]]
        return np.where(beyond, most, low)

    def find(self, x: np.ndarray, least: np.ndarray | int = 0, most: np.ndarray | None = None) -> np.ndarray:
        """The place of x in [least, most), or -1."""
        if not self.n:
            return np.full(len(x), -1, dtype=np.int64)
        at = self.successor(x, least, most)
        inside = at < (self.n if most is None else most)
        safe = np.minimum(at, self.n - 1)
        # among equal high parts the low parts decide; the high part is compared by counting
        x = x.astype(np.uint64)
        high, beyond = self._high(x)
        same_low = self._low(safe) == x & np.uint64((1 << self.low_bits) - 1)
        places = np.flatnonzero(inside & same_low & ~beyond)
        out = np.full(len(x), -1, dtype=np.int64)
        within = safe[places] < self._before(high[places] + 1)
        out[places[within]] = safe[places][within]
        return out


def _or_into(target: np.ndarray, index: np.ndarray, bits: np.ndarray) -> None:
    """Sets bits that do not overlap; ``index`` is sorted."""
    if len(index):
        first = np.flatnonzero(np.diff(index, prepend=-1))
        target[index[first]] |= np.bitwise_or.reduceat(bits, first)


def _select(words: np.ndarray, k: np.ndarray) -> np.ndarray:
    """The place of the k-th set bit (from 0) of each 64-bit word."""
    words = np.asarray(words).copy()
    k = np.asarray(k).astype(np.int64).copy()
    place = np.zeros(len(words), dtype=np.int64)
    for width in (32, 16, 8, 4, 2, 1):
        lower = words & np.uint64((1 << width) - 1)
        count = np.bitwise_count(lower).astype(np.int64)
        up = k >= count
        k -= np.where(up, count, 0)
        place += np.where(up, width, 0)
        words = np.where(up, words >> np.uint64(width), lower)
    return place
