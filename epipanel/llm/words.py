r"""Words of many texts at once, as numpy arrays.

A word is a run of ``[^\x20\x09-\x0D]`` of the UTF-8 text with A-Z lower-cased.
Its hash is a pair of polynomials over its bytes modulo two primes of 31 bits, finished by
a mixing step; prefix sums give the hashes of all words of a batch without a Python loop
over words. (Modulo a power of two, regular patterns of two letters or words have equal
hashes whatever the base.) Hashes of runs of words are built from word hashes in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

GROUP_BYTES = 1024 * 1024  # texts looked at together: some 50 bytes of arrays per byte
ROWS_AT_ONCE = 64
SEGMENT = 1 << 18  # bytes hashed together, unless one word is longer

_MODULI = ((2147483647, 1_540_483_477), (2147483629, 668_265_263))  # primes, and a base for each

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: everything but digits, letters and non-ASCII characters
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _powers(base: int, n: int, prime: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    filled, step = 1, base % prime
    while filled < n:
        take = min(filled, n - filled)
        out[filled : filled + take] = out[:take] * np.uint64(step) % np.uint64(prime)
        filled += take
        step = step * step % prime
    return out


class PowerTable:
    """Powers of a base modulo a prime and their inverses, grown on demand."""

    def __init__(self, prime: int, base: int) -> None:
        self.prime, self.base, self.inverse_base = prime, base, pow(base, -1, prime)
        self.modulus = np.uint64(prime)
        self.powers = self.inverses = np.ones(0, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.powers) < n:
            self.powers, self.inverses = _powers(self.base, n, self.prime), _powers(self.inverse_base, n, self.prime)
        return self.powers[:n], self.inverses[:n]

    def spans(self, terms: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The polynomial of each run ``terms[first:last]``. The terms are so small that
        their products with powers add up below 2^64."""
        powers, inverses = self.upto(len(terms) + 1)
        sums = np.empty(len(terms) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(terms * powers[: len(terms)], out=sums[1:])
        return (sums[last] - sums[first]) % self.modulus * inverses[first] % self.modulus

    def long_spans(self, terms: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The same for terms of any size and up to 2^32 of them."""
        powers, inverses = self.upto(len(terms) + 1)
        sums = np.zeros(len(terms) + 1, dtype=np.uint64)
        np.cumsum(terms % self.modulus * powers[: len(terms)] % self.modulus, out=sums[1:])
        return (sums[last] - sums[first]) % self.modulus * inverses[first] % self.modulus


def mix(x: np.ndarray) -> np.ndarray:
    """The finalisation of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_TABLES = [PowerTable(prime, base) for prime, base in _MODULI]
_SHORT = 1 << 24  # terms of a byte each whose products add up below 2^64


def _finish(parts: list[np.ndarray], sizes: np.ndarray) -> np.ndarray:
    high, low = parts
    return mix((high << np.uint64(32) | low) + mix(sizes.astype(np.uint64)))


def _hash_segment(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    terms = data.astype(np.uint64) + np.uint64(1)
    parts = [(t.spans if len(terms) <= _SHORT else t.long_spans)(terms, starts, ends) for t in _TABLES]
    return _finish(parts, ends - starts)


@dataclass
class Words:
    data: np.ndarray  # lower-cased bytes of all texts, one line feed after each
    starts: np.ndarray  # first byte of each word
    ends: np.ndarray  # byte after each word
    hashes: np.ndarray
    text_starts: np.ndarray  # first byte of each text
    bounds: np.ndarray  # words bounds[i]:bounds[i + 1] are text i's


def words_of(texts: list[bytes], between: np.ndarray = _SPACE) -> Words:
    """``between`` tells the bytes that stand between words; line feeds must be among them."""
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    text_starts = np.concatenate(([0], np.cumsum(sizes)))
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8) if texts else np.zeros(0, np.uint8)
    data = _LOWER[data]
    word = ~between[data]
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    bounds = np.searchsorted(starts, text_starts)
    hashes = np.zeros(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + SEGMENT, side="right")))
        piece = slice(first, last)
        hashes[piece] = _hash_segment(data[base : ends[last - 1]], starts[piece] - base, ends[piece] - base)
        first = last
    return Words(data, starts, ends, hashes, text_starts[:-1], bounds)


def few_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of so few rows that their texts may become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)


def groups(texts: pa.Array | list, limit: int = GROUP_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) of about ``limit`` bytes each, null
    counting as empty. A column is turned into Python objects a few rows at a time."""
    first, group, size, i = 0, [], 0, 0
    for at in range(0, len(texts), ROWS_AT_ONCE):
        part = texts[at : at + ROWS_AT_ONCE]
        for text in part if isinstance(part, list) else part.to_pylist():
            text = text or b""
            if group and size + len(text) > limit:
                yield first, group
                first, group, size = i, [], 0
            group.append(text)
            size += len(text)
            i += 1
    if group:
        yield first, group


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """The hash of each run of ``length`` hashes."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    parts = []
    for t in _TABLES:
        powers, _ = t.upto(length)
        reduced = hashes % t.modulus
        out = np.zeros(n, dtype=np.uint64)
        for j in range(length):
            out += reduced[j : j + n] * powers[j]
            # a remainder and four products of 31-bit numbers stay below 2^64
            if j % 4 == 3 or j + 1 == length:
                out %= t.modulus
        parts.append(out)
    return _finish(parts, np.full(n, length))


def span_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of each run ``hashes[first:last]``, of any length; runs of one length
    have the hashes that ``run_hashes`` gives them."""
    return _finish([t.long_spans(hashes, first, last) for t in _TABLES], np.asarray(last) - np.asarray(first))


def shingle_sets(words: Words, length: int = 5) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its runs of ``length`` words;
    a text of fewer words has one shingle of all its words, one of none has none."""
    runs = run_hashes(words.hashes, length)
    out = []
    for a, b in zip(words.bounds[:-1], words.bounds[1:]):
        if b - a >= length:
            out.append(np.unique(runs[a : b - length + 1]))
        elif b > a:
            out.append(run_hashes(words.hashes[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
