r"""Word n-grams of many texts, interned in an open-addressed NumPy table.

Words are runs of ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]`` of the UTF-8 text with A-Z
lower-cased; an n-gram is consecutive words joined by one space. The table's
keys are the xxhash64 of the n-grams' bytes; n-grams with one key
are told apart by comparing the bytes, so that two n-grams never share a slot. All steps
are array operations on all occurrences of a batch at once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import xxhash

LONGEST = 3  # words of an n-gram
WORDS_AT_ONCE = 1 << 15  # first words of the n-grams that are interned together
BY_ITSELF = 4096  # bytes: longer n-grams are hashed one by one
SHIFTED = 64  # bytes: the crc32 of an n-gram is put together from those of words up to this length

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.array([b >= 128 or chr(b) in "0123456789abcdefghijklmnopqrstuvwxyz" for b in range(256)])

# The five primes of xxhash64.
_P1 = np.uint64(0x9E3779B185EBCA87)
_P2 = np.uint64(0xC2B2AE3D27D4EB4F)
_P3 = np.uint64(0x165667B19E3779F9)
_P4 = np.uint64(0x85EBCA77C2B2AE63)
_P5 = np.uint64(0x27D4EB2F165667C5)


def _rotl(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc, lane):
    return _rotl(acc + lane * _P2, 31) * _P1


class Bytes:
    """A byte array whose eight bytes at any place can be read as one number."""

    def __init__(self, data: np.ndarray) -> None:
        padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
        self.data = padded
        self.lanes = np.ndarray((len(padded) - 7,), dtype="<u8", buffer=padded, strides=(1,)).copy()


def xxh64(text: Bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """xxhash64 (seed 0) of the spans ``data[start:start + size]``, all at once."""
    with np.errstate(over="ignore"):
        return _xxh64(text, start, size)


def _xxh64(text: Bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    lanes, at, left = text.lanes, start.astype(np.int64), size.astype(np.int64)
    out = np.full(len(at), _P5, dtype=np.uint64)
    giant = np.flatnonzero(left > BY_ITSELF)
    wide = np.flatnonzero((left >= 32) & (left <= BY_ITSELF))
    if len(wide):
        v = [np.full(len(wide), s, dtype=np.uint64) for s in (_P1 + _P2, _P2, np.uint64(0), np.uint64(0) - _P1)]
        live = np.arange(len(wide))
        while len(live):
            where = at[wide[live]]
            for j in range(4):
                v[j][live] = _round(v[j][live], lanes[where + 8 * j])
            at[wide[live]] += 32
            left[wide[live]] -= 32
            live = live[left[wide[live]] >= 32]
        h = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for x in v:
            h = (h ^ _round(np.uint64(0), x)) * _P1 + _P4
        out[wide] = h
    out += size.astype(np.uint64)
    left[giant] = 0
    todo = np.flatnonzero(left >= 8)
    while len(todo):
        out[todo] = _rotl(out[todo] ^ _round(np.uint64(0), lanes[at[todo]]), 27) * _P1 + _P4
        at[todo] += 8
        left[todo] -= 8
        todo = todo[left[todo] >= 8]
    todo = np.flatnonzero(left >= 4)
    out[todo] = _rotl(out[todo] ^ ((lanes[at[todo]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[todo] += 4
    left[todo] -= 4
    todo = np.flatnonzero(left > 0)
    while len(todo):
        out[todo] = _rotl(out[todo] ^ ((lanes[at[todo]] & np.uint64(0xFF)) * _P5), 11) * _P1
        at[todo] += 1
        left[todo] -= 1
        todo = todo[left[todo] > 0]
    out = (out ^ (out >> np.uint64(33))) * _P2
    out = (out ^ (out >> np.uint64(29))) * _P3
    out ^= out >> np.uint64(32)
    for i in giant.tolist():
        out[i] = xxhash.xxh64_intdigest(text.data[start[i] : start[i] + size[i]].tobytes())
    return out


def same_bytes(text: Bytes, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` bytes from ``a`` and from ``b`` hold the same bytes."""
    out = np.ones(len(a), dtype=bool)
    todo, done = np.arange(len(a)), 0
    while len(todo):
        left = size[todo] - done
        differ = text.lanes[a[todo] + done] ^ text.lanes[b[todo] + done]
        unused = (8 * (8 - np.minimum(left, 8))).astype(np.uint64)  # bits beyond the span
        out[todo[(differ << unused) != 0]] = False
        done += 8
        todo = todo[(left > 8) & out[todo]]
    return out


def _crc_tables() -> tuple[np.ndarray, np.ndarray]:
    """The crc32 remainder of each byte; and of each byte of a crc, by its place, ``n`` zero bytes later."""
    step = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        step = (step >> np.uint32(1)) ^ np.where(step & np.uint32(1), np.uint32(0xEDB88320), np.uint32(0))
    shifts = np.zeros((SHIFTED + 1, 4, 256), dtype=np.uint32)
    for j in range(4):
        shifts[0, j] = np.arange(256, dtype=np.uint32) << np.uint32(8 * j)
    for n in range(SHIFTED):
        shifts[n + 1] = step[shifts[n] & np.uint32(255)] ^ (shifts[n] >> np.uint32(8))
    return step, shifts.reshape(-1)


_STEP, _SHIFTS = _crc_tables()
_ONES = np.uint32(0xFFFFFFFF)


def crc_joined(left: np.ndarray, right: np.ndarray, size: np.ndarray) -> np.ndarray:
    """crc32 of ``a + b" " + b`` from those of a and b, b having ``size`` (at most ``SHIFTED``) bytes."""
    c = left ^ _ONES
    c = (_STEP[(c ^ np.uint32(32)) & np.uint32(255)] ^ (c >> np.uint32(8))) ^ _ONES
    at = size * 1024
    out = right.copy()
    for j in range(4):
        out ^= _SHIFTS[at + (256 * j + ((c >> np.uint32(8 * j)) & np.uint32(255)).astype(np.int64))]
    return out


def crc_each(text: Bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    body = memoryview(text.data)
    return np.array([zlib.crc32(body[a:b]) for a, b in zip(start.tolist(), (start + size).tolist())], dtype=np.uint32)


class NgramTable:
    """Open addressing with linear probing: a slot holds a distinct n-gram's
    hash, first place, bucket and number of occurrences. ``crcs`` gives the crc32
    of the slots' n-grams, by the slots and their holders, where these can be had cheaper than from the bytes."""

    def __init__(self, text: Bytes, start: np.ndarray, size: np.ndarray, buckets: int, crcs=None) -> None:
        n_slots = 1 << max(4, int(2 * len(start) - 1).bit_length())
        self.key = np.zeros(n_slots, dtype=np.uint64)
        self.holder = np.full(n_slots, -1, dtype=np.int64)  # an occurrence of the slot's n-gram; -1: free
        self.slots = self._intern(text, start, size)  # of each occurrence
        self.used = np.flatnonzero(self.holder >= 0)
        self.bucket = np.zeros(n_slots, dtype=np.int32)
        held = self.holder[self.used]
        crc = crc_each(text, start[held], size[held]) if crcs is None else crcs(self.slots, self.used, held)
        self.bucket[self.used] = crc % np.uint32(buckets)
        self.count = np.bincount(self.slots, minlength=n_slots)

    def _intern(self, text: Bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        hashes = xxh64(text, start, size)
        mask = np.uint64(len(self.holder) - 1)
        probe = (hashes & mask).astype(np.int64)
        slots = np.zeros(len(start), dtype=np.int64)
        todo = np.arange(len(start))
        while len(todo):
            spot = probe[todo]
            free = self.holder[spot] < 0
            # of several that claim a free slot one stays; the others meet it right below
            self.holder[spot[free]] = todo[free]
            held = self.holder[spot]
            self.key[spot[free]] = hashes[held[free]]
            same = (self.key[spot] == hashes[todo]) & (size[held] == size[todo])
            check = np.flatnonzero(same & (held != todo))
            same[check] = same_bytes(text, start[todo[check]], start[held[check]], size[todo[check]])
            slots[todo[same]] = spot[same]
            todo = todo[~same]
            probe[todo] = (probe[todo] + 1) & int(mask)
        return slots

    def bucket_counts(self, buckets: int) -> np.ndarray:
        return np.bincount(self.bucket[self.used], weights=self.count[self.used], minlength=buckets).astype(np.int64)


def ngram_tables(texts: list[bytes], buckets: int) -> Iterator[tuple[np.ndarray, NgramTable, np.ndarray]]:
    """(words of each text, table of a part of their n-grams, text of each
    occurrence) until all n-grams of all texts were interned; at least one part.

    The number of words comes complete with every part.
    """
    sizes = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    text_starts = np.concatenate(([0], np.cumsum(sizes)))
    raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)] if texts else np.zeros(0, np.uint8)
    word = _IN_WORD[raw]
    edges = np.flatnonzero(np.diff(word, prepend=False, append=False))
    starts, ends = edges[::2], edges[1::2]
    bounds = np.searchsorted(starts, text_starts)
    n_words = np.diff(bounds)
    # the words with one space after each
    word[ends] = True
    raw = raw.copy()
    raw[ends] = 32
    text = Bytes(raw[word])
    after = np.cumsum(ends - starts + 1)
    first = after - (ends - starts + 1)
    last = after - 1
    owner = np.repeat(np.arange(len(texts)), n_words)
    text_end = np.repeat(bounds[1:], n_words)
    for low in range(0, max(1, len(starts)), WORDS_AT_ONCE):
        at = np.arange(low, min(low + WORDS_AT_ONCE, len(starts)))
        grams = [at[at + n <= text_end[at]] for n in range(1, LONGEST + 1)]
        word = np.concatenate(grams)
        length = np.repeat(np.arange(LONGEST), [len(g) for g in grams])  # words after the first
        begin, size = first[word], last[word + length] - first[word]

        def crcs(slots: np.ndarray, used: np.ndarray, held: np.ndarray) -> np.ndarray:
            """Of single words from their bytes, of others from the crc32 of their words."""
            out = np.zeros(len(used), dtype=np.uint32)
            single = length[held] == 0
            out[single] = crc_each(text, begin[held[single]], size[held[single]])
            beyond = np.arange(low + len(at), min(low + len(at) + LONGEST - 1, len(starts)))
            of_slot = np.zeros(int(used[-1]) + 1 if len(used) else 0, dtype=np.uint32)
            of_slot[used] = out
            of_word = np.concatenate((of_slot[slots[: len(at)]], crc_each(text, first[beyond], last[beyond] - first[beyond])))
            out[~single] = of_word[word[held[~single]] - low]
            todo = np.flatnonzero(~single)
            for n in range(1, LONGEST):
                todo = todo[length[held[todo]] >= n]
                added = word[held[todo]] + n
                out[todo] = crc_joined(out[todo], of_word[added - low], np.minimum(last[added] - first[added], SHIFTED))
                long = todo[last[added] - first[added] > SHIFTED]
                # up to and with the long word
                out[long] = crc_each(text, begin[held[long]], last[word[held[long]] + n] - begin[held[long]])
            return out

        yield n_words, NgramTable(text, begin, size, buckets, crcs), owner[word]
