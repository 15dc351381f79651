"""Vectorised words against the regular expression."""

import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from epipanel.llm import words as W

SPACES = " \t\n\x0b\x0c\r"


def plain(text):
    low = re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode())
    return re.findall(rb"[^\x20\x09-\x0D]+", low)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(alphabet="aB é\n\t.\U0001F600\x00", max_size=30), max_size=8), st.integers(1, 40))
def test_words_and_hashes(texts, segment):
    before, W.SEGMENT = W.SEGMENT, segment
    try:
        found = W.words_of([t.encode() for t in texts])
    finally:
        W.SEGMENT = before
    by_hash = {}
    for i, text in enumerate(texts):
        a, b = found.bounds[i], found.bounds[i + 1]
        got = [found.data[s:e].tobytes() for s, e in zip(found.starts[a:b], found.ends[a:b])]
        assert got == plain(text)
        for word, h in zip(got, found.hashes[a:b]):
            assert by_hash.setdefault(word, h) == h
    assert len(set(by_hash.values())) == len(by_hash)


def test_shingles_are_runs_within_a_text():
    random.seed(1)
    texts = [" ".join(random.choices("abcd", k=random.randint(0, 12))) for _ in range(200)]
    sets = W.shingle_sets(W.words_of([t.encode() for t in texts]))
    want = []
    for t in texts:
        w = t.split()
        want.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    for a, x in zip(sets, want):
        assert len(a) == len(x)
        for b, y in zip(sets, want):
            assert len(np.intersect1d(a, b)) == len(x & y)


def test_span_hashes_do_not_depend_on_the_place():
    h = np.array([5, 7, 9, 5, 7, 9, 1], dtype=np.uint64)
    out = W.span_hashes(h, np.array([0, 3, 0, 1]), np.array([3, 6, 2, 3]))
    assert out[0] == out[1] and len(set(out.tolist())) == 3


def test_groups_keep_every_text():
    texts = [b"a" * n for n in (5, 0, 100, 3)] + [None]
    assert [t for _, g in W.groups(texts, 10) for t in g] == [t or b"" for t in texts]
    assert [i for i, _ in W.groups(texts, 10)] == [0, 2, 3]
    assert list(W.groups([])) == []


def thue_morse(a, b, n):
    """The pattern a b b a b a a b..., of ``n`` elements: equal to its complement in any
    polynomial hash modulo a power of two."""
    return [b if bin(i).count("1") % 2 else a for i in range(n)]


def test_regular_patterns_have_hashes_of_their_own():
    for n in (1024, 4096):
        one, other = "".join(thue_morse("a", "b", n)), "".join(thue_morse("b", "a", n))
        found = W.words_of([f"{one} {other}".encode()])
        assert found.hashes[0] != found.hashes[1]
        words = W.words_of([" ".join(thue_morse("left", "right", n)).encode(), " ".join(thue_morse("right", "left", n)).encode()])
        first, last = words.bounds[:-1], words.bounds[1:]
        spans = W.span_hashes(words.hashes, first, last)
        assert spans[0] != spans[1]
        for i in (0, 1):
            assert W.run_hashes(words.hashes[first[i] : last[i]], n)[0] == spans[i]


def test_long_and_short_sums_agree():
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5000, dtype=np.uint8).astype(np.uint64)
    first = rng.integers(0, 5000, 300)
    last = first + rng.integers(0, 5000 - first + 1)
    for table in W._TABLES:
        assert (table.spans(data, first, last) == table.long_spans(data, first, last)).all()
        one = data[first[0] : last[0]].tolist()
        assert int(table.spans(data, first, last)[0]) == sum(x * pow(table.base, i, table.prime) for i, x in enumerate(one)) % table.prime
