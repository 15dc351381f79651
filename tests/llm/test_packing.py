"""Packing: tokenizer equality, brute-force best fit, gapless sequences."""

import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from epipanel.llm import packing
from llm_fixtures import docs  # noqa: F401
from epipanel.llm.packing import Encoder, best_fit, pack_documents, pack_public

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def encoder():
    return Encoder(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_same_ids_on_all_documents(encoder, tokenizer):
    for (text,) in duckdb.sql(f"SELECT text FROM '{SF_DIR}/documents.parquet' WHERE text IS NOT NULL").fetchall():
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


PARTS = ["<|endoftext|>", "<|endof", "a", " ", "  ", "\n", "\t", "'s", "'S", "é", "中文", "\U0001F600", "0123", "!!", "\x00", "‍", "don't", " ", "ı", "ñ"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(PARTS), st.text(max_size=6)), max_size=12))
def test_same_ids_on_odd_strings(parts):
    text = "".join(parts)
    pair = _pair()
    assert pair[0].ids(text).tolist() == pair[1].encode(text, add_special_tokens=False).ids


_CACHE = []


def _pair():
    if not _CACHE:
        path = public_tokenizers.path("byte_bpe_50k.json")
        _CACHE.append(Encoder(path, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN))
        _CACHE.append(Tokenizer.from_file(path))
    return _CACHE


def test_long_runs(encoder, tokenizer):
    for text in ("a" * 50_000, " " * 50_000, "\n \t" * 9_000, "ab" * 2_000 + " c", "中" * 5_000):
        assert encoder.ids(text).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def plain_best_fit(counts, capacity):
    gaps = []
    for size in sorted(counts, reverse=True):
        for _ in range(counts[size]):
            fits = [g for g in gaps if g >= size]
            if fits:
                gaps.remove(min(fits))
                gaps.append(min(fits) - size)
            else:
                gaps.append(capacity - size)
    return len(gaps), sorted(gaps)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 9), max_size=20))
def test_best_fit_equals_the_plain_algorithm(counts):
    flows, sequences = best_fit(counts, 32)
    want, gaps = plain_best_fit(counts, 32)
    assert sequences == want
    used = {}
    for size, rank, n, first, per, offset in flows.tolist():
        for k in range(n):
            used.setdefault(first + k // per, []).append((offset + k % per * size, size))
    assert sorted(32 - sum(s for _, s in v) for v in used.values()) == gaps
    for places in used.values():
        at = 0
        for offset, size in sorted(places):
            assert offset == at
            at += size
        assert at <= 32


def check(rows, out, tokenizer, capacity):
    got = out.collect()
    by_seq, by_doc = {}, {}
    for r in got:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for places in by_seq.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    expected = {}
    for ident, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        cut = len(ids) % capacity or capacity
        edges = [0, *range(cut, len(ids) + 1, capacity)]
        pieces = [(i, a, b - a, zlib.crc32(ids[a:b].tobytes())) for i, (a, b) in enumerate(zip(edges, edges[1:]))]
        expected.setdefault(ident, []).extend(pieces)
    assert {i: sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rs) for i, rs in by_doc.items()} == {
        i: sorted(p) for i, p in expected.items()
    }
    counts = {}
    for r in got:
        counts[r["length"]] = counts.get(r["length"], 0) + 1
    assert len(by_seq) == plain_best_fit(counts, capacity)[0]


def test_packing(docs, tokenizer):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(["alpha", "beta", "gamma"], k=rng.randint(0, 90)))) for i in range(150)]
    rows += [(900, None), (901, ""), (902, "x " * 700), (902, "x " * 700), (None, "no id"), (903, "<|endoftext|> a")]
    frame = docs(rows).withColumn("length", F.lit("x")).withColumn("rank", F.lit(1)).withColumn("part", F.lit(0))
    out = pack_documents(frame, *_paths(), capacity=64)
    check(rows, out, tokenizer, 64)
    with_ids = pack_documents(docs(rows[:5]), *_paths(), with_ids=True).collect()
    assert all(zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"] for r in with_ids)
    slow = pack_documents(docs(rows[:40]), packing_path(), capacity=64)
    check(rows[:40], slow, tokenizer, 64)


def packing_path():
    return public_tokenizers.path("byte_bpe_50k.json")


def _paths():
    return packing_path(), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_query_capacity_and_empty_table(docs, tokenizer):
    rows = [(1, "word " * 3000), (2, "short"), (3, "tail " * 1023)]
    check(rows, pack_public(docs(rows)), tokenizer, packing.CAPACITY)
    assert pack_public(docs([])).collect() == []
