"""The language model against a brute-force one, and its normalisation."""

import math
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from epipanel.llm import language_model as lm
from llm_fixtures import docs  # noqa: F401
from epipanel.llm.language_model import Trie, pack, score_texts, unpack

SF_DIR = "/root/testdata/sf0.01"


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), None]


def brute(rows, train, mu):
    uni, bi, ctx = {}, {}, {}
    for ident, text in rows:
        if train(ident):
            v = "<s>"
            for w in tokens(text):
                uni[w] = uni.get(w, 0) + 1
                bi[v, w] = bi.get((v, w), 0) + 1
                ctx[v] = ctx.get(v, 0) + 1
                v = w
    n, size = sum(uni.values()), len(uni)
    out = []
    for ident, text in rows:
        t = tokens(text)
        base = score = 0.0
        v = "<s>"
        for w in t:
            p1 = (uni.get(w, 0) + 1) / (n + size + 1)
            base += math.log10(p1)
            score += math.log10((bi.get((v, w), 0) + mu * p1) / (ctx.get(v, 0) + mu))
            v = w
        out.append((ident, not train(ident), len(t), sum(w in uni for w in t), n, base, score))
    return out


def compare(got, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    for g, w in zip(got, want):
        assert math.isclose(g[5], w[5], rel_tol=1e-9, abs_tol=1e-9)
        assert abs(g[6] - w[6]) <= w[2] * 0.5 / lm.STEPS + 1e-9  # quantisation


def test_query_matches_brute_force(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet'").fetchall()
    want = brute(rows, lambda i: zlib.crc32(str(i).encode()) % 7 != 2, lm.MU)
    got = lm.query(spark, SF_DIR).collect()
    compare(got, want)
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_many_blocks_shards_and_hot_contexts(docs, monkeypatch):
    monkeypatch.setattr(lm, "HOT", 20)
    rows = [(i, " ".join(f"w{(i * j) % (5 + i % 7)}" for j in range(i % 40))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (None, "w1 w2 É é"), (1002, "W1\tw2\nnew words"), (1003, "w1 w2 " * 5000), (5, "again"), (5, "again")]
    train = lambda i: i is not None and i % 3 != 0
    frame = docs(rows).withColumn("block", F.lit(1)).withColumn("train", F.lit("x")).withColumn("ident", F.lit(2))
    got = score_texts(frame, F.col("doc_id") % 3 != 0, mu=7.0, block_tokens=500, shard_tokens=700).collect()
    compare(got, brute(rows, train, 7.0))


def test_without_training_rows_and_without_rows(docs):
    got = score_texts(docs([(1, "a b"), (2, None)]), F.lit(False)).collect()
    assert {(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], abs(r["base_score"]), abs(r["score"])) for r in got} == {
        (1, 3, 0, 0, 0.0, 0.0), (2, 1, 0, 0, 0.0, 0.0),
    }
    assert score_texts(docs([]), F.lit(True)).collect() == []
    assert score_texts(docs([(1, "a")]), F.lit(None).cast("boolean")).count() == 1


def test_pack():
    for values in ([], [0, 0, 0], [5], [0, 255, 256, 2**40], [2**64 - 1, 0]):
        a = np.array(values, dtype=np.uint64)
        assert (unpack(pack(a), len(a)) == a).all() and len(unpack(pack(a), len(a))) == len(a)


def test_trie_sums_to_one(tmp_path):
    rng = np.random.default_rng(1)
    context = rng.integers(1, 50, 3000).astype(np.uint64) * np.uint64(10**17)
    follower = rng.integers(1, 300, 3000).astype(np.uint64) * np.uint64(10**9)
    none = np.zeros(0, dtype=np.uint64)
    trie = Trie.build(str(tmp_path), context, follower, np.ones(3000), none, none.astype(float), 3.0)
    assert isinstance(trie.masses, np.memmap)
    for c in np.unique(context):
        words = np.unique(follower)
        rank, weight, mass = trie.ask(np.array([c]), np.array([len(words)]), words)
        seen = 10.0 ** (-mass[mass != lm.ABSENT].astype(float) / lm.STEPS)
        assert abs(seen.sum() + 10.0 ** (-float(weight[0]) / lm.STEPS) - 1) < 1e-3
        own = set(follower[context == c].tolist())
        assert {w for w, m in zip(words.tolist(), mass.tolist()) if m != lm.ABSENT} == own
    rank, weight, mass = trie.ask(np.array([1], dtype=np.uint64), np.array([2]), words[:2])
    assert rank[0] == -1 and weight[0] == 0 and (mass == lm.ABSENT).all()


def test_too_many_contexts_in_a_shard_raise(tmp_path, monkeypatch):
    monkeypatch.setattr(lm, "FOLLOWER_BITS", 60)
    context = np.arange(1, 40, dtype=np.uint64)
    with pytest.raises(ValueError):
        Trie.build(str(tmp_path), context, context, np.ones(39), context[:0], np.zeros(0), 1.0)


def test_shards_are_ranges_of_the_hashes():
    hashes = np.sort(np.random.default_rng(2).integers(0, 2**64, 10_000, dtype=np.uint64))
    for shards in (1, 3, 1000, 2**31):
        home = lm.shard_of(hashes, shards)
        assert (np.diff(home) >= 0).all() and home[0] >= 0 and home[-1] < shards
    assert np.bincount(lm.shard_of(hashes, 4), minlength=4).min() > 2300


def test_a_block_sends_as_much_however_many_shards_there_are():
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 2**64, 300, dtype=np.uint64)[rng.integers(0, 300, 4000)]
    row = lm._block(5, [tokens], [(1, 3000, True), (2, 1000, False)])
    hot = np.array([lm.START], dtype=np.uint64)
    sizes = []
    for shards in (1000, 1_000_000, 1_000_000_000):
        parts = [r for b in lm._send_bigrams(shards, hot, np.array([0.001]))(iter([row])) for r in lm._rows([b])]
        words = [r for b in lm._send_words(shards)(iter([row])) for r in lm._rows([b])]
        assert sum(len(unpack(r["a"])) for r in words) == len(np.unique(tokens)) and len(words) <= 300
        asked = [r for r in parts if not r["kind"]]
        assert len({r["shard"] for r in asked}) == len(asked) <= 4000
        sizes.append(sum(len(r[c]) for r in parts if r["kind"] for c in "abcd"))
    assert max(sizes) < 3000  # the layout: of the block's words, not of the shards
