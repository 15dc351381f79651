"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from llm_fixtures import docs  # noqa: F401
from epipanel.llm.importance import bucket_counts, bucket_gains, importance_resample, importance_weights
from epipanel.llm.ngram_table import Bytes, NgramTable, ngram_tables, xxh64

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    raw = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    words = WORD.findall(raw)
    grams = [b" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), grams


def counts(texts):
    return Counter(zlib.crc32(g) % 10_000 for t in texts for g in features(t)[1])


def plain(rows, target):
    s, t = counts([x for _, x in rows]), counts(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000))))
    out = []
    for ident, text in rows:
        n_words, grams = features(text)
        weight = sum(gain(zlib.crc32(g) % 10_000) for g in grams)
        h = int(hashlib.sha256(f"42:{'null' if ident is None else ident}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([ident, len(grams), weight, score, None, n_words])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for i, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in out), key=str)


def corpus(seed=4, n=260):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdéXYZ9", k=rng.randint(1, 9))) for _ in range(60)]
    between = [" ", "  ", ", ", "\n", "-", ". "]
    text = lambda k: "".join(rng.choice(vocabulary) + rng.choice(between) for _ in range(k))
    rows = [(i, text(rng.randint(0, 60))) for i in range(n)]
    rows += [(900, None), (901, ""), (902, " .,; "), (903, "word"), (904, "z" * 9000 + " " + "y" * 5000 + " end"), (None, text(30))]
    long = ["u" * 63, "v" * 64, "w" * 65, "é" * 33, "x" * 200]
    rows += [(907, " ".join(rng.choices([*long, "a", "bc"], k=60)))]
    rows += [(905, "same words again " * 9)] * 2 + [(906, text(3000))]
    return rows, [text(25) for _ in range(6)] + [None, ""]


def test_matches_a_plain_version(spark, docs):
    rows, target = corpus()
    frame = docs(rows).withColumn("weight", F.lit(1)).withColumn("rank", F.lit("x")).withColumn("before", F.lit(0))
    found = importance_resample(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    got = sorted((tuple(r) for r in found.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)
    assert got == plain(rows, target)
    assert sum(r[4] is not None for r in got) >= 5


def test_rows_dealt_out_otherwise_give_the_same(spark, docs):
    rows, target = corpus(5, 60)
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    first = {tuple(r) for r in importance_resample(docs(rows, 1), wanted).collect()}
    assert first == {tuple(r) for r in importance_resample(docs(rows, 7), wanted).collect()}


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert importance_resample(docs([]), none).collect() == []
    one = importance_resample(docs([(1, None)]), none).first()
    assert (one["n_features"], one["weight"], one["rank"]) == (0, 0, None)
    gains = bucket_gains(bucket_counts(none), bucket_counts(none))
    assert importance_weights(docs([(1, "a b")]), gains).first()["n_features"] == 3


def test_vector_hash_is_xxhash64():
    rng = random.Random(3)
    blob = bytes(rng.randrange(256) for _ in range(20_000))
    sizes = [0, 1, 3, 4, 7, 8, 9, 12, 15, 16, 31, 32, 33, 40, 63, 64, 65, 100, 5000]
    start = np.array([rng.randrange(10_000) for _ in range(2000)])
    size = np.array([rng.choice(sizes) for _ in range(2000)])
    got = xxh64(Bytes(np.frombuffer(blob, dtype=np.uint8)), start, size)
    assert got.tolist() == [xxhash.xxh64_intdigest(blob[a : a + n]) for a, n in zip(start.tolist(), size.tolist())]


@pytest.mark.parametrize("equal_hashes", [False, True])
def test_bytes_decide_even_if_hashes_are_equal(monkeypatch, equal_hashes):
    if equal_hashes:
        monkeypatch.setattr("epipanel.llm.ngram_table.xxh64", lambda text, start, size: np.full(len(start), 7, dtype=np.uint64))
    data = b"abcabdabcab"
    start, size = np.array([0, 3, 6, 9, 0]), np.array([3, 3, 3, 2, 2])
    table = NgramTable(Bytes(np.frombuffer(data, dtype=np.uint8)), start, size, 10_000)
    grams = [data[a : a + n] for a, n in zip(start.tolist(), size.tolist())]
    assert len(set(table.slots.tolist())) == len(set(grams)) == 3
    assert table.bucket[table.slots].tolist() == [zlib.crc32(g) % 10_000 for g in grams]
    assert table.count[table.slots].tolist() == [2, 1, 2, 2, 2]


def test_parts_of_a_long_text_hold_every_ngram(monkeypatch):
    monkeypatch.setattr("epipanel.llm.ngram_table.WORDS_AT_ONCE", 7)
    text = " ".join(f"w{i % 11}" for i in range(100)).encode()
    total, parts = np.zeros(10_000, dtype=np.int64), 0
    for _, grams, owner in ngram_tables([text, b"", b"a b"], 10_000):
        total += grams.bucket_counts(10_000)
        parts += 1
    want = counts([text.decode(), "a b"])
    assert parts > 10 and {b: n for b, n in enumerate(total.tolist()) if n} == dict(want)
