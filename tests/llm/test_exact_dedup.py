"""Exact dedup: fixtures, brute force, spilling."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from llm_fixtures import docs  # noqa: F401
from epipanel.llm.exact_dedup import RadixTrie, SpillingOwners, drop_exact_duplicates, exact_owners


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept = False
        for i in ids:
            first = i == keep and not kept
            kept |= first
            out.append((i, keep, len(ids), first, sha))
    return sorted(out, key=str)


def got(df):
    cols = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


ROWS = [
    (5, "a b"), (3, "a \t\n b"), (3, "a  b"), (9, None), (8, ""), (7, " "), (2, "\n\n"), (None, "a b"), (None, "only null"),
    (11, "ab"), (12, "abc"), (13, "abd"), (14, "é\x0bé"), (15, "é é"), (16, "x" * 200_000), (17, "x" * 200_000 + "y"),
    (4, "same"), (4, "same"), (4, "other"),
]


def test_matches_brute_force(docs):
    assert got(exact_owners(docs(ROWS))) == brute(ROWS)


def test_spilling_gives_the_same_owners(docs):
    assert got(exact_owners(docs(ROWS), budget=300)) == brute(ROWS)
    random.seed(3)
    keys = [bytes(random.choices(b"ab", k=random.randint(0, 6))) for _ in range(500)]
    small, large = SpillingOwners(200), SpillingOwners(10**9)
    for n, key in enumerate(keys):
        small.add(key, n, 1, 1)
        large.add(key, n, 1, 1)
    assert sorted(small.results()) == sorted(large.results())
    assert {k: v[0] for k, v in large.results()} == {k: keys.index(k) for k in set(keys)}


def test_trie_splits_edges_at_any_byte():
    trie = RadixTrie()
    for n, key in enumerate([b"abcd", b"abxy", b"ab", b"", b"abcd", b"z"]):
        trie.insert(key, n, 1, 1)
    assert dict(trie.terminals()) == {b"abcd": [0, 1, 2], b"abxy": [1, 1, 1], b"ab": [2, 1, 1], b"": [3, 1, 1], b"z": [5, 1, 1]}


def test_kept_rows_keep_all_columns(docs):
    frame = docs(ROWS).withColumn("sha", F.lit("mine")).withColumn("keep_id", F.lit(1)).withColumn("kept", F.lit("no"))
    out = drop_exact_duplicates(frame)
    assert out.columns == frame.columns
    kept = sorted(str(r["doc_id"]) for r in out.collect())
    assert kept == sorted(str(r[0]) for r in brute(ROWS) if r[3])
    assert got(exact_owners(frame)) == brute(ROWS)


def test_empty_table(docs):
    assert exact_owners(docs([])).collect() == []
    assert drop_exact_duplicates(docs([])).collect() == []


def test_hot_text_reaches_its_owner_once_per_task(docs):
    rows = [(i, "hot text") for i in range(900)] + [(1000 + i, f"t{i}") for i in range(100)]
    assert got(exact_owners(docs(rows, 8))) == brute(rows)
