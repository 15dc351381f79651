"""N-gram Jaccard join against all pairs by brute force."""

import random
import re

import numpy as np
from pyspark.sql import functions as F

from epipanel.llm.groups import connected_components
from llm_fixtures import docs  # noqa: F401
from epipanel.llm.ngram_jaccard import HASHES, STEP, drop_near_duplicates, minhash, near_duplicates, needed_matches


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    n = len(rows)
    linked = [[j for j in range(n) if j != i and sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])] for i in range(n)]
    out = []
    for i in range(n):
        seen, stack = {i}, [i]
        while stack:
            for j in linked[stack.pop()]:
                if j not in seen:
                    seen.add(j)
                    stack.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        out.append((rows[i][0], min(ids) if ids else None, len(linked[i])))
    return sorted(out, key=str)


def got(frame):
    return sorted(((r["doc_id"], r["class_id"], r["n_links"]) for r in frame.collect()), key=str)


def corpus(seed, families, members, length=120):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 5)))
    passage = " ".join(word() for _ in range(30))
    rows = []
    for f in range(families):
        base = [word() for _ in range(length)]
        for m in range(members):
            text = list(base)
            for _ in range(m % 7):
                text[rng.randrange(length)] = word()
            rows.append((len(rows) * 3 + 1, " ".join(text) + ("\n" + passage if f % 2 else "")))
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(docs):
    rows = corpus(1, 12, 6)
    rows += [(1000, rows[0][1].upper()), (1001, rows[0][1].replace(" ", " \n")), (1002, None), (1003, ""), (1004, " \t"), (1005, "one two"), (1006, "One  two")]
    rows += [(1007, "one two three"), (None, rows[3][1]), (None, "alone without id but with words"), (5000, rows[5][1]), (5000, rows[5][1])]
    frame = docs(rows).withColumn("node", F.lit("x")).withColumn("class_id", F.lit(0)).withColumn("sig", F.lit(0))
    want = brute(rows)
    assert got(near_duplicates(frame)) == want
    kept = drop_near_duplicates(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(i) for i, c, _ in want if i == c)


def test_large_buckets_in_blocks(docs):
    rows = corpus(2, 1, 90, 60) + [(100_000 + i, t) for i, t in corpus(3, 2, 3)]
    assert got(near_duplicates(docs(rows), block=8)) == brute(rows)


def test_empty_table_and_no_pairs(docs):
    assert near_duplicates(docs([])).collect() == []
    assert got(near_duplicates(docs([(1, "a b c d e f"), (2, "g h i j k l")]))) == [(1, 1, 0), (2, 2, 0)]


def test_long_texts(docs):
    rng = random.Random(5)
    base = [str(rng.randrange(10**6)) for _ in range(30_000)]
    near = list(base)
    near[100] = near[20_000] = "x"
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base[:15_000]))]
    assert got(near_duplicates(docs(rows))) == brute(rows)


def test_posterior_keeps_pairs_at_the_threshold():
    needed = needed_matches()
    assert len(needed) == HASHES // STEP and all(b >= a for a, b in zip(needed, needed[1:]))
    rng = np.random.default_rng(1)
    hits = rng.random((200_000, HASHES)) < 0.8
    counts = np.cumsum(hits, axis=1)[:, STEP - 1 :: STEP]
    assert (counts < np.array(needed)).any(axis=1).mean() < 1e-4
    low = np.cumsum(rng.random((20_000, HASHES)) < 0.4, axis=1)[:, STEP - 1 :: STEP]
    assert (low < np.array(needed)).any(axis=1).mean() > 0.9


def test_minhash_estimates_jaccard():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 9000, dtype=np.uint64)
    a, b = pool[:8000], pool[1000:]
    assert abs((minhash(a) == minhash(b)).mean() - 7 / 9) < 0.15


def test_connected_components(spark):
    rng = random.Random(4)
    chain = [(i, i + 1) for i in range(40)]
    star = [(1000, 1000 + i) for i in range(1, 60)]
    loose = [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    edges = chain + star + loose + [(1, 1)]
    out = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}
    find = lambda x: x if parent.setdefault(x, x) == x else find(parent[x])
    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    assert out == {x: find(x) for x in parent}


def test_regular_patterns_are_not_near_duplicates(docs):
    pattern = lambda a, b: "".join(b if bin(i).count("1") % 2 else a for i in range(1024))
    rows = near_duplicates(docs([(1, pattern("a", "b")), (2, pattern("b", "a"))])).collect()
    assert {(r["doc_id"], r["class_id"], r["n_links"]) for r in rows} == {(1, 1, 0), (2, 2, 0)}
