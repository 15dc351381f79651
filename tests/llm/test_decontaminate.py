"""Decontamination: recall against brute force, paraphrases, clean documents."""

import random
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from epipanel.llm import decontaminate
from llm_fixtures import docs  # noqa: F401
from epipanel.llm.decontaminate import common_subsequence, drop_contaminated, find_contamination, fit_index, _masks

SF_DIR = "/root/testdata/sf0.01"


def read(name, columns):
    return duckdb.sql(f"SELECT {columns} FROM '{SF_DIR}/{name}.parquet'").fetchall()


def plain(text):
    return " " + " ".join(re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())) + " "


def test_query_finds_every_verbatim_item_and_nothing_else(spark):
    texts = [(i, plain(t)) for i, t in read("documents", "doc_id, text")]
    want = {(i, j) for j, x in read("benchmark", "item_id, text") for i, t in texts if plain(x) in t}
    rows = decontaminate.query(spark, SF_DIR).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == want and len(rows) == len(want)


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    docs = read("documents", "doc_id, text")[:400]
    items = read("benchmark", "item_id, text")
    clean = {i for i, t in docs if not any(plain(x) in plain(t) for _, x in items)}
    planted = {}
    rows = []
    words = [w for _, t in docs[:50] for w in t.split()]
    for i, text in docs:
        if i in clean and i % 2:
            item, body = rng.choice(items)
            new = body.split()
            answer = len(re.split(r"[.!?\n]+", body.strip(" .!?\n"))[-1].split())
            for k in rng.sample(range(len(new) - answer), min(len(new) - answer, len(new) // 6)):
                new[k] = rng.choice(words)  # about a sixth of the words differ, the answer is left
            parts = text.split("\n")
            parts.insert(rng.randint(0, len(parts)), " ".join(new))
            text = "\n".join(parts)
            planted[i] = item
        rows.append((i, text))
    return rows, items, planted, clean


def test_recall_of_paraphrases_and_clean_documents(spark, docs, corpus):
    rows, items, planted, clean = corpus
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in find_contamination(docs(rows), bench).collect()}
    caught = [p in found for p in planted.items()]
    assert sum(caught) / len(caught) >= 0.9
    untouched = clean - set(planted)
    assert not [p for p in found if p[0] in untouched]
    kept = {r["doc_id"] for r in drop_contaminated(docs(rows), bench).select("doc_id").collect()}
    assert kept >= untouched and not kept & {i for i, _ in found}


def test_index_recall_against_brute_force(spark, docs, corpus):
    """Of the pairs of document and item that brute force verifies, at least 0.9 are found."""
    rows, items, planted, _ = corpus
    rows = [r for r in rows if r[0] in planted][:60]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = {(r["doc_id"], r["item_id"]) for r in find_contamination(docs(rows), bench).collect()}
    want = set()
    for item, body in items:
        query = plain(body).split()
        masks = _masks([hash(w) for w in query])
        for i, text in rows:
            w = [hash(x) for x in plain(text).split()]
            for at in range(0, max(1, len(w) - len(query) + 9), 8):
                if common_subsequence(masks, len(query), w[at : at + len(query) + 16]) / len(query) >= decontaminate.SAME:
                    want.add((i, item))
                    break
    assert len(want) >= 40
    assert len(want & found) / len(want) >= 0.9


def test_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randint(1, 20))] for _ in range(2))
        best = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + 1 if x == y else max(best[i, j + 1], best[i + 1, j])
        assert common_subsequence(_masks(a), len(a), b) == best[-1, -1]


def test_edge_cases(spark, docs):
    item = "one two three four five six seven eight nine ten eleven twelve. The answer is here"
    others = [(100 + i, " ".join(random.Random(i).choices([f"w{k}" for k in range(400)], k=60))) for i in range(60)]
    rows = [(1, item), (1, item), (2, None), (3, ""), (None, "x. " + item.upper()), (4, "lead " * 30_000 + item), (5, "The answer is here"), *others]
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "w1 w2"), (None, item + " again")], "item_id bigint, text string")
    frame = docs(rows).withColumn("item_id", F.lit(5)).withColumn("body", F.lit("x")).withColumn("text_key", F.lit(1))
    out = find_contamination(frame, bench.withColumn("doc_id", F.lit(1))).collect()
    assert sorted(str(r["doc_id"]) for r in out if r["item_id"] == 7) == ["1", "1", "4", "None"]
    kept = drop_contaminated(frame, bench)
    assert kept.columns == frame.columns
    assert {r["doc_id"] for r in kept.collect()} == {2, 3, 5, *(i for i, _ in others)}


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([(7, "a b c d e f g h i j")], "item_id bigint, text string")
    assert find_contamination(docs([]), bench).collect() == []
    assert find_contamination(docs([(1, "a b c d e f g h i j")]), bench.limit(0)).collect() == []
    assert find_contamination(docs([(1, None)]), bench).collect() == []
    assert fit_index(docs([]).selectExpr("cast(text as binary) body")) is None
    assert [r["doc_id"] for r in find_contamination(docs([(1, "a b c d e f g h i j")]), bench).collect()] in ([], [1])


def test_several_blocks_of_items(spark, docs, corpus, monkeypatch):
    rows, items, _, _ = corpus
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    whole = {(r["doc_id"], r["item_id"]) for r in find_contamination(docs(rows[:80]), bench).collect()}
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 6)  # more blocks than a task keeps
    frame = find_contamination(docs(rows[:80]), bench)
    assert whole and whole == {(r["doc_id"], r["item_id"]) for r in frame.collect()}


def test_a_large_benchmark_takes_one_pass(spark, docs, corpus):
    rows, items, _, _ = corpus
    rng = random.Random(5)
    names = [f"q{i}" for i in range(3000)]
    more = [(10_000 + i, " ".join(rng.choices(names, k=24))) for i in range(20_000)]
    more += [(-1, more[0][1])] * 2  # repeated items are reported each
    frame = docs(rows[:80] + [(9_999_999, "Lead. " + more[0][1])]).coalesce(2)
    found = find_contamination(frame, spark.createDataFrame(items + more, "item_id bigint, text string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and "Union" not in plan
    got = sorted((r["doc_id"], r["item_id"]) for r in found.collect())
    few = find_contamination(frame, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert got == sorted([(r["doc_id"], r["item_id"]) for r in few] + [(9_999_999, -1)] * 2 + [(9_999_999, 10_000)])


def test_the_sample_does_not_depend_on_the_partitions(spark, docs, monkeypatch):
    monkeypatch.setattr(decontaminate, "FIT_DOCUMENTS", 100)
    bodies = docs(read("documents", "doc_id, text")[:600]).selectExpr("doc_id", "cast(text as binary) body")
    one, other = fit_index(bodies.repartition(7)), fit_index(bodies.orderBy("body"))
    assert np.allclose(np.abs(one), np.abs(other), rtol=1e-2, atol=1e-2 * np.abs(one).max())
