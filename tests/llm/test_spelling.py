"""Spelling variants against all pairs of words."""

import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from llm_fixtures import docs  # noqa: F401
from epipanel.llm.spelling import boundaries, corpus_words, near_words, spelling_groups


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def pairs(words):
    return sorted((a, b, words[b]) for a in words for b in words if one_edit(a, b))


def table(spark, words):
    return spark.createDataFrame(list(words.items()), "word string, n bigint").repartition(3)


def test_near_words_are_all_pairs(spark):
    rng = random.Random(6)
    words = {}
    for _ in range(60):
        base = "".join(rng.choices("abàÀé", k=rng.choice([1, 2, 3, 5, 6, 9, 13, 17, 40])))
        words[base] = rng.randint(3, 40)
        for _ in range(rng.randint(0, 4)):
            at = rng.randrange(len(base) + 1)
            changed = base[:at] + rng.choice(["", "b", "é"]) + base[at + rng.randint(0, 1) :]
            if changed:
                words[changed] = rng.randint(3, 40)
    want = pairs(words)
    assert len(want) > 100 and any(len(a) > 30 for a, _, _ in want)
    assert sorted(map(tuple, near_words(table(spark, words)).collect())) == want


def test_the_edit_at_every_place(spark):
    for size in (5, 14, 31):
        base = "".join(chr(97 + i % 26) for i in range(size))
        words = {base: 9}
        for i in range(size):
            words |= {base[:i] + base[i + 1 :]: 3, base[:i] + "Ü" + base[i:]: 3, base[:i] + "Ü" + base[i + 1 :]: 3}
        words[base + "Ü"] = 3
        found = {r["near"] for r in near_words(table(spark, words)).where(F.col("word") == base).collect()}
        assert found == set(words) - {base}


def test_levels_grow_with_the_logarithm_of_the_length():
    assert boundaries(0) == [0] and boundaries(3) == [0, 1, 2, 3]
    assert len(boundaries(1_000_000)) < 70 and boundaries(1_000_000)[-1] >= 1_000_000


def test_forms_and_roots(spark):
    words = {"colour": 40, "color": 90, "colou": 3, "colouur": 20, "xolouur": 4, "alone": 7, "stone": 8, "stoné": 4, "store": 8}
    got = {r["word"]: tuple(r)[1:] for r in spelling_groups(table(spark, words)).collect()}
    assert got["xolouur"] == ("colouur", "color", 4, 1, 20)  # colouur -> colour -> color
    assert got["colour"] == ("color", "color", 40, 3, 90)
    assert got["color"] == (None, "color", 90, 2, None)
    assert got["stoné"] == ("stone", "stone", 4, 1, 8)
    assert got["alone"] == (None, "alone", 7, 0, None)
    assert got["stone"] == (None, "stone", 8, 2, None)


def test_ties_take_the_first_in_code_point_order(spark):
    words = {"hoàse": 3, "house": 9, "horse": 9, "hoÀse": 9}
    got = {r["word"]: r["form"] for r in spelling_groups(table(spark, words)).collect()}
    assert got["hoàse"] == "horse"


def plain_words(rows):
    found = Counter()
    for ident, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'null' if ident is None else ident}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def test_corpus_words(docs):
    rng = random.Random(8)
    vocabulary = ["".join(rng.choices("abcÀéŁZzK", k=rng.randint(3, 8))) for _ in range(40)]
    rows = [(i, " ".join(rng.choices(vocabulary, k=30)) + "1x ") for i in range(150)]
    rows += [(500, None), (501, ""), (None, "sample sample sample"), (502, "q" * 3000 + " " + "q" * 3000 + " " + "q" * 3000), (503, "again " * 5000)]
    rows += [(504, "twice twice")] * 2
    frame = docs(rows).withColumn("run", F.lit(1)).withColumn("word", F.lit("x")).withColumn("ident", F.lit(1))
    assert {r["word"]: r["n"] for r in corpus_words(frame).collect()} == plain_words(rows)


def test_empty(spark, docs):
    assert corpus_words(docs([])).collect() == []
    none = spark.createDataFrame([], "word string, n bigint")
    assert near_words(none).collect() == [] and spelling_groups(none).collect() == []
    assert spelling_groups(table(spark, {"alone": 3})).collect()[0]["root"] == "alone"
