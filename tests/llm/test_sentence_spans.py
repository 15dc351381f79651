"""Sentence spans against a brute-force version."""

import random
import re

from pyspark.sql import functions as F

from llm_fixtures import docs  # noqa: F401
from epipanel.llm.sentence_spans import ENOUGH_WORDS, MIN_SENTENCES, MIN_WORDS, remove_repeated_spans, repeated_spans


def sentences(text):
    found = []
    words = [(m.start(), m.end()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    out = []
    for i, (s, e) in enumerate(words):
        found.append((s, e))
        last = i + 1 == len(words)
        if last or text[e - 1] in ".!?" or "\n" in text[e : words[i + 1][0]]:
            out.append(found)
            found = []
    return out


def runs(text):
    sents = sentences(text)
    low = lambda s, e: re.sub("[A-Z]", lambda m: m[0].lower(), text[s:e])
    out = []
    for i in range(len(sents)):
        for j in range(i + 1, len(sents) + 1):
            n = sum(map(len, sents[i:j]))
            if (j - i >= MIN_SENTENCES and n >= MIN_WORDS) or n >= ENOUGH_WORDS:
                out.append((i, j, tuple(tuple(low(*w) for w in s) for s in sents[i:j])))
    return sents, out


def brute(rows):
    """rows have distinct ids."""
    first = {}
    for ident, text in sorted(rows):
        for _, _, run in runs(text or "")[1]:
            first.setdefault(run, ident)
    out = []
    for ident, text in rows:
        sents, found = runs(text or "")
        covered, seen = {}, set()
        for i, j, run in found:
            if first[run] != ident or run in seen:
                for k in range(i, j):
                    covered[k] = min(covered.get(k, first[run]), first[run])
            seen.add(run)
        k = 0
        while k < len(sents):
            j = k
            while j in covered:
                j += 1
            if j > k:
                start, end = sents[k][0][0], sents[j - 1][-1][1]
                out.append((ident, min(covered[x] for x in range(k, j)), start, end - start, j - k, sum(map(len, sents[k:j]))))
            k = j + 1
    return sorted(out)


def got(frame):
    return sorted(tuple(r[c] for c in ("doc_id", "first_doc_id", "start", "length", "n_sentences", "n_words")) for r in frame.collect())


def corpus(seed=1, n=40):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdé", k=rng.randint(2, 6)))
    sentence = lambda: " ".join(word() for _ in range(rng.randint(1, 14))).capitalize() + rng.choice([". ", ".\n", "! ", "\n", "? "])
    passages = ["".join(sentence() for _ in range(8)) for _ in range(5)]
    giant = " ".join(word() for _ in range(60)) + ". "
    rows = []
    for i in range(n):
        parts = [sentence() for _ in range(rng.randint(0, 12))]
        for _ in range(rng.randint(0, 3)):
            parts.insert(rng.randint(0, len(parts)), rng.choice([*passages, giant, "And. Les. To. "]))
        rows.append((i * 7, "".join(parts)))
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(docs):
    rows = corpus() + [(1000, None), (1001, ""), (1002, "  \n "), (1003, "x."), (1004, "word " * 40_000)]
    frame = docs(rows).withColumn("run", F.lit(1)).withColumn("start", F.lit("x")).withColumn("hits", F.lit(0))
    want = brute(rows)
    assert len(want) > 20
    assert got(repeated_spans(frame)) == want


def test_cleaned_texts(docs):
    rows = corpus(2)
    frame = docs(rows).withColumn("first", F.lit("mine"))
    out = remove_repeated_spans(frame)
    assert out.columns == frame.columns
    want = dict(rows)
    for ident, _, start, length, _, _ in sorted(brute(rows), key=lambda r: (r[0], -r[2])):
        text = want[ident]
        want[ident] = text[:start] + text[start + length :].lstrip(" \t\n\x0b\x0c\r")
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want


def test_copies_keep_the_smallest_id(docs):
    text = "".join(f"Sentence number {i} has these seven words. " for i in range(5))
    rows = [(9, text), (4, text), (4, text), (None, text), (6, "Lead. " + text)]
    out = got(repeated_spans(docs(rows)).where("doc_id is not null"))
    assert [(r[0], r[1]) for r in out] == [(6, 4), (9, 4)]
    assert repeated_spans(docs(rows)).where("doc_id is null").first()["first_doc_id"] == 4
    assert {r["doc_id"]: r["text"] for r in remove_repeated_spans(docs(rows)).collect()}[6] == "Lead. "


def test_empty_table(docs):
    assert repeated_spans(docs([])).collect() == []
    assert remove_repeated_spans(docs([])).collect() == []
    assert remove_repeated_spans(docs([(1, None)])).first()["text"] is None
