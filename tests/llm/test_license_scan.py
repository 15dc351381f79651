"""Licence scan against a plain scan of every position."""

import re

from pyspark.sql import functions as F

from llm_fixtures import docs  # noqa: F401
from epipanel.llm.license_scan import MIN_SHARE, N_BASE, TEMPLATES, licence_word_weights, licence_words, postings, scan_licences

ROWS = [
    (1, "CC BY-NC 4.0, Licensed under CC BY-NC 4.0!"), (2, None), (3, ""), (4, "all rights reserved all Rights\nreserved"),
    (5, "x " * 30_000 + "This work is licensed under the GNU General Public License, version 3. tail"), (6, "general public general public license"),
    (7, "Released under the MIT License. mit license"), (7, "Released under the MIT License. mit license"), (None, "cc by cc by"),
    (8, "apache license version 2 0"), (9, "écc by cc byé CC_BY"), (10, "license license license"),
    (11, "permission is hereby granted free of charge to all a copy of this software"), (12, "nothing here"), (14, "\u212a MIT License \u0130cc by"), (15, "ÉCC by CC\u212ay all rights reserved\x00"),
    (13, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and its documentation files"),
]


def brute(rows, idf):
    out = []
    for i, text in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        found = []
        for t, ((label, _, _), entries) in enumerate(zip(TEMPLATES, postings())):
            for start in range(len(words)):
                there = [start + at < len(words) and words[start + at] == w for at, w, _ in entries]
                share = sum(idf[w] for ok, (_, w, _) in zip(there, entries) if ok) / sum(idf[w] for _, w, _ in entries)
                if share >= MIN_SHARE and all(ok or not must for ok, (_, _, must) in zip(there, entries)):
                    found.append((label, t < N_BASE, start, round(share, 9)))
        out.append((i, len(words), found))
    return sorted(out, key=str)


def got(frame):
    rows = frame.collect()
    return sorted(((r["doc_id"], r["n_words"], [(p["label"], p["base"], p["start"], round(p["share"], 9)) for p in r["found"]]) for r in rows), key=str)


def test_matches_a_scan_of_every_position(docs):
    frame = docs(ROWS).withColumn("words", F.lit("clash")).withColumn("found", F.lit(1)).withColumn("hits", F.lit(0))
    idf = licence_word_weights(frame.select(licence_words(F.col("text")).alias("words")))
    assert idf["license"] < idf["mozilla"]
    want = brute(ROWS, idf)
    assert got(scan_licences(frame)) == want
    assert any(len(found) >= 2 for _, _, found in want)


def test_empty_table(docs):
    assert scan_licences(docs([])).collect() == []


def test_no_python_in_the_plan(docs):
    plan = scan_licences(docs(ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
