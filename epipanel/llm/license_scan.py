r"""Licence scan by a positional rare-token index (operator 4): Spark expressions only.

Templates are licence notices as word lists; some of their phrases are
mandatory. Document frequencies of all licence words are counted over the whole
corpus. Each template is indexed under the highest-IDF word of its mandatory
phrases, and every occurrence of such a word in a file is looked up. The
postings of the template's other words are then intersected at their
relative positions; where their IDF-weighted share is at least ``min_share``
and every mandatory phrase stands in its place, the template is found there.

A template cannot be found without its mandatory phrases, hence not without
their rarest word, so the lookup loses no place. All of it happens inside the
row of the file: nothing but the licence words' document counts is shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import ascii_lower, narrow, table

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# label, notice, mandatory phrases; the first three are the base phrases
TEMPLATES = [
    ("cc-by", "cc by", ["cc by"]),
    ("gpl", "general public license", ["general public license"]),
    ("reserved", "all rights reserved", ["all rights reserved"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("mit", "released under the mit license", ["mit license"]),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ["permission is hereby granted free of charge", "a copy of this software"],
    ),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    (
        "gpl-2.0-or-later",
        "either version 2 of the license or at your option any later version",
        ["version 2 of the license", "any later version"],
    ),
    ("lgpl", "licensed under the gnu lesser general public license", ["lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license", ["affero general public license"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ["cc by nd 4 0"]),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ["redistribution and use in source and binary forms", "with or without modification"],
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ["permission to use copy modify", "with or without fee"],
    ),
    (
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ["mozilla public license v 2 0"],
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ["free and unencumbered software", "public domain"],
    ),
]
N_BASE = 3
MIN_SHARE = 0.6


def licence_words(text: Column) -> Column:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z
    lower-cased. ``lower`` gives the same words, and is faster, unless the text
    holds one of the two other characters whose lower case has an ASCII letter."""
    text = F.coalesce(text, F.lit(""))
    odd = F.contains(text, F.lit("\u0130")) | F.contains(text, F.lit("\u212a"))
    lowered = F.when(odd, ascii_lower(text)).otherwise(F.lower(text))
    return F.array_remove(F.split(lowered, BETWEEN_WORDS), "")


def _phrase_places(notice: list[str], phrase: list[str]) -> int:
    return next(i for i in range(len(notice)) if notice[i : i + len(phrase)] == phrase)


def postings(templates=TEMPLATES) -> list[list[tuple[int, str, bool]]]:
    """For each template its (position, word, mandatory) entries."""
    out = []
    for _, notice, phrases in templates:
        words = notice.split()
        must: set[int] = set()
        for phrase in (p.split() for p in phrases):
            at = _phrase_places(words, phrase)
            must.update(range(at, at + len(phrase)))
        out.append([(i, w, i in must) for i, w in enumerate(words)])
    return out


def licence_word_weights(words: DataFrame, templates=TEMPLATES) -> dict[str, int]:
    """IDF, in thousandths and at least 1, of each licence word over all rows
    of ``words`` (one ``words`` array a row). Only the counts of the licence
    words, a list fixed by the templates, come to the driver."""
    vocabulary = sorted({w for entries in postings(templates) for _, w, _ in entries})
    found = F.array_append(F.array_intersect("words", F.array(*map(F.lit, vocabulary))), F.lit(""))  # "": the row itself
    counts = {r["word"]: r["n"] for r in words.select(F.explode(found).alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()}
    rows = counts.get("", 0)
    return {w: math.floor(1000 * math.log((rows + 1) / (counts.get(w, 0) + 1))) + 1 for w in vocabulary}


def scan_licences(
    docs: DataFrame, templates=TEMPLATES, n_base: int = N_BASE, min_share: float = MIN_SHARE,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, found``; ``found`` lists
    every place of a template as ``(label, base, start, share)``, by template
    order and start; ``base`` marks the first ``n_base`` templates.

    Null and empty texts have no words and no places; repeated rows are each
    reported; null ids stay null; other columns are ignored. Counts the
    licence words first (one job over all rows) when it is called.
    """
    words = narrow(docs, doc_id=id_col, text=text_col).select("doc_id", licence_words(F.col("text")).alias("words"))
    idf = licence_word_weights(words, templates)
    index: dict[str, list[Column]] = {}
    notices = []
    for number, ((label, _, _), entries) in enumerate(zip(templates, postings(templates))):
        rare = max((e for e in entries if e[2]), key=lambda e: (idf[e[1]], -e[0]))
        index.setdefault(rare[1], []).append(F.struct(F.lit(number).alias("t"), F.lit(rare[0]).alias("at")))
        notices.append(
            F.struct(
                F.lit(label).alias("label"),
                F.lit(number < n_base).alias("base"),
                F.lit(sum(idf[w] for _, w, _ in entries)).alias("total"),
                F.array(
                    *[
                        F.struct(F.lit(i).alias("at"), F.lit(w).alias("word"), F.lit(must).alias("must"), F.lit(idf[w]).alias("idf"))
                        for i, w, must in entries
                    ]
                ).alias("entries"),
            )
        )
    rare_words = F.array(*map(F.lit, index))
    lookup = F.create_map(*[c for w, places in index.items() for c in (F.lit(w), F.array(*places))])
    all_notices = F.array(*notices)

    word = lambda i: F.get("words", i)
    hits = F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: word(i).isin(*index))
    looked_up = words.select(
        "doc_id", "words", F.when(F.arrays_overlap("words", rare_words), hits).otherwise(F.array().cast("array<int>")).alias("hits")
    )
    starts = looked_up.select(
        "doc_id",
        "words",
        F.array_sort(
            F.flatten(
                F.transform(
                    "hits",
                    lambda i: F.transform(
                        F.element_at(lookup, word(i)), lambda p: F.struct(p["t"].alias("t"), (i - p["at"]).alias("start"))
                    ),
                )
            )
        ).alias("starts"),
    )

    def meet(place: Column) -> Column:
        """The template's postings against the file's words, from this start."""
        notice = F.element_at(all_notices, place["t"] + 1)
        there = lambda e: word(place["start"] + e["at"]).eqNullSafe(e["word"])
        held = F.aggregate(notice["entries"], F.lit(0), lambda n, e: n + F.when(there(e), e["idf"]).otherwise(0))
        return F.struct(
            notice["label"].alias("label"),
            notice["base"].alias("base"),
            place["start"].alias("start"),
            (held / notice["total"]).alias("share"),
            F.forall(notice["entries"], lambda e: ~e["must"] | there(e)).alias("verified"),
        )

    met = F.transform(F.filter("starts", lambda p: p["start"] >= 0), meet)
    kept = F.filter(met, lambda m: m["verified"] & (m["share"] >= min_share))
    return starts.select("doc_id", F.size("words").cast("bigint").alias("n_words"), kept.alias("found"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licences(table(spark, sf_dir, "documents"))
    base = found.select("*", F.filter("found", lambda p: p["base"]).alias("places"))
    labels = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return base.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(F.transform("places", lambda p: p["start"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("places", lambda p: p["start"])).cast("bigint").alias("last_word"),
        labels(F.col("places")).alias("base_labels"),
        labels(F.col("found")).alias("labels"),
        F.round(F.coalesce(F.array_max(F.transform("found", lambda p: p["share"])), F.lit(0.0)), 6).alias("score"),
    )


def _oracle() -> str:
    entries = ", ".join(
        f"({t}, '{label}', {str(t < N_BASE).lower()}, {at}, '{word}', {str(must).lower()})"
        for t, ((label, _, _), rows) in enumerate(zip(TEMPLATES, postings()))
        for at, word, must in rows
    )
    return rf"""
WITH files AS (
  SELECT row_number() OVER () AS file, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), entries(t, label, base, spot, word, must) AS (VALUES {entries}),
tokens AS (
  SELECT file, unnest(words) AS word, generate_subscripts(words, 1) - 1 AS place FROM files
), rare AS (
  SELECT e.word, floor(1000 * ln(((SELECT count(*) FROM files) + 1) / (count(DISTINCT k.file) + 1))) + 1 AS idf
  FROM (SELECT DISTINCT word FROM entries) e LEFT JOIN tokens k ON k.word = e.word GROUP BY e.word
), notices AS (
  SELECT t, any_value(label) AS label, any_value(base) AS base, sum(idf) AS total, count(*) FILTER (must) AS musts
  FROM entries JOIN rare USING (word) GROUP BY t
), met AS (
  SELECT file, t, place - spot AS start, sum(idf) AS held, count(*) FILTER (must) AS musts
  FROM tokens JOIN entries USING (word) JOIN rare USING (word) WHERE place >= spot GROUP BY file, t, place - spot
), found AS (
  SELECT met.file, label, base, start, held / total AS share FROM met JOIN notices USING (t)
  WHERE met.musts = notices.musts AND held / total >= {MIN_SHARE}
)
SELECT any_value(doc_id) AS doc_id, any_value(len(words)) AS n_words, count(*) FILTER (base) AS n_base,
       min(start) FILTER (base) AS first_word, max(start) FILTER (base) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels, round(coalesce(max(share), 0.0), 6) AS score
FROM files LEFT JOIN found USING (file) GROUP BY file
"""


ORACLE_SQL = _oracle()
