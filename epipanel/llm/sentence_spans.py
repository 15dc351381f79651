"""Substring deduplication by sliding sentence spans (operator 5).

A sentence ends with a word that ends in a full stop, question or exclamation
mark of any script (``_ENDS``; quotes and brackets may close after it), at a line
break, or with the text. One of more than ``enough_words`` words is cut into
pieces, which count as sentences do: after each word whose hash, taken with the
next word's, is the smallest of the ``AROUND`` before and after it. So a passage
is cut alike whatever stands around it. A run of consecutive sentences counts if it has at
least ``min_sentences`` sentences and ``min_words`` words, or at least
``enough_words`` words; hashed are the shortest from every sentence on and the
shortest up to every sentence. Runs are joined globally by hash; the first of
equal runs is that of the smallest document id, then the earliest in the text.
Sentences covered by any other run are removed.

A run depends only on its own sentences, so a passage gives the same runs in
every document. The shortest runs cover what all runs would: in a repeated run
from i to j, the shortest from i covers its sentences up to its end, and each
sentence after that ends a shortest run that starts at i or later.
A hash that many documents share is
counted before the shuffle, and the join back may be split where it is skewed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import col, fresh, narrow, table
from epipanel.llm.words import ROWS_AT_ONCE, Words, groups, span_hashes, words_of
from epipanel.session import write_scratch

MIN_SENTENCES, MIN_WORDS, ENOUGH_WORDS = 2, 20, 50
AROUND = 3  # words before and after a cut that its place depends on: pieces of seven words on average


def _codes(chars: str) -> np.ndarray:
    return np.array([int.from_bytes(c.encode(), "big") for c in chars])


_ENDS = _codes(".!?\u2026\u203c\u203d\u2047\u2048\u2049\u037e\u0589\u061f\u06d4\u0700\u0701\u0702\u0964\u0965\u0f0d\u0f0e\u104a\u104b\u1362\u1367\u1368\u166e\u17d4\u17d5\u1803\u1809\u3002\ufe52\ufe56\ufe57\uff01\uff0e\uff1f\uff61")
_CLOSERS = _codes("\"')]}*_`>\u00ab\u00bb\u2018\u2019\u201c\u201d\u201e\u2039\u203a\u300d\u300f\u3009\u300b\u3011\u3015\uff02\uff07\uff09\uff3d\uff5d\uff63")

_RUNS = (
    "ident bigint, text_key bigint, run_hash array<bigint>, run_first array<int>, run_last array<int>, "
    "sentence_start array<int>, sentence_end array<int>, sentence_words array<int>, sentence_no array<int>"
)
_NAMES = [c.split()[0] for c in _RUNS.split(", ")]


def _lists(offsets: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.astype(kind.to_pandas_dtype()), kind))


def _ends_sentence(words: Words) -> np.ndarray:
    """Whether the last character of each word, but for closing ones, ends a sentence."""
    data, end = words.data, words.ends.copy()
    out = np.zeros(len(end), dtype=bool)
    todo = np.arange(len(end))
    while len(todo):
        last, room = end[todo], end[todo] - words.starts[todo]
        a, b, c = (np.where(room >= k, data[np.maximum(last - k, 0)], 0).astype(np.int64) for k in (1, 2, 3))
        size = np.where(a < 128, 1, np.where(b >= 192, 2, 3))
        code = np.where(size == 1, a, np.where(size == 2, b << 8 | a, c << 16 | b << 8 | a))
        out[todo] = np.isin(code, _ENDS)
        closes = np.isin(code, _CLOSERS) & (room > size)
        end[todo] -= size
        todo = todo[closes]
    return out


def _cuts(words: Words, last_word: np.ndarray, longest: int) -> np.ndarray:
    """The words after which a sentence of more than ``longest`` words is cut."""
    size = np.diff(last_word, prepend=-1)
    long = np.flatnonzero(size > longest)
    places = np.concatenate([np.arange(last_word[k] + 1 - size[k], last_word[k]) for k in long] or [last_word[:0]])
    of = np.repeat(long, size[long] - 1)
    value = span_hashes(words.hashes, places, places + 2)
    least = np.ones(len(places), dtype=bool)
    for d in range(1, AROUND + 1):
        same = of[d:] == of[:-d]
        least[d:] &= same & (value[d:] < value[:-d])
        least[:d] = False
        least[:-d] &= same & (value[:-d] < value[d:])
        least[-d:] = False
    return places[least]


def sentence_runs(texts: list[bytes], min_sentences: int, min_words: int, enough_words: int) -> list[pa.Array]:
    """Per text the hashes, first and last sentences (or pieces) of its runs, the
    places (in characters) and word counts of its sentences, and which of them
    are pieces of one: those have the same number."""
    words = words_of(texts)
    data, n = words.data, len(words.starts)
    ends_text = np.zeros(n, dtype=bool)
    ends_text[words.bounds[1:][np.diff(words.bounds) > 0] - 1] = True
    lines = np.cumsum(data == 10)
    breaks = np.zeros(n, dtype=bool)
    if n:
        breaks[:-1] = lines[words.starts[1:] - 1] > lines[words.ends[:-1] - 1]
    whole_last = np.flatnonzero(ends_text | breaks | _ends_sentence(words))
    last_word = np.sort(np.concatenate((whole_last, _cuts(words, whole_last, enough_words))))
    number = np.searchsorted(whole_last, last_word)
    first_word = np.concatenate(([0], last_word[:-1] + 1)).astype(np.int64)[: len(last_word)]
    bounds = np.searchsorted(first_word, words.bounds)
    hashes = span_hashes(words.hashes, first_word, last_word + 1)
    total = np.concatenate((first_word, [n]))  # words before each sentence
    at = np.arange(len(last_word))
    reach = lambda k: np.searchsorted(total, first_word + k)  # noqa: E731  sentences before k words are there
    end = np.minimum(np.maximum(at + min_sentences, reach(min_words)), reach(enough_words))
    text_end = np.repeat(bounds[1:], np.diff(bounds))
    since = lambda k: np.searchsorted(total, total[1:] - k, side="right") - 1  # noqa: E731  last start of k words
    begin = np.maximum(np.minimum(at + 1 - min_sentences, since(min_words)), since(enough_words))
    # a run that is the shortest from its start as well is listed once
    back = np.flatnonzero((begin >= np.repeat(bounds[:-1], np.diff(bounds))) & (end[begin] != at + 1))
    whole = np.flatnonzero(end <= text_end)
    runs, run_end = np.concatenate((whole, begin[back])), np.concatenate((end[whole], back + 1))
    order = np.lexsort((run_end, runs))
    runs, run_end = runs[order], run_end[order]
    run_hash = span_hashes(hashes, runs, run_end).view(np.int64)
    run_bounds = np.searchsorted(runs, bounds)
    origin = np.repeat(bounds[:-1], np.diff(run_bounds))
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    text_char = np.repeat(chars[words.text_starts], np.diff(bounds))
    i32 = pa.int32()
    return [
        _lists(run_bounds, run_hash, pa.int64()),
        _lists(run_bounds, runs - origin, i32),
        _lists(run_bounds, run_end - 1 - origin, i32),
        _lists(bounds, chars[words.starts[first_word]] - text_char, i32),
        _lists(bounds, chars[words.ends[last_word]] - text_char, i32),
        _lists(bounds, last_word + 1 - first_word, i32),
        _lists(bounds, number - np.repeat(number[bounds[:-1][np.diff(bounds) > 0]], np.diff(bounds)[np.diff(bounds) > 0]), i32),
    ]


def _runs(min_sentences: int, min_words: int, enough_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in groups(batch.column("body")):
                rows = batch.slice(first, len(group))
                arrays = sentence_runs(group, min_sentences, min_words, enough_words)
                yield pa.RecordBatch.from_arrays([rows.column("ident"), rows.column("text_key"), *arrays], names=_NAMES)

    return run


_REMOVED = (
    "doc_id bigint, text_key bigint, first_doc_id bigint, start int, length int, n_sentences int, n_words int"
)


def _cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of sentences covered by runs that are not the first."""
    names = [c.split()[0] for c in _REMOVED.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32()]
    # a document has hundreds of runs: few documents at a time as Python objects
    for batch in (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE)):
        out: list[tuple] = []
        for row in batch.to_pylist():
            elsewhere = {hit["run"]: hit["first"] for hit in row["hits"] or ()}
            owner: list = [None] * len(row["sentence_start"])
            covered = [False] * len(owner)
            seen: set[int] = set()
            for h, a, b in zip(row["run_hash"], row["run_first"], row["run_last"]):
                if h in elsewhere or h in seen:
                    first = elsewhere.get(h, row["ident"])
                    for i in range(a, b + 1):
                        covered[i] = True
                        owner[i] = first if owner[i] is None or (first is not None and first < owner[i]) else owner[i]
                seen.add(h)
            i = 0
            while i < len(covered):
                j = i
                while j < len(covered) and covered[j]:
                    j += 1
                if j > i:
                    start = row["sentence_start"][i]
                    known = [o for o in owner[i:j] if o is not None]
                    out.append((
                        row["ident"], row["text_key"], min(known) if known else None, start,
                        row["sentence_end"][j - 1] - start, row["sentence_no"][j - 1] - row["sentence_no"][i] + 1,
                        sum(row["sentence_words"][i:j]),
                    ))
                i = j + 1
        columns = list(zip(*out)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_sentences: int = MIN_SENTENCES,
    min_words: int = MIN_WORDS, enough_words: int = ENOUGH_WORDS,
) -> DataFrame:
    """What is to be removed, one row per stretch: ``doc_id, text_key,
    first_doc_id, start, length`` (in characters), ``n_sentences, n_words``.

    * null and empty texts, and texts too short for a run, lose nothing;
    * rows that share an id count as one document: what repeats only
      between them stays, as does what they hold first; null ids likewise are
      one document, the last in order. ``text_key`` (xxhash64) tells rows of one id apart;
    * a run that repeats within a text is removed from its second place on;
    * an empty table gives no rows; other columns are ignored, whatever their names.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = narrow(docs, ident=id_col, text=text_col).select(
        F.col("ident").cast("bigint").alias("ident"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("body")
    )
    runs = write_scratch(rows.mapInArrow(_runs(min_sentences, min_words, enough_words), _RUNS), "sentence-runs")
    # a run's hash once per row; repeats within the row are found in the row
    listed = runs.select("ident", "text_key", F.explode(F.array_distinct("run_hash")).alias("run"))
    shared = listed.groupBy("run").agg(F.min("ident").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # stored, so that either side of the join has a shuffle of its own and Spark may
    # split the rows of a run that very many documents share
    shared = write_scratch(shared, "shared-runs")
    hits = listed.join(shared, "run").where(~F.col("ident").eqNullSafe(F.col("first")))
    # by row, not by id: all rows without an id would be one group
    hits = hits.groupBy(F.col("ident").alias("of"), F.col("text_key").alias("of_key")).agg(F.collect_set(F.struct("run", "first")).alias("hits"))
    repeats = F.size("run_hash") > F.size(F.array_distinct("run_hash"))
    mine = F.col("ident").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("of_key"))
    joined = runs.join(hits, mine, "left").where(F.col("hits").isNotNull() | repeats)
    return joined.drop("of", "of_key").mapInArrow(_cover, _REMOVED)


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the repeated stretches and the white space after each.
    A null text stays null; all rows and other columns are kept."""
    own, cut_id, cut_key = fresh(docs, "cuts", "cut_id", "cut_key")
    cuts = repeated_spans(docs, id_col, text_col).groupBy(F.col("doc_id").alias(cut_id), F.col("text_key").alias(cut_key)).agg(
        F.sort_array(F.collect_set(F.struct("start", "length"))).alias(own)
    )
    text = col(text_col)
    mine = col(id_col).cast("bigint").eqNullSafe(F.col(cut_id)) & (
        F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(cut_key)
    )
    joined = docs.join(cuts, mine, "left")
    # what stands between the cuts: from the end of one to the start of the next
    end = lambda c: c["start"] + c["length"]
    kept = F.transform(
        own,
        lambda c, i: F.concat(
            F.when(i == 0, F.substr(text, F.lit(1), c["start"])).otherwise(""),
            F.ltrim(
                F.substr(text, end(c) + 1, F.coalesce(F.get(own, i + 1)["start"], F.length(text)) - end(c)),
                F.lit(" \t\n\x0b\x0c\r"),
            ),
        ),
    )
    cleaned = F.when(F.col(own).isNull(), text).otherwise(F.array_join(kept, ""))
    return joined.select(*[cleaned.alias(c) if c == text_col else col(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_spans(table(spark, sf_dir, "documents")).drop("text_key")
