"""Benchmark decontamination by latent semantic retrieval (operator 3).

1. Words of all documents are hashed to ``TERMS`` columns; the passage
   frequency of each column (passages of 32 words) is counted over the whole
   corpus and gives the IDF weights.
2. A randomised SVD of the TF-IDF passage matrix A gives ``RANK`` latent
   directions: each task sketches its passages as A'(A Omega) with one Gaussian
   Omega, the sketches are summed by blocks of columns on the cluster, and the
   singular values and vectors follow from the sum (single-pass Nystroem). The
   directions are fitted on a bounded sample of documents (``FIT_DOCUMENTS``);
   the columns, weights and the search cover every document.
3. Windows of about an item's length, eight words apart, of every document are
   folded in (V'x / sigma) and compared with the benchmark items by cosine.
4. Runs of windows at ``MIN_COSINE`` or more are verified on whole words, by the
   longest common subsequence of the item and pieces somewhat longer than it, from
   an item's length before the first window to one after the last: ``SAME`` of the item's words in order
   are contamination; from ``PARAPHRASE`` on it is one if the answer, the item's
   last sentence, is there as well (``ANSWER`` of its words in order).
5. Beside that, exact runs of item words are looked up in all documents: whole
   items from their first words, and items shorter than the smallest window
   from every ``SEED`` words, verified as in 4. Items of fewer than
   ``MIN_ITEM_WORDS`` words are looked up only whole.

The benchmark is the query set: it is stored in files of at most ``BLOCK_ITEMS``
items under the shared checkpoint folder, and never collected. One pass over the
documents searches all of it: a task holds a chunk of documents against one file of
items after the other. Nothing is shuffled but column counts, the sample and sketches.
"""

from __future__ import annotations

import os
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import col, fresh, narrow, table, tidy
from epipanel.llm.words import PUNCTUATION, Words, groups, run_hashes, words_of
from epipanel.session import shared_scratch_path

TERMS = 1 << 15
PASSAGE = 32
RANK, EXTRA = 96, 16
FIT_DOCUMENTS, FIT_TASKS = 10_000, 8
SKETCH_ROWS = 512  # columns of A in a block of the sketch
STRIDE = 8
SIZES = (2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256)  # window lengths, in strides; goes on like this
BLOCK_ITEMS = 4096
KEPT_BLOCKS = 4  # of items, held by a task; it reads more of them again for each chunk
CHUNK_BYTES = 16 << 20  # of documents, held against all items
SCORED_ITEMS = 256  # a matrix of cosines has so many rows
MIN_COSINE = 0.55
SAME, PARAPHRASE, ANSWER = 0.8, 0.65, 0.8
MIN_ITEM_WORDS = 8  # a shorter item is found only verbatim
SEED = 3  # of fewer than 16 words, SAME in order, three stand together unless words come between


def _words(texts: list[bytes]) -> Words:
    return words_of(texts, PUNCTUATION)


def _terms(words: Words) -> np.ndarray:
    return (words.hashes >> np.uint64(64 - TERMS.bit_length() + 1)).astype(np.int64)


def _rows_of(words: Words, terms: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's terms in rows of ``width``, filled with ``TERMS``; the first row of each text."""
    n = np.diff(words.bounds)
    first = np.concatenate(([0], np.cumsum(-(-n // width))))
    rows = np.full(int(first[-1]) * width, TERMS, dtype=np.int64)
    rows[np.arange(len(terms)) + np.repeat(first[:-1] * width - words.bounds[:-1], n)] = terms
    return rows.reshape(-1, width), first


def _firsts(rows: np.ndarray) -> np.ndarray:
    """In sorted rows, where a value stands for the first time."""
    out = np.ones(rows.shape, dtype=bool)
    out[:, 1:] = rows[:, 1:] != rows[:, :-1]
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages that hold each column; at ``TERMS`` all passages, at
    ``TERMS + 1`` the documents that are not empty."""
    counts = np.zeros(TERMS + 2, dtype=np.int64)
    for batch in batches:
        for _, group in groups(batch.column("body")):
            words = _words(group)
            rows = np.sort(_rows_of(words, _terms(words), PASSAGE)[0], axis=1)
            found = np.bincount(rows[_firsts(rows)], minlength=TERMS + 1)
            counts[:TERMS] += found[:TERMS]
            counts[TERMS] += len(rows)
            counts[TERMS + 1] += sum(len(text) > 0 for text in group)
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(counts[some])], names=["term", "n"])


def _omega(seed: int) -> np.ndarray:
    out = np.zeros((TERMS + 1, RANK + EXTRA), dtype=np.float32)
    out[:TERMS] = np.random.default_rng(seed).standard_normal((TERMS, RANK + EXTRA), dtype=np.float32)
    return out


def _sketch(idf: np.ndarray, seed: int):
    """A'(A Omega) of a task's passages, rows of A being unit TF-IDF vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ.setdefault("OMP_NUM_THREADS", "1")
        omega = _omega(seed)
        total = np.zeros((TERMS + 1, omega.shape[1]), dtype=np.float32)
        for batch in batches:
            for _, group in groups(batch.column("body")):
                words = _words(group)
                passages = _rows_of(words, _terms(words), PASSAGE)[0]
                for at in range(0, len(passages), 2000):
                    rows = np.sort(passages[at : at + 2000], axis=1)
                    places = np.flatnonzero(_firsts(rows).reshape(-1))
                    times = np.diff(np.append(places, rows.size))
                    term, passage = rows.reshape(-1)[places], places // PASSAGE
                    weight = (times * idf[term]).astype(np.float32)
                    norm = np.sqrt(np.bincount(passage, weight * weight, minlength=len(rows)))
                    weight /= np.maximum(norm, 1e-9)[passage].astype(np.float32)
                    folded = np.add.reduceat(omega[term] * weight[:, None], np.searchsorted(passage, np.arange(len(rows))), axis=0)
                    order = np.argsort(term, kind="stable")
                    used, first = np.unique(term[order], return_index=True)
                    total[used] += np.add.reduceat(folded[passage[order]] * weight[order][:, None], first, axis=0)
        for block in range(TERMS // SKETCH_ROWS):
            values = total[block * SKETCH_ROWS : (block + 1) * SKETCH_ROWS].tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([values], pa.binary())], names=["block", "part"])

    return run


def _sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, part in zip(batch.column("block").to_pylist(), batch.column("part").to_pylist()):
            values = np.frombuffer(part, dtype=np.float32).astype(np.float64)
            sums[block] = sums[block] + values if block in sums else values
    if sums:
        values = [v.astype(np.float32).tobytes() for v in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(values, pa.binary())], names=["block", "part"])


def fit_index(bodies: DataFrame, seed: int = 11) -> np.ndarray | None:
    """The latent vector of each column: IDF-weighted V / sigma, of shape
    (TERMS + 1, RANK); its last row, that of no word, is zero. Its size does
    not depend on the data. None for a corpus without words.

    It is fitted on the distinct rows whose hash (of all columns of ``bodies``) is small,
    about ``FIT_DOCUMENTS`` of them, however the rows are dealt to tasks."""
    counted = bodies.select("body").mapInArrow(tidy(_count), "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(TERMS + 2, dtype=np.float64)
    for row in counted:
        counts[row["term"]] = row["n"]
    if not counts[:TERMS].any():
        return None
    idf = np.zeros(TERMS + 1)
    idf[:TERMS] = np.log((counts[TERMS] + 1) / (counts[:TERMS] + 1))
    share = min(1.0, FIT_DOCUMENTS / counts[TERMS + 1])
    drawn = F.pmod(F.xxhash64(F.lit(seed), *bodies.columns), F.lit(1 << 40)) < int(share * (1 << 40))
    sample = bodies.where((F.octet_length("body") > 0) & drawn).distinct().repartition(FIT_TASKS)
    parts = sample.select("body").mapInArrow(tidy(_sketch(idf, seed)), "block int, part binary").repartition(FIT_TASKS, "block")
    omega = _omega(seed)[:TERMS].astype(np.float64)
    sketch = np.zeros_like(omega)
    for row in parts.mapInArrow(tidy(_sum_blocks), "block int, part binary").collect():
        at = row["block"] * SKETCH_ROWS
        sketch[at : at + SKETCH_ROWS] = np.frombuffer(row["part"], dtype=np.float32).reshape(SKETCH_ROWS, -1)
    core = omega.T @ sketch
    core = (core + core.T) / 2
    shift = 1e-6 * max(float(np.trace(core)) / len(core), 1e-12)
    root = np.linalg.cholesky(core + shift * np.eye(len(core)) * (1 + np.abs(min(0.0, np.linalg.eigvalsh(core)[0])) / shift * 2))
    directions, sigma, _ = np.linalg.svd(np.linalg.solve(root, sketch.T).T, full_matrices=False)
    out = np.zeros((TERMS + 1, RANK), dtype=np.float32)
    keep = sigma[:RANK] > 1e-4 * sigma[0]  # squared sigma would be lost in rounding below
    out[:TERMS, keep] = idf[:TERMS, None] * directions[:, :RANK][:, keep] / sigma[:RANK][keep]
    return out


def _size(n: int) -> int:
    """The window length nearest to ``n`` words, in strides."""
    sizes = list(SIZES)
    while sizes[-1] * STRIDE < n:
        sizes.append(2 * sizes[-2])
    return min(sizes, key=lambda s: abs(np.log(s * STRIDE / n)))


class Items:
    """A block of benchmark items: their words, answers and latent vectors."""

    def __init__(self, rows: list[tuple], vectors: np.ndarray) -> None:
        self.ids, self.words, self.answers, self.sizes, folded = [], [], [], [], []
        read = [(ident, body, _words([body])) for ident, body in ((i, (text or "").encode()) for i, text in rows)]
        short = lambda row: len(row[2].hashes) < MIN_ITEM_WORDS
        starts: dict[int, dict[int, list[int]]] = {}
        seeds: dict[int, list[tuple[int, int]]] = {}
        for ident, body, words in sorted((r for r in read if len(r[2].hashes)), key=short):  # short ones have no vectors
            n, item = len(words.hashes), len(self.ids)
            anchor = run_hashes(words.hashes, min(n, MIN_ITEM_WORDS))
            starts.setdefault(min(n, MIN_ITEM_WORDS), {}).setdefault(int(anchor[0]), []).append(item)
            if n < MIN_ITEM_WORDS:
                self.ids.append(ident)
                self.words.append(words.hashes.tolist())
                self.answers.append(self.words[-1])
                continue
            if n < SIZES[0] * STRIDE:
                for at, seed in enumerate(run_hashes(words.hashes, SEED).tolist()):
                    seeds.setdefault(seed, []).append((item, at))
            last = re.split(rb"[.!?\n]+", body.rstrip(b" \t\r\n.!?"))[-1]
            self.ids.append(ident)
            self.words.append(words.hashes.tolist())
            self.answers.append(_words([last]).hashes.tolist() or self.words[-1])
            self.sizes.append(_size(n))
            folded.append(vectors[_terms(words)].sum(axis=0))
        self.starts = {k: (np.array(sorted(which), dtype=np.uint64), which) for k, which in starts.items()}
        self.seeds = np.array(sorted(seeds), dtype=np.uint64), seeds
        self.vectors = _unit(np.array(folded, dtype=np.float32).reshape(-1, vectors.shape[1]))
        self.masks, self.answer_masks = [_masks(w) for w in self.words], [_masks(w) for w in self.answers]


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.sqrt(np.einsum("ij,ij->i", rows, rows)), 1e-9)[:, None]


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def common_subsequence(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence, one big-integer step a word."""
    full = (1 << size) - 1
    row = full
    for w in words:
        if mask := masks.get(w):
            both = row & mask
            row = ((row + both) | (row - both)) & full
    return size - row.bit_count()


def _wider(sums: dict[int, np.ndarray], size: int, last: np.ndarray) -> np.ndarray:
    """Sums of ``size`` rows from each row on, made of two smaller ones and kept
    in ``sums``; those of a text end with its last row (``last`` of each row)."""
    if size not in sums:
        half = 1 << (size - 1).bit_length() - 1
        a, b = _wider(sums, half, last), _wider(sums, size - half, last)
        sums[size] = a.copy()
        rows = np.arange(len(a))
        for at in range(0, len(a), 4096):
            more = rows[at : at + 4096][rows[at : at + 4096] + half <= last[at : at + 4096]]
            sums[size][more] += b[more + half]
    return sums[size]


def _candidates(
    stride_rows: np.ndarray, first: np.ndarray, vectors: np.ndarray, items: Items, min_cosine: float
) -> Iterator[tuple[int, int, int, float]]:
    """(first row of the first window, of the last, item, best cosine) of each
    run of neighbouring windows that reach the cosine."""
    rank = vectors.shape[1]
    sums = np.empty((len(stride_rows), rank), dtype=np.float32)
    for at in range(0, len(stride_rows), 1024):
        rows = stride_rows[at : at + 1024]
        part = vectors[rows[:, 0]]
        for j in range(1, STRIDE):
            part += vectors[rows[:, j]]
        sums[at : at + 1024] = part
    wider: dict[int, np.ndarray] = {1: sums}
    last = np.repeat(first[1:] - 1, np.diff(first))
    starts = np.zeros(len(stride_rows) + 1, dtype=bool)
    starts[first] = True  # a run of windows does not go on into the next text
    sizes = np.array(items.sizes)
    for size in np.unique(sizes):
        mine = np.flatnonzero(sizes == size)
        sums_here = _wider(wider, int(size), last)
        norm = np.sqrt(np.einsum("ij,ij->i", sums_here, sums_here))
        bar = np.maximum(norm, 1e-6) * np.float32(min_cosine)
        for at in range(0, len(mine), SCORED_ITEMS):
            part = mine[at : at + SCORED_ITEMS]
            score = items.vectors[part] @ sums_here.T
            for k in np.flatnonzero((score >= bar).any(axis=1)):
                hits = np.flatnonzero(score[k] >= bar)
                cosine = score[k][hits] / norm[hits]
                runs = np.flatnonzero((np.diff(hits, prepend=-2) > 1) | starts[hits])
                for a, b in zip(runs, [*runs[1:], len(hits)]):
                    yield int(hits[a]), int(hits[b - 1]), int(part[k]), float(cosine[a:b].max())


def _runs(words: Words, length: int, keys: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, first word, hash) of the runs of ``length`` words within a text whose hash is in ``keys``, which are sorted."""
    runs = run_hashes(words.hashes, length)
    if not len(keys) or not len(runs):
        return
    at = np.minimum(np.searchsorted(keys, runs), len(keys) - 1)
    places = np.flatnonzero(keys[at] == runs)
    texts = np.searchsorted(words.bounds, places, side="right") - 1
    for place, text in zip(places.tolist(), texts.tolist()):
        if place + length <= words.bounds[text + 1]:
            yield text, place, int(runs[place])


def _verbatim(words: Words, items: Items) -> Iterator[tuple[int, int, int]]:
    """(text, item, first word) of the first whole copy of each item in each text."""
    seen: set[tuple[int, int]] = set()
    for length, (keys, which) in items.starts.items():
        for text, place, run in _runs(words, length, keys):
            for item in which[run]:
                end = place + len(items.words[item])
                if (text, item) in seen or end > words.bounds[text + 1] or words.hashes[place:end].tolist() != items.words[item]:
                    continue
                seen.add((text, item))
                yield text, item, place


def _seeded(words: Words, items: Items) -> Iterator[tuple[int, int, int, int]]:
    """(text, item, start, end) of the places where an item of fewer words than
    the smallest window may stand, a stride wider on both sides."""
    keys, which = items.seeds
    seen: set[tuple[int, int, int]] = set()
    for text, place, run in _runs(words, SEED, keys):
        for item, at in which[run]:
            if (text, item, place - at) in seen:
                continue
            seen.add((text, item, place - at))
            begin, end = int(words.bounds[text]), int(words.bounds[text + 1])
            yield text, item, max(begin, place - at - STRIDE), min(end, place - at + len(items.words[item]) + STRIDE)


def _pieces(n: int, masks: dict[int, int], words: list[int]) -> Iterator[tuple[int, int, int]]:
    """(start, end, common subsequence) of pieces of ``words`` for an item of ``n``
    words: each stretch of up to 9/8 of its length is within one. Pieces with
    fewer of its words than ``PARAPHRASE`` demands are left out."""
    step, length = STRIDE + n // 8, n + n // 4 + 2 * STRIDE
    places = [i for i, w in enumerate(words) if w in masks]
    seen = (-1, -1)
    for start in range(0, max(0, len(words) - length) + step, step):
        inside = (bisect_left(places, start), bisect_left(places, start + length))
        if inside != seen and inside[1] - inside[0] >= PARAPHRASE * n:
            here = [words[i] for i in places[inside[0] : inside[1]]]
            yield start, min(start + length, len(words)), common_subsequence(masks, n, here)
        seen = inside


_FOUND = (
    "doc_id bigint, text_key bigint, item_id bigint, start_word int, n_words int, cosine double, lcs_share double, answer_share double"
)


def _matches(words: Words, vectors: np.ndarray, items: Items, min_cosine: float) -> dict[tuple[int, int], tuple]:
    """By text and item: share of the subsequence, cosine, first word, words and share of the answer, of the best window."""
    terms = _terms(words)
    stride_rows, first = _rows_of(words, terms, STRIDE)
    best: dict[tuple[int, int], tuple] = {}
    for text, item, place in _verbatim(words, items):
        best[text, item] = (1.0, 1.0, place - int(words.bounds[text]), len(items.words[item]), 1.0)
    for text, item, start, end in _seeded(words, items):
        here, size = words.hashes[start:end].tolist(), len(items.words[item])
        if sum(w in items.masks[item] for w in here) < PARAPHRASE * size:
            continue
        share = common_subsequence(items.masks[item], size, here) / size
        answer = len(items.answers[item])
        answer_share = common_subsequence(items.answer_masks[item], answer, here) / answer
        if share >= SAME or (share >= PARAPHRASE and answer_share >= ANSWER):
            window = _unit(vectors[terms[start:end]].sum(axis=0, keepdims=True))[0]
            found = (share, float(window @ items.vectors[item]), start - int(words.bounds[text]), end - start, answer_share)
            best[text, item] = max(best.get((text, item), (0,)), found)
    for row, last_row, item, cosine in _candidates(stride_rows, first, vectors, items, min_cosine):
        text = int(np.searchsorted(first, row, side="right")) - 1
        size, begin = len(items.words[item]), int(words.bounds[text])
        at_word = begin + (row - int(first[text])) * STRIDE
        start = max(begin, at_word - size)
        end = at_word + (last_row - row + items.sizes[item]) * STRIDE + size
        end = min(int(words.bounds[text + 1]), end)
        here = words.hashes[start:end].tolist()
        for a, b, common in _pieces(size, items.masks[item], here):
            share = common / size
            if share < PARAPHRASE:
                continue
            answer = len(items.answers[item])
            answer_share = common_subsequence(items.answer_masks[item], answer, here[a:b]) / answer
            if share < SAME and answer_share < ANSWER:
                continue
            found = (share, cosine, start + a - begin, b - a, answer_share)
            if found > best.get((text, item), (0,)):
                best[text, item] = found
    return best


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[list, list, Words]]]:
    """Lists of (ids, text keys, words) of groups of texts, of about ``CHUNK_BYTES`` together."""
    chunk, size = [], 0
    for batch in batches:
        idents, keys = batch.column("ident").to_pylist(), batch.column("text_key").to_pylist()
        for at, group in groups(batch.column("body")):
            chunk.append((idents[at : at + len(group)], keys[at : at + len(group)], _words(group)))
            size += sum(map(len, group))
            if size >= CHUNK_BYTES:
                yield chunk
                chunk, size = [], 0
    if chunk:
        yield chunk


def _read_items(file: str) -> list[tuple]:
    system, path = fs.FileSystem.from_uri(file)
    stored = pq.read_table(path, filesystem=system, columns=["item", "text"])
    return list(zip(stored["item"].to_pylist(), stored["text"].to_pylist()))


def _search(vectors: np.ndarray, files: list[str], min_cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = lru_cache(KEPT_BLOCKS)(lambda file: Items(_read_items(file), vectors))
        names = [c.split()[0] for c in _FOUND.split(", ")]
        kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.float64()] * 3
        for chunk in _chunks(batches):
            for file in files:
                items = load(file)
                out: list[tuple] = []
                for idents, keys, words in chunk if items.ids else ():
                    for (text, item), (share, cosine, start, n, answer_share) in _matches(words, vectors, items, min_cosine).items():
                        out.append((idents[text], keys[text], items.ids[item], start, n, cosine, share, answer_share))
                columns = list(zip(*out)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def _stored(items: DataFrame, count: int) -> list[str]:
    """The files of at most ``BLOCK_ITEMS`` rows that ``items`` is written to, a block of items each."""
    path = shared_scratch_path(items.sparkSession, "benchmark")
    dealt = items.repartition(-(-count // BLOCK_ITEMS))
    dealt.write.option("maxRecordsPerFile", BLOCK_ITEMS).parquet(path)
    return sorted(items.sparkSession.read.schema(items.schema).parquet(path).inputFiles())


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", min_cosine: float = MIN_COSINE,
) -> DataFrame:
    """One row per document and item it contains: ``doc_id, text_key, item_id,
    start_word, n_words, cosine, lcs_share, answer_share`` (best window).

    * null and empty texts contain nothing; null ids stay null; each repeated row is reported;
    * null items and items without words are not searched for, items of fewer than eight words only verbatim;
    * empty documents or an empty benchmark give no rows; other columns are ignored;
    * ``text_key`` is ``xxhash64`` of the text, to tell rows of one id apart.

    Counts, fits the index and stores the benchmark when called; the search is lazy.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = narrow(docs, ident=id_col, text=text_col).select(
        F.col("ident").cast("bigint").alias("ident"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("body")
    )
    items = narrow(benchmark, item=item_col, text=item_text_col).select(F.col("item").cast("bigint").alias("item"), "text")
    count = items.count()
    vectors = fit_index(rows.select("ident", "body")) if count else None
    if vectors is None:
        return rows.sparkSession.createDataFrame([], _FOUND)
    return rows.mapInArrow(tidy(_search(vectors, _stored(items, count), min_cosine)), _FOUND)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the documents that contain a benchmark item.

    Null and empty texts stay, as do rows whose id another, contaminated text has;
    repeated rows go together; null ids are matched like others. An empty benchmark
    drops nothing, an empty table gives no rows; all columns are kept, whatever their names.
    """
    drop_id, drop_key = fresh(docs, "drop_id", "drop_key")
    found = find_contamination(docs, benchmark, id_col, text_col)
    dropped = found.select(F.col("doc_id").alias(drop_id), F.col("text_key").alias(drop_key)).distinct()
    same = col(id_col).cast("bigint").eqNullSafe(F.col(drop_id)) & (
        F.xxhash64(F.coalesce(col(text_col), F.lit(""))) == F.col(drop_key)
    )
    return docs.join(dropped, same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")
