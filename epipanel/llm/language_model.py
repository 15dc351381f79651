r"""N-gram language model in an Elias-Fano trie (operator 1).

Tokens are words (``words``), then one end per text. The model is a bigram
model with Dirichlet smoothing over an add-one unigram model:

    p(w | v) = c(v, w) / (C(v) + mu) + mu / (C(v) + mu) * p1(w)
    p1(w)    = (c(w) + 1) / (N + V + 1)

which sums to 1 over the V known words and one unknown word.

The trie has two levels. Level one holds the contexts' hashes, the weight of
the unigram model after each, and monotone pointers to its followers; level two holds
each context's followers, made monotone by the context's rank in front of their
hash, and the quantised smoothed probabilities (the first summand; 1/2048 of a
decimal digit). Both levels and the pointers are Elias-Fano sequences in
memory-mapped files; a bigram is found by a successor search for its context,
then one for its follower within the context's range.

Nothing of the model is bounded, sampled or held in one place. Texts are cut
into blocks of about ``BLOCK_TOKENS`` tokens and written once. Each block sends its
distinct words, then its distinct bigrams, to shards by hash and gets one
number back for each; how often texts share a word or a bigram therefore
does not matter. What a block sends and keeps grows with its own words only: it
has parts for the shards its words lie in, and no list of all shards. The shuffles
have as many partitions as there are shards and blocks. A shard is a trie of its own, built and asked in one task. Contexts
that make up over 1 / 65536 of the training tokens, of which there can be
65536 at most, are dealt over several shards by their followers, in proportion
to their count.
"""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import crc_bucket, narrow, table
from epipanel.llm.elias_fano import EliasFano
from epipanel.llm.groups import grouped
from epipanel.llm.words import groups, words_of
from epipanel.session import write_scratch

BLOCK_TOKENS = 1 << 20
SHARD_TOKENS = 1 << 20
SHARDS_PER_TASK = 2  # evens out what hashing the shards to tasks does not
BLOCKS_PER_TASK = 2
HOT = 1 << 16
MU = 200.0
FOLLOWER_BITS = 40  # of a follower's hash; contexts of a shard have the other 24 bits
STEPS = 2048.0  # quantisation steps per decimal digit
ABSENT = 0xFFFF
END = np.uint64(0x0123456789ABCDEF)
START = np.uint64(0xFFFFFFFFFFFFFFFF)


def pack(values: np.ndarray) -> bytes:
    """Unsigned integers by byte planes, as many as the largest needs, compressed."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = (int(values.max()).bit_length() + 7) // 8 if len(values) else 0
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, n: int | None = None) -> np.ndarray:
    """What was packed; ``n`` is needed only where all values may be zero."""
    width = data[0]
    if not width:
        return np.zeros(n or 0, dtype=np.uint64)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), dtype=np.uint8)
    out[:, :width] = planes.T
    return out.view("<u8").reshape(-1)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each hash (of at most 2**32); grows with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _stretches(shard: np.ndarray) -> list[tuple[int, int, int]]:
    """(shard, start, end) of the stretches of a sorted array; only of shards that occur."""
    first = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    return list(zip(shard[first].tolist(), first, [*first[1:], len(shard)]))


def _quantise(p: np.ndarray) -> np.ndarray:
    return np.minimum(np.rint(-np.log10(np.maximum(p, 1e-31)) * STEPS), ABSENT - 1).astype(np.uint64)


# ---- blocks of tokens -------------------------------------------------------

_BLOCK = "block bigint, idents array<bigint>, lens array<int>, train array<boolean>, n_train bigint, n_tokens bigint, vocab binary, tokens binary"


def _blocks(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        parts: list[np.ndarray] = []
        rows: list[tuple] = []
        size = 0
        for batch in batches:
            idents, train = batch.column("ident").to_pylist(), batch.column("train").to_pylist()
            for first, group in groups(batch.column("body")):
                words = words_of(group)
                n = np.diff(words.bounds) + 1
                tokens = np.full(len(words.hashes) + len(group), END, dtype=np.uint64)
                tokens[np.arange(len(words.hashes)) + np.repeat(np.arange(len(group)), n - 1)] = words.hashes
                parts.append(tokens)
                rows += zip(idents[first : first + len(group)], n.tolist(), train[first : first + len(group)])
                size += len(tokens)
                if size >= limit:
                    yield _block(task << 32 | number, parts, rows)
                    parts, rows, size, number = [], [], 0, number + 1
        if rows:
            yield _block(task << 32 | number, parts, rows)

    return run


def _block(block: int, parts: list[np.ndarray], rows: list[tuple]) -> pa.RecordBatch:
    vocab, tokens = np.unique(np.concatenate(parts), return_inverse=True)
    idents, lens, train = zip(*rows)
    n_train = sum(n for n, t in zip(lens, train) if t)
    kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.bool_()), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    cells = [block, idents, lens, train, n_train, len(tokens), pack(vocab), pack(tokens)]
    names = [c.split()[0] for c in _BLOCK.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([c], k) for c, k in zip(cells, kinds)], names=names)


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time, since each may be large."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(name)[i].as_py() for name in batch.schema.names}


# ---- unigrams ---------------------------------------------------------------

_PARTS = "shard int, kind int, block bigint, a binary, b binary, c binary, d binary"


def _part(shard: int, kind: int, block: int, *cells: bytes | None) -> pa.RecordBatch:
    cells = (*cells, *[None] * (4 - len(cells)))
    arrays = [pa.array([shard], pa.int32()), pa.array([kind], pa.int32()), pa.array([block], pa.int64())]
    arrays += [pa.array([c], pa.binary()) for c in cells]
    return pa.RecordBatch.from_arrays(arrays, names=["shard", "kind", "block", "a", "b", "c", "d"])


def _in_training(row: dict) -> np.ndarray:
    return np.repeat(np.array(row["train"], dtype=bool), row["lens"])


def _send_words(shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            vocab = unpack(row["vocab"])
            tokens = unpack(row["tokens"], row["n_tokens"]).astype(np.int64)
            counts = np.bincount(tokens[_in_training(row)], minlength=len(vocab))
            for s, a, b in _stretches(shard_of(vocab, shards)):
                yield _part(s, 0, row["block"], pack(vocab[a:b]), pack(counts[a:b]))

    return run


def _total_words(hot_count: float):
    """Per block the training counts of its words; per shard (kind 1) the
    number of its training words and the hot ones with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["shard"]):
            rows = list(_rows([group]))
            words = [unpack(r["a"]) for r in rows]
            sent = [unpack(r["b"], len(w)) for r, w in zip(rows, words)]
            known, place = np.unique(np.concatenate(words), return_inverse=True)
            totals = np.bincount(place, weights=np.concatenate(sent).astype(np.float64)).astype(np.uint64)
            at = 0
            for r, w in zip(rows, words):
                yield _part(r["shard"], 0, r["block"], pack(totals[place[at : at + len(w)]]), pack(np.array([len(w)])))
                at += len(w)
            hot = totals >= max(hot_count, 1)
            yield _part(rows[0]["shard"], 1, -1, pack(np.array([(totals > 0).sum()])), pack(known[hot]), pack(totals[hot]))

    return run


# ---- bigrams ----------------------------------------------------------------


class Bigrams:
    """The distinct bigrams of a block, and the shard of each.

    A bigram goes to the shard of its context's hash; that of a hot context
    to one of the ``spread`` shards from ``turn`` on, by its follower's hash.
    ``home`` is the shard of each word of the block. The last entries of ``turn`` and ``spread`` are those of the start of a text."""

    def __init__(
        self, tokens: np.ndarray, lens: list[int], home: np.ndarray, shards: int, hot: np.ndarray, turn: np.ndarray, spread: np.ndarray
    ) -> None:
        size = len(home)  # words of the block; the start is context number size
        previous = np.empty_like(tokens)
        previous[1:] = tokens[:-1]
        previous[np.cumsum([0, *lens[:-1]])] = size
        distinct, self.place = np.unique(previous * (size + 1) + tokens, return_inverse=True)
        context, follower = distinct // (size + 1), distinct % (size + 1)
        first, over = np.append(home, 0), np.ones(size + 1, dtype=np.int64)
        hot = np.append(hot, size)
        first[hot], over[hot] = turn, spread
        shard = (first[context] + home[follower] * over[context] // shards) % shards
        self.order = np.argsort(shard, kind="stable")
        self.context, self.follower = context[self.order], follower[self.order]
        self.stretches = _stretches(shard[self.order])

    def slices(self) -> Iterator[tuple[int, slice, np.ndarray, np.ndarray]]:
        """(shard, its bigrams, its contexts, followers per context)."""
        for s, a, b in self.stretches:
            first = np.flatnonzero(np.diff(self.context[a:b], prepend=-1))
            yield s, slice(a, b), self.context[a:b][first], np.diff([*first, b - a])


def _send_bigrams(shards: int, hot_words: np.ndarray, hot_share: np.ndarray):
    """``hot_share``: the part of the training tokens that follow each hot word."""
    spreads = np.clip(np.ceil(4 * shards * hot_share), 1, shards).astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            vocab = unpack(row["vocab"])
            tokens = unpack(row["tokens"], row["n_tokens"]).astype(np.int64)
            home = shard_of(vocab, shards)
            known = _lookup(hot_words, vocab)
            hot = np.flatnonzero(known >= 0)
            spread = spreads[np.append(known[hot], _lookup(hot_words, np.array([START])))]
            turn = np.append((vocab[hot] % np.uint64(shards)).astype(np.int64), 0)
            bigrams = Bigrams(tokens, row["lens"], home, shards, hot, turn, spread)
            counts = np.bincount(bigrams.place, weights=_in_training(row), minlength=len(bigrams.order))[bigrams.order]
            hashes = np.append(vocab, START)
            for s, part, contexts, followers in bigrams.slices():
                follower = vocab[bigrams.follower[part]] >> np.uint64(64 - FOLLOWER_BITS)
                yield _part(s, 0, row["block"], pack(hashes[contexts]), pack(followers), pack(follower), pack(counts[part]))
            layout = (pack(np.diff(home, prepend=0)), pack(hot), pack(np.concatenate((turn, spread))), pack(np.array([len(hot)])))
            yield _part(row["block"] % shards, 1, row["block"], *layout)

    return run


class Trie:
    """The two levels of a shard, in memory-mapped files of ``folder``."""

    def __init__(self, folder: str) -> None:
        self.contexts = EliasFano.open(folder, "contexts")
        self.pointers = EliasFano.open(folder, "pointers")
        self.followers = EliasFano.open(folder, "followers")
        self.weights = np.load(f"{folder}/weights.npy", mmap_mode="r")
        self.masses = np.load(f"{folder}/masses.npy", mmap_mode="r")

    @classmethod
    def build(cls, folder: str, context: np.ndarray, follower: np.ndarray, count: np.ndarray, hot: np.ndarray, hot_totals: np.ndarray, mu: float):
        """From bigrams in any order, repeats included; ``hot`` contexts have their totals given."""
        contexts, rank = np.unique(context, return_inverse=True)
        if len(contexts) >> 64 - FOLLOWER_BITS - 1:
            raise ValueError("too many contexts in a shard: make SHARD_TOKENS smaller")
        keys, place = np.unique(rank.astype(np.uint64) << np.uint64(FOLLOWER_BITS) | follower, return_inverse=True)
        counts = np.bincount(place, weights=count.astype(np.float64), minlength=len(keys))
        owner = (keys >> np.uint64(FOLLOWER_BITS)).astype(np.int64)
        totals = np.bincount(owner, weights=counts, minlength=len(contexts))
        known = _lookup(hot, contexts)
        totals = np.where(known >= 0, hot_totals[known] if len(hot) else 0, totals)
        EliasFano.build(contexts).save(folder, "contexts")
        EliasFano.build(np.searchsorted(owner, np.arange(len(contexts) + 1)).astype(np.uint64)).save(folder, "pointers")
        EliasFano.build(keys).save(folder, "followers")
        np.save(f"{folder}/weights.npy", _quantise(mu / (totals + mu)).astype(np.uint16))
        np.save(f"{folder}/masses.npy", _quantise(counts / (totals[owner] + mu)).astype(np.uint16))
        return cls(folder)

    def ask(self, contexts: np.ndarray, per_context: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rank and weight of each context (-1, 0 where absent), mass of each bigram."""
        rank = self.contexts.find(contexts)
        weight = np.where(rank >= 0, self.weights[np.maximum(rank, 0)] if len(self.weights) else 0, 0).astype(np.uint64)
        mass = np.full(len(follower), ABSENT, dtype=np.uint64)
        there = np.flatnonzero(rank >= 0)
        if len(there):
            least, most = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
            least[there] = self.pointers.get(rank[there]).astype(np.int64)
            most[there] = self.pointers.get(rank[there] + 1).astype(np.int64)
            of = np.repeat(np.arange(len(contexts)), per_context)
            asked = np.flatnonzero(rank[of] >= 0)
            of = of[asked]
            key = rank[of].astype(np.uint64) << np.uint64(FOLLOWER_BITS) | follower[asked]
            found = self.followers.find(key, least[of], most[of])
            hit = found >= 0
            mass[asked[hit]] = self.masses[found[hit]]
        return rank, weight, mass


def _lookup(known: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """Places in the sorted array ``known``, or -1."""
    if not len(known):
        return np.full(len(asked), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return np.where(known[at] == asked, at, -1)


def _answer_bigrams(hot: np.ndarray, hot_totals: np.ndarray, mu: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["shard"]):
            asked, context, follower, count = [], [], [], []
            for r in _rows([group]):
                if r["kind"]:
                    yield _part(r["shard"], 1, r["block"], r["a"], r["b"], r["c"], r["d"])
                    continue
                contexts, per = unpack(r["a"]), unpack(r["b"]).astype(np.int64)
                followers = unpack(r["c"], int(per.sum()))
                counts = unpack(r["d"], len(followers))
                asked.append((r["block"], contexts, per, followers))
                seen = counts > 0
                context.append(np.repeat(contexts, per)[seen])
                follower.append(followers[seen])
                count.append(counts[seen])
            if not asked:
                continue
            shard = group.column("shard")[0].as_py()
            folder = tempfile.mkdtemp(prefix="trie-")
            try:
                trie = Trie.build(folder, *map(np.concatenate, (context, follower, count)), hot, hot_totals, mu)
                del context, follower, count
                for block, contexts, per, followers in asked:
                    rank, weight, mass = trie.ask(contexts, per, followers)
                    known = _lookup(hot, contexts)
                    elsewhere = (rank < 0) & (known >= 0)  # hot, but with no follower in this shard
                    if elsewhere.any():
                        weight[elsewhere] = _quantise(mu / (hot_totals[known[elsewhere]] + mu))
                    yield _part(shard, 0, block, pack(weight), pack(mass), pack(np.array([len(weight), len(mass)])))
            finally:
                shutil.rmtree(folder, ignore_errors=True)

    return run


# ---- scores -----------------------------------------------------------------

_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double"


def _score(n: int, v: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            tokens = unpack(row["tokens"], row["n_tokens"]).astype(np.int64)
            words = [unpack(p["a"], int(unpack(p["b"])[0])) for p in sorted(row["words"], key=lambda p: p["shard"])]
            counts = np.concatenate(words).astype(np.float64)
            p1 = (counts + 1) / (n + v + 1)
            layout = next(p for p in row["answers"] if p["kind"])
            n_hot = int(unpack(layout["d"], 1)[0])
            home, hot, dealt = (unpack(layout[c], k).astype(np.int64) for c, k in (("a", len(counts)), ("b", n_hot), ("c", 2 * n_hot + 2)))
            bigrams = Bigrams(tokens, row["lens"], np.cumsum(home), shards, hot, *np.split(dealt, 2))
            answers = {p["shard"]: p for p in row["answers"] if not p["kind"]}
            logp = np.empty(len(bigrams.order))
            for s, part, _, followers in bigrams.slices():
                a = answers[s]
                n_weight, n_mass = unpack(a["c"]).tolist()
                weight, mass = unpack(a["a"], n_weight).astype(np.float64), unpack(a["b"], n_mass)
                seen = np.where(mass == ABSENT, 0.0, 10.0 ** (-mass.astype(np.float64) / STEPS))
                p = seen + np.repeat(10.0 ** (-weight / STEPS), followers) * p1[bigrams.follower[part]]
                logp[bigrams.order[part]] = np.log10(p)
            starts = np.cumsum([0, *row["lens"][:-1]])
            arrays = [
                pa.array(row["idents"], pa.int64()),
                pa.array([not t for t in row["train"]], pa.bool_()),
                pa.array(row["lens"], pa.int64()),
                pa.array(np.add.reduceat((counts > 0).astype(np.int64)[tokens], starts)),
                pa.array(np.add.reduceat(np.log10(p1)[tokens], starts)),
                pa.array(np.add.reduceat(logp[bigrams.place], starts)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=[c.split()[0] for c in _SCORES.split(", ")])

    return run


def score_texts(
    docs: DataFrame, train: Column, id_col: str = "doc_id", text_col: str = "text", mu: float = MU,
    block_tokens: int = BLOCK_TOKENS, shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score`` (log10 probabilities of the whole text).

    The model learns from the rows where ``train`` (over the columns of
    ``docs``) holds; null counts as false.

    * null and empty texts are one end token; null ids stay null; repeated
      rows are trained on and scored each;
    * without training rows p1 is 1 and all scores are 0; an empty table gives no rows;
    * other columns are ignored, whatever their names.

    Counts words when called; blocks and word counts are written to the shared checkpoint folder.
    """
    marked = docs.withColumn("__train", F.coalesce(train, F.lit(False)))
    rows = narrow(marked, ident=id_col, text=text_col, train="__train").select(
        F.col("ident").cast("bigint").alias("ident"), F.coalesce("text", F.lit("")).cast("binary").alias("body"), "train"
    )
    blocks = write_scratch(rows.mapInArrow(_blocks(block_tokens), _BLOCK), "token-blocks")
    sizes = blocks.agg(F.coalesce(F.sum("n_train"), F.lit(0)), F.coalesce(F.sum("n_tokens"), F.lit(0)), F.count("*")).first()
    n, shards = int(sizes[0]), max(1, -(-int(sizes[1]) // shard_tokens))

    sent = blocks.select("block", "lens", "train", "n_tokens", "vocab", "tokens")
    tasks = -(-shards // SHARDS_PER_TASK)
    by_shard = lambda parts: parts.repartition(tasks, "shard").sortWithinPartitions("shard")
    words = write_scratch(by_shard(sent.mapInArrow(_send_words(shards), _PARTS)).mapInArrow(_total_words(n / HOT), _PARTS), "word-totals")
    v, hot, hot_totals = 0, [], []
    for r in words.where("kind = 1").select("a", "b", "c").collect():
        v += int(unpack(r["a"], 1)[0])
        hot.append(unpack(r["b"]))
        hot_totals.append(unpack(r["c"]))
    trained = rows.where("train").count()
    hot = np.concatenate([*hot, np.array([START], dtype=np.uint64)])
    hot_totals = np.concatenate([*hot_totals, np.array([trained], dtype=np.uint64)]).astype(np.float64)
    order = np.argsort(hot)
    hot, hot_totals = hot[order], hot_totals[order]

    answers = by_shard(sent.mapInArrow(_send_bigrams(shards, hot, hot_totals / max(n, 1)), _PARTS)).mapInArrow(_answer_bigrams(hot, hot_totals, mu), _PARTS)
    by_block = lambda parts: parts.repartition(max(1, -(-int(sizes[2]) // BLOCKS_PER_TASK)), "block")
    gather = lambda parts, name: by_block(parts).groupBy("block").agg(F.collect_list(F.struct("shard", "kind", "a", "b", "c", "d")).alias(name))
    joined = (
        by_block(blocks.select("block", "idents", "lens", "train", "n_tokens", "tokens"))
        .join(gather(words.where("kind = 0"), "words"), "block")
        .join(gather(answers, "answers"), "block")
    )
    scores = joined.mapInArrow(_score(n, v, shards), _SCORES)
    return scores.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), crc_bucket(F.col("doc_id"), 7) != 2)
