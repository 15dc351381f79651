"""N-gram Jaccard join with Bayesian candidate pruning (operator 9).

Documents are sets of runs of five words (``words.shingle_sets``); two are
linked when their Jaccard similarity is at least 0.8.

1. Documents with one and the same set are one class, found by a
   128-bit fingerprint of the set and represented once; copies are never
   expanded into pairs.
2. Each class has a MinHash signature. Classes that agree on a band of four values
   are candidates. A pair of similarity 0.8 agrees on none of the 24
   bands with a probability of 3 in a million, a more similar pair less often.
3. A candidate pair is looked at in the first band on which it agrees. Its
   MinHash values are compared 16 at a time; it is dropped as soon as the
   posterior probability that it reaches the threshold (uniform prior) falls
   below the tolerance of 1 in a million.
4. The pairs that are left are verified exactly, on whole shingle sets
   that are made anew from the texts of just those classes.

Large buckets are dealt into blocks by hash, and pairs of blocks are
separate groups of rows: no task holds a whole bucket, none is capped. A
group of rows gives one row per document (links, and a spanning edge), not one per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from hashlib import blake2b
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import col, fresh, narrow, table, tidy
from epipanel.llm.groups import connected_components, fixed_bytes, grouped
from epipanel.llm.words import groups, shingle_sets, words_of
from epipanel.session import write_scratch

WORDS = 5
THRESHOLD = Fraction(4, 5)
BANDS, ROWS = 24, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-6
BLOCK = 256

_rng = np.random.default_rng(20240229)
_MULTIPLY = (_rng.integers(0, 2**32, HASHES, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)[:, None]
_ADD = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]


def minhash(shingles: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over a set of 64-bit hashes."""
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(values), 4096):
        np.minimum(out, (values[None, at : at + 4096] * _MULTIPLY + _ADD).min(axis=1), out=out)
    return out


def needed_matches(threshold: Fraction = THRESHOLD, tolerance: float = TOLERANCE, hashes: int = HASHES, step: int = STEP):
    """For 16, 32, ... compared values the least number of matches at which the
    posterior still gives the threshold a probability of ``tolerance``.

    With a uniform prior, m matches of n leave a Beta(m + 1, n - m + 1); its
    tail beyond t is the probability of at most m hits in n + 1 trials of
    chance t."""
    t = float(threshold)
    out = []
    for n in range(step, hashes + 1, step):
        tail, m = 0.0, -1
        while tail < tolerance:
            m += 1
            tail += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


def fingerprint(shingles: np.ndarray) -> bytes:
    return blake2b(shingles.tobytes(), digest_size=16).digest()


def _sketch(n_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints: list[bytes | None] = []
            signatures: list[bytes | None] = []
            for _, group in groups(batch.column("body")):
                for shingles in shingle_sets(words_of(group), n_words):
                    some = len(shingles) > 0
                    prints.append(fingerprint(shingles) if some else None)
                    signatures.append(minhash(shingles).tobytes() if some else None)
            arrays = [batch.column("ident"), batch.column("text_key"), pa.array(prints, pa.binary()), pa.array(signatures, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["ident", "text_key", "node", "sig"])

    return run


def _candidates(needed: list[int]):
    """Pairs of a block that agree first on the block's band and survive the
    posterior test: one row per left node with all its right nodes, and one
    row with null ``others`` per node that is in any pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for group in grouped(batches, ["bucket", "low", "high"]):
            n = group.num_rows
            if n < 2:
                continue
            sigs = fixed_bytes(group.column("sig"), HASHES * 4).view(np.uint32)
            nodes = group.column("node").to_pylist()
            band, low, high = (group.column(c)[0].as_py() for c in ("band", "low", "high"))
            part = np.asarray(group.column("part"))
            left = np.arange(n) if low == high else np.flatnonzero(part == low)
            right = np.flatnonzero(part == high)
            bucket = group.column("bucket")[0].as_py()
            involved = np.zeros(n, dtype=bool)
            for i in left:
                others = right[right > i] if low == high else right
                if not len(others):
                    continue
                same = sigs[others] == sigs[i]
                first = same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band
                others, same = others[first], same[first]
                matches = np.zeros(len(others), dtype=np.int64)
                for k, least in enumerate(needed):
                    matches += same[:, k * STEP : (k + 1) * STEP].sum(axis=1)
                    alive = matches >= least
                    others, same, matches = others[alive], same[alive], matches[alive]
                if len(others):
                    involved[i] = involved[others] = True
                    out.append((bucket, low, high, nodes[i], [nodes[j] for j in others]))
            out += [(bucket, low, high, nodes[i], None) for i in np.flatnonzero(involved)]
            if len(out) >= 1000:
                yield _pairs_batch(out)
                out = []
        if out:
            yield _pairs_batch(out)

    return run


def _pairs_batch(rows: list[tuple]) -> pa.RecordBatch:
    bucket, low, high, node, others = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(bucket, pa.int64()),
            pa.array(low, pa.int32()),
            pa.array(high, pa.int32()),
            pa.array(node, pa.binary()),
            pa.array(others, pa.list_(pa.binary())),
        ],
        names=["bucket", "low", "high", "node", "others"],
    )


def _shingles(n_words: int):
    """The shingle sets of the texts, under their fingerprints."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, group in groups(batch.column("body")):
                sets = [s for s in shingle_sets(words_of(group), n_words) if len(s)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([fingerprint(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "shingles"],
                )

    return run


def _verify(threshold: Fraction):
    """Exact similarities of a block's pairs: per node its links (documents
    linked to it) and the smallest node of its component in the block."""
    top, bottom = threshold.numerator, threshold.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in grouped(batches, ["bucket", "low", "high"]):
            sets: dict[bytes, int] = {}
            values, copies = [], []
            pairs = []
            for node, others, shingles, n in zip(*(group.column(c).to_pylist() for c in ("node", "others", "shingles", "copies"))):
                if others is not None:
                    pairs.append((node, others))
                elif node not in sets:
                    sets[node] = len(values)
                    values.append(np.frombuffer(shingles, dtype=np.uint64))
                    copies.append(n)
            if not pairs:
                continue
            sizes = np.array([len(v) for v in values])
            starts = np.concatenate(([0], np.cumsum(sizes)))
            vocabulary, number = np.unique(np.concatenate(values), return_inverse=True)
            here = np.zeros(len(vocabulary), dtype=np.int64)
            links = np.zeros(len(values), dtype=np.int64)
            root = list(range(len(values)))

            def find(x: int) -> int:
                while root[x] != x:
                    root[x] = root[root[x]]
                    x = root[x]
                return x

            for node, others in pairs:
                i = sets[node]
                js = np.array([sets[o] for o in others])
                mine = number[starts[i] : starts[i + 1]]
                here[mine] = 1
                both = np.array([here[number[starts[j] : starts[j + 1]]].sum() for j in js])
                here[mine] = 0
                linked = js[both * bottom >= top * (sizes[i] + sizes[js] - both)]
                for j in linked.tolist():
                    links[i] += copies[j]
                    links[j] += copies[i]
                    a, b = find(i), find(j)
                    if a != b:
                        root[max(a, b)] = min(a, b)
            names = list(sets)
            smallest: dict[int, bytes] = {}
            for x, name in enumerate(names):
                r = find(x)
                smallest[r] = min(smallest.get(r, name), name)
            kept = [x for x in range(len(names)) if links[x]]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([names[x] for x in kept], pa.binary()),
                    pa.array([int(links[x]) for x in kept], pa.int64()),
                    pa.array([smallest[find(x)] for x in kept], pa.binary()),
                ],
                names=["node", "links", "root"],
            )

    return run


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_words: int = WORDS,
    threshold: Fraction = THRESHOLD, tolerance: float = TOLERANCE, block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, text_key, class_id, n_links``.

    ``class_id`` is the smallest id of all documents connected by links,
    ``n_links`` the number of other documents linked to this one (copies
    included). ``text_key`` is ``xxhash64`` of the text, to tell rows of one id apart.

    * null, empty and blank texts have no shingles: linked to nothing, class of their own;
    * texts of fewer than ``n_words`` words have one shingle of all their words;
    * null ids are linked like others; a class of null ids only has a null ``class_id``;
    * repeated rows are copies of each other; an empty table gives no rows;
    * other columns are ignored, whatever their names.

    Runs its jobs when called, except for the last join; intermediate tables
    are written to the shared checkpoint folder.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = narrow(docs, ident=id_col, text=text_col).select(
        F.col("ident").cast("bigint").alias("ident"), F.xxhash64(text).alias("text_key"), text.cast("binary").alias("body")
    )
    sketches = write_scratch(
        rows.mapInArrow(tidy(_sketch(n_words)), "ident bigint, text_key bigint, node binary, sig binary"), "sketches"
    )
    classes = write_scratch(
        sketches.where("node IS NOT NULL").groupBy("node", "sig").agg(F.min("ident").alias("ident"), F.count("*").alias("copies")), "classes"
    )

    keys = [F.struct(F.lit(b).alias("band"), F.xxhash64(F.lit(b), F.substring("sig", b * ROWS * 4 + 1, ROWS * 4)).alias("bucket")) for b in range(BANDS)]
    banded = classes.select("node", F.explode(F.array(*keys)).alias("k")).select("node", "k.band", "k.bucket")
    # stored, so that either side of the join has a shuffle of its own and Spark may
    # split the rows of a bucket that very many classes share
    busy = write_scratch(banded.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1"), "busy")
    parts = F.ceil(F.col("size") / block).cast("int")
    members = banded.join(busy, "bucket").withColumn("parts", parts)
    members = members.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    members = members.select("bucket", "band", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "part", "node")
    with_sig = members.join(classes.select("node", "sig"), "node")
    in_blocks = with_sig.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    pairs = write_scratch(
        in_blocks.mapInArrow(
            tidy(_candidates(needed_matches(threshold, tolerance))), "bucket bigint, low int, high int, node binary, others array<binary>"
        ),
        "pairs",
    )

    involved = pairs.where("others IS NULL").select("bucket", "low", "high", "node")
    wanted = involved.select("node").distinct().join(classes.select("node", "ident", "copies"), "node")
    ids = wanted.select(F.col("ident").alias("wanted_id")).distinct()
    texts = rows.join(ids, F.col("ident").eqNullSafe(F.col("wanted_id")), "left_semi").select("body")
    sets = texts.mapInArrow(tidy(_shingles(n_words)), "node binary, shingles binary")
    sets = sets.join(wanted.select("node", "copies"), "node").dropDuplicates(["node"])
    none = lambda kind: F.lit(None).cast(kind)
    material = involved.join(sets, "node").select("bucket", "low", "high", "node", none("array<binary>").alias("others"), "shingles", "copies")
    questions = pairs.where("others IS NOT NULL").select("bucket", "low", "high", "node", "others", none("binary").alias("shingles"), none("bigint").alias("copies"))
    blocks = material.unionAll(questions).repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")
    verified = write_scratch(blocks.mapInArrow(tidy(_verify(threshold)), "node binary, links bigint, root binary"), "links")

    components = connected_components(verified.select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    found = classes.select("node", "ident", "copies").join(components, "node", "left").join(links, "node", "left")
    found = found.select("node", F.coalesce("root", "node").alias("root"), "ident", "copies", F.coalesce("links", F.lit(0)).alias("links"))
    smallest = found.groupBy("root").agg(F.min("ident").alias("class_id"))
    told = found.join(smallest, "root").select("node", "class_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    alone = sketches.where("node IS NULL").select(
        F.col("ident").alias("doc_id"), "text_key", F.col("ident").alias("class_id"), F.lit(0).cast("bigint").alias("n_links")
    )
    linked = sketches.where("node IS NOT NULL").join(told, "node").select(F.col("ident").alias("doc_id"), "text_key", "class_id", "n_links")
    return linked.unionAll(alone)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each class: that with the smallest id.
    Rows that repeat its id and text are the same document and stay. In a
    class of null ids only, all stay."""
    drop_id, drop_key = fresh(docs, "drop_id", "drop_key")
    found = near_duplicates(docs, id_col, text_col)
    dropped = found.where(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(
        F.col("doc_id").alias(drop_id), F.col("text_key").alias(drop_key)
    ).distinct()
    same = col(id_col).cast("bigint").eqNullSafe(F.col(drop_id)) & (
        F.xxhash64(F.coalesce(col(text_col), F.lit(""))) == F.col(drop_key)
    )
    return docs.join(dropped, same, "left_anti")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("text_key")


ORACLE_SQL = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), starts AS (
  SELECT doc_id, w, unnest(range(1, CAST(greatest(len(w) - 4, 1) AS BIGINT) + 1)) AS i FROM texts WHERE len(w) > 0
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM starts
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 5 * k >= 4 * (x.n + y.n - k)
), reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
), classes AS (
  SELECT doc_id, min(other) AS class_id FROM reach GROUP BY doc_id
)
SELECT doc_id, class_id, (SELECT count(*) FROM links WHERE links.a = classes.doc_id) AS n_links FROM classes
"""
