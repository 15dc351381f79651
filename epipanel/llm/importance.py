"""Target-distribution importance resampling (operator 11).

Runs of one to three words are counted in hashed buckets, over the corpus and over
a target table. A bucket that is commoner in the target has a positive gain;
a document's weight is the sum of the gains of all its n-grams, and a
draw without replacement by weights plus Gumbel noise is the ``k`` largest sums.

Within a batch the n-grams are interned in an open-addressed NumPy table
(``ngram_table.py``): its slots hold the bucket and the count of each distinct
n-gram. Counting adds the slots' counts by bucket; weighing gathers the
gains through the slot ids of the occurrences. The texts are read twice; what
crosses the network is one vector of buckets a task, and four numbers a document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import narrow, table
from epipanel.llm.crc_sql import crc_of, crc_table
from epipanel.llm.ngram_table import ngram_tables
from epipanel.llm.words import groups
from epipanel.operators.ranges import running_total
from epipanel.session import write_scratch

BUCKETS = 10_000
PRIOR = 10_000  # occurrences added over all buckets, one each
SCALE = 1000
MIN_WORDS = 20
SHARE = (5, 100)
SEED = 42


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Occurrences of n-grams in each bucket, over all rows of ``texts``.

    Each task adds up its own; the driver sees ``buckets`` numbers. Null and empty texts have
    none; repeated rows count each time; an empty table gives zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, group in groups(batch.column("body")):
                for _, grams, _ in ngram_tables(group, buckets):
                    total += grams.bucket_counts(buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["bucket", "n"])

    body = narrow(texts, text=text_col).select(F.col("text").cast("binary").alias("body"))
    found = body.mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for r in found:
        out[r["bucket"]] = r["n"]
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray, prior: int = PRIOR, scale: int = SCALE) -> np.ndarray:
    """Scaled log-ratio of target to corpus in each bucket, rounded down."""
    s_all, t_all = float(corpus.sum() + prior), float(target.sum() + prior)
    return np.array(
        [math.floor(scale * math.log((t + 1.0) * s_all / ((s + 1.0) * t_all))) for s, t in zip(corpus.tolist(), target.tolist())],
        dtype=np.int64,
    )


def importance_weights(
    docs: DataFrame, gains: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_features, weight``.

    Null and empty texts have no words, no features and weight 0; other
    columns are ignored, whatever their names. No shuffle.
    """
    buckets = len(gains)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, group in groups(batch.column("body")):
                features = np.zeros(len(group), dtype=np.int64)
                weight = np.zeros(len(group), dtype=np.float64)  # sums of integers, exact to 2^53
                for n_words, grams, owner in ngram_tables(group, buckets):
                    features += np.bincount(owner, minlength=len(group))
                    gained = gains[grams.bucket][grams.slots]
                    weight += np.bincount(owner, weights=gained, minlength=len(group))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, len(group)),
                        pa.array(n_words, pa.int64()),
                        pa.array(features, pa.int64()),
                        pa.array(weight.astype(np.int64), pa.int64()),
                    ],
                    names=["doc_id", "n_words", "n_features", "weight"],
                )

    rows = narrow(docs, ident=id_col, text=text_col).select(
        F.col("ident").cast("bigint").alias("doc_id"), F.col("text").cast("binary").alias("body")
    )
    return rows.mapInArrow(run, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def draw(
    weighted: DataFrame, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, seed: int = SEED, scale: int = SCALE
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: of the documents with at least
    ``min_words`` words, the ``share`` with the highest scores have ranks 1, 2, 3...

    The noise comes from ``sha256("<seed>:<doc_id>")`` alone, so the draw does
    not depend on how rows are dealt out. Ties go to the smaller id (a null id, noise
    of the text ``null``, comes last), those of repeated rows to any of them.
    """
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), ident), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-float(scale)) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))
    scored = write_scratch(weighted.withColumn("score", (F.col("weight") + noise).cast("bigint")), "scored")
    able = scored.where(F.col("n_words") >= min_words).select("doc_id", "n_features", "weight", "score")
    number = able.count() * share[0] // share[1]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").asc()]
    placed = running_total(able, order)
    drawn = F.when(F.col("before") < number, F.col("before") + 1)
    ranked = placed.select("doc_id", "n_features", "weight", "score", drawn.alias("rank"))
    rest = scored.where(F.col("n_words") < min_words).select(
        "doc_id", "n_features", "weight", "score", F.lit(None).cast("bigint").alias("rank")
    )
    return ranked.unionAll(rest)


def importance_resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    buckets: int = BUCKETS, share: tuple[int, int] = SHARE, min_words: int = MIN_WORDS, seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of every row of ``docs``;
    those with a rank are the draw that resembles ``target``.

    * null text: no features, weight 0, not drawn; repeated rows each take part;
    * an empty target gives gains from the corpus alone; empty ``docs`` give no rows.

    Runs its jobs when called, but for the last selection.
    """
    gains = bucket_gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    return draw(importance_weights(docs, gains, id_col, text_col), share, min_words, seed)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_GRAMS = " UNION ALL ".join(
    f"SELECT kind, row, unnest(list_transform(range(1, len(words) - {n - 2}), lambda i: array_to_string(words[i:i + {n - 1}], ' '))) AS gram "
    f"FROM texts WHERE len(words) >= {n}"
    for n in (1, 2, 3)
)

ORACLE_SQL = rf"""
WITH {crc_table()},
raw AS (
  SELECT 'd' AS kind, row_number() OVER () AS row, doc_id, text FROM documents
  UNION ALL SELECT 'b', row_number() OVER (), NULL, text FROM benchmark
), texts AS MATERIALIZED (
  SELECT kind, row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM raw
), grams AS MATERIALIZED (
  SELECT kind, row, gram, count(*) AS n FROM ({_GRAMS}) GROUP BY ALL
), distinct_grams AS (
  SELECT DISTINCT gram FROM grams
), buckets AS MATERIALIZED (
  SELECT gram, {crc_of("gram")} % {BUCKETS} AS bucket FROM distinct_grams, crc_table
), counted AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t
  FROM grams JOIN buckets USING (gram) GROUP BY bucket
), totals AS (
  SELECT coalesce(sum(s), 0) AS s_all, coalesce(sum(t), 0) AS t_all FROM counted
), gains AS (
  SELECT bucket, floor({SCALE} * ln((t + 1)::DOUBLE * (s_all + {PRIOR})::DOUBLE / ((s + 1)::DOUBLE * (t_all + {PRIOR})::DOUBLE)))::BIGINT AS gain
  FROM counted, totals
), weights AS (
  SELECT row, sum(n) AS n_features, sum(n * gain) AS weight
  FROM grams JOIN buckets USING (gram) JOIN gains USING (bucket) WHERE kind = 'd' GROUP BY row
), scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
         (coalesce(weight, 0) + floor(-{SCALE}::DOUBLE * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, 'null')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE))))::BIGINT AS score
  FROM texts LEFT JOIN weights USING (row) WHERE kind = 'd'
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id, n_features) AS place,
         count(*) FILTER (n_words >= {MIN_WORDS}) OVER () AS able
  FROM scored
)
SELECT doc_id, n_features, weight, score,
       CASE WHEN n_words >= {MIN_WORDS} AND place <= {SHARE[0]} * able // {SHARE[1]} THEN place END AS rank
FROM ranked
"""
