"""A training corpus from the documents table, in five stages.

Each stage reads what the one before it kept, and its output is written as
Parquet and read again. All but the last return the columns of documents:

1. language ID: documents whose language is rejected go;
2. exact deduplication: of equal texts the smallest id stays;
3. n-gram Jaccard join: of each class of near duplicates the smallest id stays;
4. benchmark decontamination: documents that contain a benchmark item go;
5. best-fit packing: the pieces of the remaining documents with their token ids, in
   sequences of 1024 tokens, ready to train on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.llm.common import crc_bucket, table
from epipanel.llm.decontaminate import drop_contaminated
from epipanel.llm.exact_dedup import drop_exact_duplicates
from epipanel.llm.langid import learn_dictionaries, margin_share, predict_languages
from epipanel.llm.ngram_jaccard import drop_near_duplicates
from epipanel.llm.packing import pack_public
from epipanel.session import write_scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or whose best two languages are too close, go.
    Learns from four fifths of the labelled rows of the documents themselves; how close is
    too close is set on the last fifth, so that clean documents stay."""
    held_out = crc_bucket(F.col("doc_id"), 5) == 0
    dictionaries = learn_dictionaries(docs.where(~held_out))
    share = margin_share(docs.where(held_out), dictionaries)
    return predict_languages(docs, dictionaries, min_share=share).where(~F.col("__lang_rejected")).select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for white space the smallest id stays."""
    return drop_exact_duplicates(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates the smallest id stays."""
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain an item of the benchmark table go."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece, as ``packing.pack_documents`` gives it, token ids included."""
    return pack_public(docs, with_ids=True)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard", ngram_jaccard),
    ("decontaminate", decontaminate),
    ("best_fit_packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's output is written under the shared checkpoint folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = write_scratch(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs


# no SQL: it has no zstandard, no singular value decomposition and no tokenizer
ORACLE_SQL = None
