"""The pipeline, each stage against a plain version on what the one before kept."""

import re
import sys
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from epipanel.session import write_scratch

sys.path.insert(0, __file__.rpartition("/")[0])
from test_decontaminate import plain  # noqa: E402
from test_ngram_jaccard import brute as near_brute  # noqa: E402
from llm_fixtures import docs  # noqa: F401
from test_packing import check as packing_check  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(write_scratch(stage(spark, out[-1], SF_DIR), f"test-{name}"))
    return out


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns(steps):
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns


def test_language_id_keeps_clean_documents(steps):
    before, after = dict(pairs(steps[0])), dict(pairs(steps[1]))
    for ident in set(before) - set(after):
        assert len(before[ident] or "") < 60 or not re.search("[a-z]{3}", before[ident])
    assert len(after) >= 0.97 * len(before)


def test_exact_dedup(steps):
    best = {}
    for ident, text in pairs(steps[1]):
        key = re.sub(r"[\x20\x09-\x0D]+", " ", text or "")
        best[key] = min(best.get(key, ident), ident)
    assert sorted(best.values()) == sorted(i for i, _ in pairs(steps[2]))


def test_near_duplicates(steps):
    want = [i for i, c, _ in near_brute(pairs(steps[2])) if i == c]
    assert sorted(want) == sorted(i for i, _ in pairs(steps[3]))


def test_decontamination(steps):
    items = [plain(t) for (t,) in duckdb.sql(f"SELECT text FROM '{SF_DIR}/benchmark.parquet'").fetchall()]
    want = [i for i, t in pairs(steps[3]) if not any(x in plain(t) for x in items)]
    assert sorted(want) == sorted(i for i, _ in pairs(steps[4]))


def test_packing(steps):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    packing_check(pairs(steps[4]), steps[5], tokenizer, 1024)


def test_packed_sequences_hold_their_token_ids(steps):
    sequences = {}
    for r in steps[5].collect():
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes()) == r["ids_crc32"]
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["ids"]))
    for parts in sequences.values():
        ids = []
        for offset, part in sorted(parts):
            assert offset == len(ids)
            ids += part
        assert len(ids) <= 1024


def test_run_gives_the_last_stage(spark, steps):
    cols = ["doc_id", "piece", "ids_crc32"]
    key = lambda df: sorted(map(tuple, df.select(*cols).collect()))
    assert key(corpus_pipeline.run(spark, SF_DIR)) == key(steps[5])


def test_odd_rows(spark, docs):
    rows = [(1, None), (2, ""), (None, "the and of that with no id at all, once more"), (3, "the and of that " * 400), (4, "the and of that " * 400), (4, "12 34")]
    frame = docs(rows).withColumn("__x", F.lit(1))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, frame, SF_DIR)
        assert out.columns == frame.columns
        out.collect()
        assert stage(spark, frame.limit(0), SF_DIR).collect() == []
    assert corpus_pipeline.STAGES[-1][1](spark, frame, SF_DIR).count() >= len(rows)
