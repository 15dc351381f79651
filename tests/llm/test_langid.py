"""Language identification: held-out accuracy and defined edge cases."""

import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from epipanel.llm import langid
from llm_fixtures import docs  # noqa: F401
from epipanel.llm.langid import learn_dictionaries, predict_languages

SF_DIR = "/root/testdata/sf0.01"
EN = "The and attion to thanedble the, anea. Eriner thanea."
DE = "Nicht aulich für sch erüver enau sch der."


def test_held_out_accuracy(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF_DIR}/documents.parquet'").fetchall())
    rows = langid.query(spark, SF_DIR).collect()
    assert len(rows) == len(truth)
    held = [r for r in rows if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0}
    right = [r["lang_pred"] == truth[r["doc_id"]] for r in held]
    assert sum(right) / len(right) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert sum(r["rejected"] for r in rows) <= 0.01 * len(rows)


@pytest.fixture(scope="module")
def dictionaries(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    return learn_dictionaries(docs)


def test_edge_cases(docs, dictionaries):
    rows = [(1, None), (2, ""), (3, "123 !! \n"), (4, EN), (4, EN), (None, DE), (5, (EN + " ") * 6_000)]
    frame = docs(rows).withColumn("size", F.lit(1)).withColumn("draw", F.lit("x")).drop("lang")
    out = predict_languages(frame, dictionaries)
    assert out.columns[: len(frame.columns)] == frame.columns
    got = {r["doc_id"]: r for r in out.collect()}
    assert [got[i]["__lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert [got[i]["__lang_score"] for i in (1, 2, 3)] == [0.0] * 3
    assert all(got[i]["__lang_rejected"] for i in (1, 2, 3))
    assert (got[4]["__lang_pred"], got[5]["__lang_pred"], got[None]["__lang_pred"]) == ("en", "en", "de")
    assert out.count() == len(rows)


def test_learning_without_rows(docs):
    assert learn_dictionaries(docs([])) == {}
    assert predict_languages(docs([(1, "text")]), {}).first()["__lang_pred"] == "und"
    assert predict_languages(docs([]), {}).collect() == []


def test_only_long_texts_still_give_a_dictionary(docs):
    learned = learn_dictionaries(docs([(i, f"long{i} text " * 500) for i in range(6)]), dict_bytes=1000)
    assert set(learned) == {"en"} and len(learned["en"]) == 1000


def test_predictions_do_not_see_the_label(docs, dictionaries):
    rows = [(1, EN), (2, DE)]
    a = predict_languages(docs(rows), dictionaries)
    b = predict_languages(docs(rows).withColumn("lang", F.lit("fr")).withColumn("source", F.lit("zz")), dictionaries)
    pick = lambda df: sorted((r["doc_id"], r["__lang_pred"], r["__lang_score"]) for r in df.collect())
    assert pick(a) == pick(b)
