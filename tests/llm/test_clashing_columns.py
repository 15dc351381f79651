"""Columns of any name beside id and text survive, with their values."""

import pytest
from pyspark.sql import functions as F

from llm_fixtures import docs  # noqa: F401
from epipanel.llm.decontaminate import drop_contaminated
from epipanel.llm.exact_dedup import drop_exact_duplicates
from epipanel.llm.ngram_jaccard import drop_near_duplicates
from epipanel.llm.sentence_spans import remove_repeated_spans, repeated_spans

NAMES = ["sha", "__sha", "keep_id", "__keep_id", "keep_sha", "many", "__many", "drop_id", "__drop_id", "drop_key", "__drop_key", "cuts", "__cuts", "cut_id", "cut_key", "_cuts"]
TEXT = "".join(f"Sentence number {i} of this passage has these nine words. " for i in range(6))


@pytest.mark.parametrize("name", ["exact", "near", "spans", "contaminated"])
def test_columns_keep_their_values(spark, docs, name):
    frame = docs([(1, TEXT), (2, TEXT), (None, "quite another text of a few words"), (4, None)])
    for i, c in enumerate(NAMES):
        frame = frame.withColumn(c, F.lit(i))
    benchmark = spark.createDataFrame([(7, "Nothing of the kind stands in any of these documents at all, none.")], "item_id bigint, text string")
    run = {
        "exact": drop_exact_duplicates, "near": drop_near_duplicates, "spans": remove_repeated_spans, "contaminated": lambda d: drop_contaminated(d, benchmark)
    }[name]
    out = run(frame)
    assert out.columns == frame.columns
    rows = out.collect()
    assert {r["doc_id"] for r in rows} == ({1, None, 4} if name in ("exact", "near") else {1, 2, None, 4})
    assert all([r[c] for c in NAMES] == list(range(len(NAMES))) for r in rows)


def test_rows_without_an_id_are_told_apart(docs):
    """Very many rows without an id are no single group, and each loses what repeats."""
    rows = [(3, TEXT)] + [(None, f"Lead {i} stands first here. " + TEXT) for i in range(30)]
    found = repeated_spans(docs(rows))
    assert found.count() == 30 and {r["first_doc_id"] for r in found.collect()} == {3}
    kept = {r["text"] for r in remove_repeated_spans(docs(rows)).where("doc_id IS NULL").collect()}
    assert kept == {f"Lead {i} stands first here. " for i in range(30)}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan
