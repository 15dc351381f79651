"""Fixtures of this folder (not a conftest: the folder above has one)."""

import pytest


@pytest.fixture
def docs(spark):
    """A documents table from (doc_id, text) pairs."""

    def build(rows, partitions=3):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in rows]
        df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
        return df.repartition(partitions)

    return build
