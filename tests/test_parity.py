"""Every registered query against its SQL oracle on the smallest tables."""

import os

import pytest
from parity import compare, duck

import __spark_entry__ as contract
from epipanel.plans import catalog, oracle

SF_DIR = os.environ.get("PARITY_SF_DIR", "/root/testdata/sf0.001")
QUERIES = catalog.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    ok, msg = compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
    assert ok, msg


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns == ["grp", "stat", "stat_value", "location", "prev_date", "prev_value", "date", "value", "delta"]


def test_snapshots_without_aqe(spark, con):
    """Joining a materialised table back to its own lineage must not depend
    on AQE (it once tripped the analyser's self-join handling)."""
    previous = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("growth_extreme_snapshots", "wide_growth_extreme_snapshots"):
            ok, msg = compare(QUERIES[name](spark, SF_DIR), con, ORACLE[name])
            assert ok, f"{name}: {msg}"
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", previous)
