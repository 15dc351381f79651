"""Physical-plan properties the scale design relies on."""

import re

import pytest
from conftest import d
from pyspark.sql import functions as F

from epipanel.operators import (
    change_over_time,
    first_occurrence,
    growth_daily_stats,
    growth_extreme_report,
    growth_factor,
    keep_entities,
    wide_growth_factor,
    wide_increments,
    wide_local_spikes,
)
from epipanel.session import shared_scratch_path


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return plan(df)


@pytest.fixture(scope="module")
def panel_path(spark):
    rows = [(g, f"{g}-{i}", d("2020-01-01").fromordinal(d("2020-01-01").toordinal() + t), i * t)
            for g in ("g1", "g2") for i in range(5) for t in range(6)]
    path = shared_scratch_path(spark, "plan-panel")
    spark.createDataFrame(rows, "grp string, location string, date date, value bigint").write.parquet(path)
    return path


@pytest.fixture(scope="module")
def wide(spark):
    return spark.createDataFrame(
        [("a", "1", "2", "4"), ("b", "0", "3", "3")], "k string, `1/1/20` string, `1/2/20` string, `1/3/20` string"
    )


def test_wide_path_never_shuffles(wide):
    for df in (wide_growth_factor(wide, ["k"]), wide_increments(wide, ["k"])):
        assert "Exchange" not in final_plan(df)
    spikes = wide_local_spikes(wide, ["k"], ["k"], cumulative=True)
    # only the final presentation sort moves rows
    assert final_plan(spikes).count("Exchange rangepartitioning") <= 1
    assert "Exchange hashpartitioning" not in plan(spikes)


def test_snapshots_probe_a_broadcast(spark, panel_path):
    snaps = growth_extreme_report(spark.read.parquet(panel_path), ["grp"], ["location"])
    p = final_plan(snaps)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p


def test_median_never_gathers_group_rows(spark, panel_path):
    growth = growth_factor(spark.read.parquet(panel_path), ["grp", "location"])
    p = plan(growth_daily_stats(growth, ["grp"]))
    # raw growth rows are only shuffled keyed by their delta value too, so a
    # hot (group, date) is spread over tasks; only histogram rows meet later
    assert re.search(r"hashpartitioning\(grp#\d+, date#\d+, delta#\d+", p)
    assert "percentile" not in p and "ObjectHashAggregate" not in p


def test_allow_list_reaches_scan(spark, panel_path):
    kept = keep_entities(spark.read.parquet(panel_path), "grp", ["g1", "g9"])
    assert "In(grp, [g1,g9])" in plan(kept)


def test_change_window_dates_reach_scan(spark, panel_path):
    out = change_over_time(spark.read.parquet(panel_path), ["grp", "location"], "1/2/20", 3)
    p = plan(out)
    assert "In(date" in p or "Or(EqualTo(date" in p


def test_first_occurrence_needs_no_window(spark, panel_path):
    first = first_occurrence(spark.read.parquet(panel_path), "value", "grp", date_col="date")
    p = plan(first)
    assert "Window" not in p
    assert "GreaterThan(value,0)" in p  # numeric filter pushed to the scan
    assert first.where(F.col("grp") == "g1").first()["first_value_date"] == d("2020-01-02")


def test_wide_plan_size_does_not_grow_with_date_columns(spark):
    import datetime as dt

    n = 300
    names = [f"{(dt.date(2020, 1, 1) + dt.timedelta(days=i)).month}/{(dt.date(2020, 1, 1) + dt.timedelta(days=i)).day}/"
             f"{(dt.date(2020, 1, 1) + dt.timedelta(days=i)).year % 100}" for i in range(n)]
    schema = "k string, " + ", ".join(f"`{c}` string" for c in names)
    wide = spark.createDataFrame([("a", *[str(i) for i in range(n)])], schema)
    growth = wide_growth_factor(wide, ["k"])
    p = plan(growth)
    # cells are typed by one array cast, and per-date logic reads one array column
    assert p.count("try_cast") <= 4
    assert growth.count() == n - 1
