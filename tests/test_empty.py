"""Empty inputs give empty results, never errors."""

from epipanel.operators import (
    accumulate,
    densify,
    growth_extreme_report,
    increments,
    local_spikes,
    outcome_ratios,
    wide_growth_extreme_report,
    wide_local_spikes,
)


def test_empty_panel(spark):
    panel = spark.createDataFrame([], "grp string, location string, date date, value bigint")
    assert growth_extreme_report(panel, ["grp"], ["location"]).count() == 0
    inc = increments(panel, ["grp", "location"])
    assert local_spikes(inc, ["grp", "location"]).count() == 0
    assert densify(panel, ["grp", "location"]).count() == 0


def test_empty_observations(spark):
    obs = spark.createDataFrame(
        [], "obs_date date, state string, country string, confirmed bigint, deaths bigint, recovered bigint"
    )
    assert outcome_ratios(obs, "country", ["US"]).count() == 0
    assert accumulate(obs, "country", ["US"], mode="latest", within=["state"]).count() == 0


def test_empty_wide_file(spark):
    wide = spark.createDataFrame([], "k string, `1/1/20` string, `1/2/20` string")
    assert wide_growth_extreme_report(wide, ["k"], ["k"]).count() == 0
    assert wide_local_spikes(wide, ["k"], ["k"], cumulative=True).count() == 0
