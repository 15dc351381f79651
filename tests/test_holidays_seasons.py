"""Calendar, windows and the seasonal decomposition."""

import datetime as dt
import random

import pytest
from conftest import d

from epipanel.operators.holidays import holiday_calendar, holiday_spike_rates, interval_join
from epipanel.operators.seasons import season_of, season_spike_rates, seasonal_residuals
from pyspark.sql import functions as F

# published dates
KNOWN = {
    "easter": ["2019-04-21", "2020-04-12", "2021-04-04", "2024-03-31", "2038-04-25"],
    "good_friday": ["2020-04-10"], "pentecost": ["2020-05-31"],
    "orthodox_easter": ["2019-04-28", "2020-04-19", "2021-05-02", "2024-05-05"],
    "thanksgiving": ["2020-11-26", "2021-11-25"], "memorial_day": ["2020-05-25", "2021-05-31"], "labor_day": ["2020-09-07"],
    "eid_al_fitr": ["2020-05-24", "2021-05-13", "2024-04-10"], "eid_al_adha": ["2020-07-31"], "christmas": ["2020-12-25"],
}


def test_movable_feasts(spark):
    found = {(r["holiday"], r["date"].isoformat()) for r in holiday_calendar(spark, 2019, 2038).collect()}
    assert {(h, x) for h, days in KNOWN.items() for x in days} <= found
    assert sum(h == "easter" for h, _ in found) == 20
    assert holiday_calendar(spark, 2021, 2020).collect() == []


def test_intervals_by_buckets_are_all_pairs(spark):
    rng = random.Random(4)
    day = lambda n: dt.date(1969, 12, 1) + dt.timedelta(days=n)
    points = [(i, day(rng.randint(0, 90))) for i in range(80)] + [(900, None)]
    spans = [(i, day(a), day(a + rng.choice([0, 3, 16, 40]))) for i, a in enumerate(rng.choices(range(90), k=30))] + [(901, day(5), day(4)), (902, None, day(3))]
    rows = spark.createDataFrame(points, "id int, at date")
    intervals = spark.createDataFrame(spans, "span int, lo date, hi date")
    got = sorted((r["id"], r["span"]) for r in interval_join(rows, intervals, "at", "lo", "hi", bucket_days=7).collect())
    assert got == sorted((i, s) for i, at in points for s, lo, hi in spans if at and lo and lo <= at <= hi)
    kept = interval_join(rows, intervals, "at", "lo", "hi", how="left")
    assert {r["id"] for r in kept.collect()} == {i for i, _ in points}
    assert "NestedLoop" not in kept._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError):
        interval_join(rows, intervals.withColumnRenamed("span", "id"), "at", "lo", "hi")


def test_rates_inside_and_outside(spark):
    days = [("x", dt.date(2020, 1, 1) + dt.timedelta(days=i), i in (1, 2, 20)) for i in range(31)]
    days += [(None, d("1/2/20"), None), (None, d("1/2/20"), True), ("x", None, True), ("y", d("6/1/20"), True)]
    df = spark.createDataFrame(days, "grp string, date date, high boolean")
    feasts = spark.createDataFrame([("new_year", d("1/1/20")), ("twice", d("1/1/20")), ("twice", d("1/3/20")), ("never", d("7/1/20"))], "holiday string, date date")
    got = {(r["grp"], r["holiday"]): tuple(r)[2:] for r in holiday_spike_rates(df, feasts, "grp", before=0, after=3).collect()}
    assert got == {
        ("x", "new_year"): (4, 2, 0.5, 25, 1, 0.04, 12.5),
        ("x", "twice"): (6, 2, 0.333333, 25, 1, 0.04, 8.333333),
        (None, "new_year"): (2, 1, 0.5, 0, 0, None, None),
        (None, "twice"): (2, 1, 0.5, 0, 0, None, None),
    }
    assert holiday_spike_rates(df.limit(0), feasts, "grp").collect() == []


def test_seasons_turn_south_of_the_equator(spark):
    df = spark.createDataFrame([(d("1/15/20"),), (d("4/1/20"),), (d("12/1/20"),)], "at date")
    north = [r[0] for r in df.select(season_of(F.col("at"))).collect()]
    south = [r[0] for r in df.select(season_of(F.col("at"), F.lit(-5.0))).collect()]
    assert (north, south) == (["winter", "spring", "winter"], ["summer", "autumn", "summer"])


def test_a_spike_is_a_residual_not_a_maximum(spark):
    """A weekly and yearly rhythm with its highest days in winter; the planted day in
    summer is far below them and still the only spike."""
    start = dt.date(2019, 1, 1)
    rows = []
    for i in range(730):
        at = start + dt.timedelta(days=i)
        value = (300 if at.month in (12, 1, 2) else 100) + (40 if at.weekday() == 0 else 0)
        rows.append(("a", at, value + (60 if at == dt.date(2020, 7, 15) else 0), 50.0))
    rows += [("a", None, 5, 50.0), ("a", dt.date(2020, 7, 1), None, 50.0), (None, start, 5, None)]
    df = spark.createDataFrame(rows, "place string, at date, n bigint, lat double")
    out = seasonal_residuals(df, "place", "at", "n", "lat", z=2.0)
    spikes = [r["date"] for r in out.where("spike AND month(date) BETWEEN 5 AND 9").collect()]
    assert spikes == [dt.date(2020, 7, 15)]
    assert out.count() == 731
    sums = out.where("place = 'a'").select(F.max(F.abs(F.col("value") - F.col("trend") - F.col("weekday_part") - F.col("season_part") - F.col("residual")))).first()[0]
    assert sums < 1e-9
    alone = out.where("place IS NULL").first()
    assert (alone["residual"], alone["spike"]) == (0.0, False)
    rates = {(r["place"], r["season"]): r["n_days"] for r in season_spike_rates(out, "place").collect()}
    assert sum(n for (p, _), n in rates.items() if p == "a") == 730
    assert seasonal_residuals(df.limit(0), "place", "at", "n").collect() == []
    assert "SinglePartition" not in out._jdf.queryExecution().executedPlan().toString()
