"""Neighbours on the globe against all pairs, and lagged correlation against numpy."""

import datetime as dt
import math
import random

import numpy as np
from conftest import d, rows

from epipanel.operators.neighbours import compare_with_neighbours, daily_series, lagged_correlation, nearest_places


def km(a, b):
    (lat1, lon1), (lat2, lon2) = a, b
    h = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371 * math.asin(min(1.0, math.sqrt(h)))


def plain(points, k, max_km):
    spots = {}
    for p, lat, lon in points:
        if p is None or lat is None or lon is None or not -90 <= lat <= 90 or abs(lon) > 1e6:
            continue
        at = (lat, 0.0 if abs(lat) == 90 else (lon + 180) % 360 - 180)
        spots[p] = min(at, spots.get(p, at))
    out = []
    for p, at in spots.items():
        near = sorted((round(km(at, other), 7), q) for q, other in spots.items() if q != p)[:k]
        out += [(p, i + 1, q, round(x, 3)) for i, (x, q) in enumerate(near) if x <= max_km]
    return sorted(out)


def test_equals_all_pairs_over_date_line_and_poles(spark):
    rng = random.Random(1)
    points = [(i, rng.uniform(-90, 90), rng.uniform(-180, 180)) for i in range(120)]
    points += [(1000 + i, min(90.0, rng.gauss(89, 1)), rng.uniform(-180, 180)) for i in range(20)]
    points += [(2000 + i, rng.gauss(0, 0.5), 179.9 + rng.gauss(0, 0.3)) for i in range(30)]
    points += [(3000 + i, 10.0, 10.0) for i in range(9)] + [(3100, 10.0, 370.0), (3101, 90.0, 5.0), (3102, 90.0, -100.0), (3103, -90.0, 7.0)]
    points += [(4000, None, 1.0), (4001, 95.0, 1.0), (None, 1.0, 1.0), (4002, 1.0, None), (5, points[5][1], points[5][2]), (6, -89.0, 1.0)]
    df = spark.createDataFrame(points, "p bigint, lat double, lon double")
    for k, max_km in ((4, 1500.0), (1, 20100.0)):
        got = nearest_places(df, "p", "lat", "lon", k, first_km=300.0, max_km=max_km).collect()
        assert sorted((r["place"], r["rank"], r["neighbour"], round(r["km"], 3)) for r in got) == plain(points, k, max_km)


def test_crowded_cells_start_smaller(spark, monkeypatch):
    monkeypatch.setattr("epipanel.operators.neighbours.CROWD", 5)
    rng = random.Random(2)
    points = [(i, 50 + rng.gauss(0, 0.01), 8 + rng.gauss(0, 0.01)) for i in range(60)] + [(100, 50.0, 9.0)]
    df = spark.createDataFrame(points, "p bigint, lat double, lon double")
    got = nearest_places(df, "p", "lat", "lon", 3, first_km=100.0, max_km=400.0).collect()
    assert sorted((r["place"], r["rank"], r["neighbour"], round(r["km"], 3)) for r in got) == plain(points, 3, 400.0)


def test_no_places(spark):
    df = spark.createDataFrame([], "p bigint, lat double, lon double")
    assert nearest_places(df, "p", "lat", "lon").collect() == []
    one = spark.createDataFrame([(1, 2.0, 3.0)], "p bigint, lat double, lon double")
    assert nearest_places(one, "p", "lat", "lon").collect() == []


def test_dates_against_neighbours(spark):
    near = spark.createDataFrame([("a", "b", 1, 5.0), ("a", "c", 2, 9.0), ("b", "a", 1, 5.0), ("e", "f", 1, 1.0)], "place string, neighbour string, rank int, km double")
    events = spark.createDataFrame(
        [("a", d("1/5/20")), ("b", d("1/3/20")), ("c", d("1/3/20")), ("b", d("1/9/20")), ("z", d("1/1/20")), (None, d("1/1/20"))], "place string, date date"
    )
    got = {r["place"]: tuple(r)[1:] for r in compare_with_neighbours(events, near).collect()}
    assert got == {
        "a": (d("1/5/20"), 2, 2, 2, "b", d("1/3/20"), 5.0, 2),
        "b": (d("1/3/20"), 1, 1, 0, "a", d("1/5/20"), 5.0, -2),
        "c": (d("1/3/20"), 0, 0, 0, None, None, None, None),
        "e": (None, 1, 0, 0, None, None, None, None),
        "z": (d("1/1/20"), 0, 0, 0, None, None, None, None),
    }


def test_series_have_a_cell_for_every_day(spark):
    df = spark.createDataFrame([("a", d("1/5/20"), 3), ("a", d("1/2/20"), 1), ("a", d("1/2/20"), 9), ("a", None, 5), ("b", d("1/1/20"), None)], "p string, date date, value bigint")
    got = {r["p"]: (r["first_day"], r["values"]) for r in daily_series(df, "p").collect()}
    assert got == {"a": (d("1/2/20"), [9, None, None, 3]), "b": (d("1/1/20"), [None])}


def test_lags_against_numpy(spark):
    rng = random.Random(3)
    start = dt.date(2020, 1, 1)
    series = {}
    lead = [rng.randint(0, 50) for _ in range(60)]
    series["lead"] = {t: v for t, v in enumerate(lead)}
    series["follows"] = {t + 3: v * 2 + rng.randint(0, 3) for t, v in enumerate(lead)}
    series["holes"] = {t: rng.randint(0, 9) for t in range(5, 50) if t % 4}
    series["flat"] = {t: 7 for t in range(60)}
    data = [(p, start + dt.timedelta(days=t), v) for p, s in series.items() for t, v in s.items()]
    panel = spark.createDataFrame(data + [("lead", None, 5)], "place string, date date, value bigint")
    pairs = [(a, b) for a in [*series, "absent"] for b in series if a != b]
    near = spark.createDataFrame(pairs, "place string, neighbour string")
    got = {(r["place"], r["neighbour"]): (r["best_lag"], r["strength"], r["n_days"]) for r in lagged_correlation(panel, near, max_lag=6, min_days=10).collect()}
    assert got[("follows", "lead")][0] == 3 and got[("lead", "follows")][0] == -3
    assert got[("flat", "lead")] == (None, None, None) == got[("absent", "lead")]
    for a, b in pairs:
        best = None
        for lag in range(-6, 7):
            xy = [(v, series[b][t - lag]) for t, v in series.get(a, {}).items() if t - lag in series[b]]
            if len(xy) >= 10 and len({x for x, _ in xy}) > 1 and len({y for _, y in xy}) > 1:
                r = round(float(np.corrcoef(*zip(*xy))[0, 1]), 6)
                best = min(best or (9,), (-r, abs(lag), lag, len(xy)))
        lag, strength, n = got[(a, b)]
        assert (lag is None) == (best is None)
        if best:
            assert (lag, n) == best[2:] and abs(strength + best[0]) < 2e-6


def test_plan_has_no_cross_join(spark):
    near = spark.createDataFrame([("a", "b")], "place string, neighbour string")
    panel = spark.createDataFrame([("a", d("1/1/20"), 1)], "place string, date date, value bigint")
    out = lagged_correlation(panel, near)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    assert rows(out, "place", "best_lag") == [("a", None)]
