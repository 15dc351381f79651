"""Random panels: Spark's growth family against a brute-force definition."""

import datetime as dt
import math
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from epipanel.operators import growth as G
from epipanel.operators import increments, local_spikes

DAY0 = dt.date(2020, 3, 1)

cells = st.one_of(st.none(), st.integers(min_value=-3, max_value=40))
panels = st.lists(
    st.tuples(
        st.sampled_from(["g1", "g2"]),
        st.sampled_from(["a", "b", "c", "d"]),
        st.integers(min_value=0, max_value=6),
        cells,
    ),
    min_size=1,
    max_size=40,
    unique_by=lambda r: (r[0], r[1], r[2]),
)


def growth_of(today, yesterday):
    if today is None or yesterday is None or yesterday == 0:
        return Decimal("0.00")
    x = (float(today) / float(yesterday) - 1.0) * 100.0
    q = Decimal(repr(x)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    return q if abs(q) < Decimal("1000000") else Decimal("0.00")


def brute_growth(rows):
    by_entity = {}
    for g, loc, day, v in rows:
        by_entity.setdefault((g, loc), []).append((day, v))
    out = []
    for (g, loc), series in by_entity.items():
        series.sort()
        for (pday, pval), (day, val) in zip(series, series[1:]):
            prev = pval if day - pday == 1 else None
            out.append((g, loc, day, 0 if prev is None else prev, 0 if val is None else val, growth_of(val, prev)))
    return sorted(out)


def brute_extremes(growth_rows):
    per = {}
    for g, _, day, _, _, delta in growth_rows:
        per.setdefault((g, day), []).append(delta)
    stats = {}
    for (g, day), ds in per.items():
        ds = sorted(ds)
        n = len(ds)
        avg = (sum(ds) / n).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
        stats.setdefault(g, []).append((day, float(ds[math.ceil(n / 2) - 1]), float(avg), float(ds[-1]), float(ds[0])))
    want = {}
    for g, days in stats.items():
        days.sort()
        pick = {
            "greatest_median": max(days, key=lambda r: (r[1], -r[0])),
            "least_median": min(days, key=lambda r: (r[1], r[0])),
            "greatest_avg": max(days, key=lambda r: (r[2], -r[0])),
            "least_avg": min(days, key=lambda r: (r[2], r[0])),
            "max": max(days, key=lambda r: (r[3], -r[0])),
            "min": min(days, key=lambda r: (r[4], r[0])),
        }
        col = {"greatest_median": 1, "least_median": 1, "greatest_avg": 2, "least_avg": 2, "max": 3, "min": 4}
        for stat, r in pick.items():
            want[(g, stat)] = (r[0], r[col[stat]])
    return want


def to_df(spark, rows):
    data = [(g, loc, DAY0 + dt.timedelta(days=day), v) for g, loc, day, v in rows]
    return spark.createDataFrame(data, "grp string, location string, date date, value bigint")


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=panels)
def test_growth_family_matches_definition(spark, rows):
    panel = to_df(spark, rows)
    growth = G.growth_factor(panel, ["grp", "location"])
    got = sorted(
        (r.grp, r.location, (r.date - DAY0).days, r.prev_value, r.value, r.delta) for r in growth.collect()
    )
    want = brute_growth(rows)
    assert got == want
    if not want:
        return
    ex = G.growth_extremes(G.growth_daily_stats(growth, ["grp"]), ["grp"])
    got_ex = {(r.grp, r.stat): ((r.date - DAY0).days, r.value) for r in ex.collect()}
    assert got_ex == brute_extremes(want)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=panels, threshold=st.sampled_from([1.0, 0.95, 0.5]))
def test_increments_and_spikes_match_definition(spark, rows, threshold):
    panel = to_df(spark, [r for r in rows if r[3] is not None])
    inc = increments(panel, ["grp", "location"])
    series = {}
    for g, loc, day, v in sorted(r for r in rows if r[3] is not None):
        series.setdefault((g, loc), []).append(v)
    want_inc = {}
    for key, values in series.items():
        want_inc[key] = [v - p for v, p in zip(values, [0, *values[:-1]])]
        # the sum of increments is the last value
        assert sum(want_inc[key]) == values[-1]
    got_inc = {}
    for r in inc.orderBy("date").collect():
        got_inc.setdefault((r.grp, r.location), []).append(r.increment)
    assert got_inc == want_inc

    spikes = local_spikes(inc, ["grp", "location"], threshold=threshold)
    got = [(r.grp, r.location, r.count_high_days, r.highest_daily_value) for r in spikes.collect()]
    want = []
    for (g, loc), incs in want_inc.items():
        peak = max(incs)
        high = sum(1 for x in incs if peak > 0 and float(x) >= threshold * float(peak))
        want.append((g, loc, high, peak))
    want.sort(key=lambda t: (-t[2], -t[3], t[0], t[1]))
    assert got == want


wide_tables = st.tuples(
    st.lists(st.integers(min_value=0, max_value=9), min_size=2, max_size=6, unique=True).map(sorted),
    st.lists(st.lists(st.one_of(st.none(), st.integers(min_value=-2, max_value=30)), min_size=6, max_size=6),
             min_size=1, max_size=4),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(table=wide_tables)
def test_wide_path_equals_long_path(spark, table):
    from epipanel.operators import percent_change, wide_growth_factor, wide_increments, wide_percent_change, wide_to_long

    day_offsets, cells = table
    names = [f"{(DAY0 + dt.timedelta(days=o)).month}/{(DAY0 + dt.timedelta(days=o)).day}/20" for o in day_offsets]
    schema = "k string, " + ", ".join(f"`{n}` string" for n in names)
    data = [(f"p{i}", *[None if v is None else str(v) for v in row[: len(names)]]) for i, row in enumerate(cells)]
    wide = spark.createDataFrame(data, schema)
    long = wide_to_long(wide, ["k"])

    def same(a, b):
        cols = sorted(a.columns)
        key = lambda t: tuple(str(x) for x in t)
        assert sorted((tuple(r[c] for c in cols) for r in a.collect()), key=key) == sorted(
            (tuple(r[c] for c in cols) for r in b.collect()), key=key
        )

    same(wide_growth_factor(wide, ["k"]), G.growth_factor(long, ["k"]))
    same(wide_increments(wide, ["k"]), increments(long, ["k"]))
    same(wide_percent_change(wide, ["k"]), percent_change(long, ["k"]))
