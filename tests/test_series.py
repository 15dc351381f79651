"""Increments, percent change, spikes, change over time (FIXTURES M1-M3)."""

from decimal import Decimal

from conftest import d, rows

from epipanel.operators import (
    change_over_time,
    increments,
    local_spikes,
    percent_change,
    wide_to_long,
)

SCHEMA = "loc string, date date, value bigint"


def series(spark, by_loc: dict[str, list[int]], start="2020-01-01"):
    first = d(start).toordinal()
    data = [
        (loc, d(start).fromordinal(first + i), v) for loc, values in by_loc.items() for i, v in enumerate(values)
    ]
    return spark.createDataFrame(data, SCHEMA)


M1 = {"x": [0, 2, 3, 3, 1]}


def test_m1_increments(spark):
    inc = increments(series(spark, M1), ["loc"]).orderBy("date")
    assert [r.increment for r in inc.collect()] == [0, 2, 1, 0, -2]


def test_m1_percent_change(spark):
    pct = percent_change(series(spark, M1), ["loc"]).orderBy("date")
    assert [str(r.pct_change) for r in pct.collect()] == ["0.000", "0.000", "0.500", "0.000", "-0.667"]


def test_m1_percent_change_of_increments(spark):
    inc = increments(series(spark, M1), ["loc"]).withColumnRenamed("increment", "value")
    pct = percent_change(inc, ["loc"]).orderBy("date")
    assert [str(r.pct_change) for r in pct.collect()] == ["0.000", "0.000", "-0.500", "-1.000", "0.000"]


def test_m1_change_over_time(spark):
    out = change_over_time(series(spark, M1), ["loc"], "1/2/20", 3)
    assert rows(out, "loc", "start_date", "start_value", "end_date", "end_value", "delta") == [
        ("x", d("2020-01-02"), 2, d("2020-01-05"), 1, -1)
    ]


def test_change_over_time_needs_both_dates(spark):
    out = change_over_time(series(spark, M1), ["loc"], "1/4/20", 3)
    assert out.count() == 0


def test_m2_null_identity_cell_keeps_dates(spark):
    wide = spark.createDataFrame(
        [(None, "Peru", "-9", "-75", "5", "7", "10")],
        "`Province/State` string, `Country/Region` string, Lat string, Long string, "
        "`1/22/20` string, `1/23/20` string, `1/24/20` string",
    )
    long = wide_to_long(wide, ["Province/State", "Country/Region", "Lat", "Long"])
    inc = increments(long, ["Province/State", "Country/Region"]).orderBy("date")
    assert rows(inc, "date", "increment") == [(d("1/22/20"), 5), (d("1/23/20"), 2), (d("1/24/20"), 3)]


M3 = {"A": [100, 96, 50], "B": [3, 3, 0], "C": [0, 0, 0]}


def test_m3_spikes_threshold_one(spark):
    s = series(spark, M3).withColumnRenamed("value", "increment")
    out = rows(local_spikes(s, ["loc"]), "loc", "count_high_days", "highest_daily_value")
    assert out == [("B", 2, 3), ("A", 1, 100), ("C", 0, 0)]


def test_m3_spikes_threshold_095(spark):
    s = series(spark, M3).withColumnRenamed("value", "increment")
    out = rows(local_spikes(s, ["loc"], threshold=0.95), "loc", "count_high_days", "highest_daily_value")
    assert out == [("A", 2, 100), ("B", 2, 3), ("C", 0, 0)]


def test_spikes_negative_max_has_no_high_days(spark):
    s = series(spark, {"N": [-5, -2, -9]}).withColumnRenamed("value", "increment")
    assert rows(local_spikes(s, ["loc"]), "count_high_days", "highest_daily_value") == [(0, -2)]


def test_sum_of_increments_is_last_value(spark):
    data = {"p": [1, 4, 4, 9, 20], "q": [0, 0, 7, 7, 8]}
    inc = increments(series(spark, data), ["loc"])
    totals = dict(rows(inc.groupBy("loc").sum("increment"), "loc", "sum(increment)"))
    assert totals == {"p": 20, "q": 8}


def test_percent_change_rounds_half_up(spark):
    # 1/8 - 1 = -0.875 exactly; 9/8 - 1 = 0.125 -> 0.125; 2.0005 style values
    pct = percent_change(series(spark, {"x": [8, 9, 8]}), ["loc"]).orderBy("date")
    assert [r.pct_change for r in pct.collect()] == [Decimal("0.000"), Decimal("0.125"), Decimal("-0.111")]


def test_spike_days_and_lengths(spark):
    from epipanel.operators import spike_days, spike_lengths

    values = [1, 10, 8, None, 9, 2, 10]
    data = [("x", d(f"2020-01-0{i + 1}"), v) for i, v in enumerate(values)] + [("none", d("2020-01-01"), 0), (None, d("2020-01-09"), 3)]
    frame = spark.createDataFrame(data, "e string, date date, increment bigint")
    days = sorted(map(str, rows(spike_days(frame, "e"), "e", "date", "value", "share")))
    assert days == sorted(map(str, [("x", d("2020-01-02"), 10, 1.0), ("x", d("2020-01-07"), 10, 1.0), (None, d("2020-01-09"), 3, 1.0)]))
    runs = rows(spike_lengths(frame, "e", threshold=0.75).where("e = 'x'").orderBy("first_day"), "first_day", "last_day", "days", "total")
    assert runs == [
        (d("2020-01-02"), d("2020-01-03"), 2, 18), (d("2020-01-05"), d("2020-01-05"), 1, 9), (d("2020-01-07"), d("2020-01-07"), 1, 10)
    ]
