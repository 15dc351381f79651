"""The wide-table fast path must equal the long-panel operators."""

from conftest import rows

from epipanel.operators import (
    growth_factor,
    increments,
    local_spikes,
    percent_change,
    wide_growth_factor,
    wide_increment_table,
    wide_increments,
    wide_local_spikes,
    wide_percent_change,
    wide_to_long,
)

IDS = ["Admin2", "Province_State"]


def wide_table(spark):
    # 1/3/20 is missing from the file (a gap), and one cell is empty
    return spark.createDataFrame(
        [
            ("Maricopa", "Arizona", "0", "2", "3", None, "1"),
            ("Pima", "Arizona", "4", "4", "8", "9", "9"),
            ("Gila", "Arizona", "0", "0", "0", "0", "0"),
        ],
        "Admin2 string, Province_State string, `1/1/20` string, `1/2/20` string, "
        "`1/4/20` string, `1/5/20` string, `1/6/20` string",
    )


def same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    assert sorted(rows(a, *cols), key=str) == sorted(rows(b, *cols), key=str)


def test_growth_equals_long(spark):
    w = wide_table(spark)
    same(wide_growth_factor(w, IDS), growth_factor(wide_to_long(w, IDS), IDS))


def test_increments_and_percent_change_equal_long(spark):
    w = wide_table(spark)
    long = wide_to_long(w, IDS)
    same(wide_increments(w, IDS), increments(long, IDS))
    same(wide_percent_change(w, IDS), percent_change(long, IDS))


def test_spikes_equal_long(spark):
    w = wide_table(spark)
    inc = increments(wide_to_long(w, IDS), IDS)
    for threshold in (1.0, 0.95, 0.5):
        expected = local_spikes(inc, IDS, threshold=threshold)
        assert rows(wide_local_spikes(w, IDS, IDS, threshold=threshold, cumulative=True), *expected.columns) == rows(
            expected, *expected.columns
        )
        two_step = wide_local_spikes(wide_increment_table(w, IDS), IDS, IDS, threshold=threshold)
        assert rows(two_step, *expected.columns) == rows(expected, *expected.columns)


def test_increment_table_keeps_schema(spark):
    w = wide_table(spark)
    t = wide_increment_table(w, IDS)
    assert t.columns == w.columns
    assert rows(t.where("Admin2 = 'Pima'"), "1/1/20", "1/2/20", "1/4/20", "1/5/20", "1/6/20") == [(4, 0, 4, 1, 0)]


def test_counts_written_with_decimals(spark):
    from epipanel.operators import wide_to_long

    w = spark.createDataFrame([("x", "1.0", "3.0", "n/a")], "k string, `1/1/20` string, `1/2/20` string, `1/3/20` string")
    assert rows(wide_to_long(w, ["k"]).orderBy("date"), "value") == [(1,), (3,), (None,)]
    g = wide_growth_factor(w, ["k"]).orderBy("date")
    assert [str(r.delta) for r in g.collect()] == ["200.00", "0.00"]


def test_percent_change_table_keeps_schema(spark):
    from epipanel.operators import wide_percent_change_table

    w = wide_table(spark)
    t = wide_percent_change_table(w, IDS)
    assert t.columns == w.columns
    got = rows(t.where("Admin2 = 'Maricopa'"), "1/1/20", "1/2/20", "1/4/20", "1/5/20", "1/6/20")
    # 0, 2, 3, (empty), 1: no change in the empty cell, 0.000 after it
    assert [str(x) for x in got[0]] == ["0.000", "0.000", "0.500", "None", "0.000"]
    long = percent_change(wide_to_long(w, IDS), IDS)
    same_vals = sorted(rows(long.where("Admin2 = 'Pima'").orderBy("date"), "pct_change"))
    assert sorted((x,) for x in rows(t.where("Admin2 = 'Pima'"), *w.columns[2:])[0]) == same_vals


def test_wide_extreme_report_equals_long(spark):
    from epipanel.operators import growth_extreme_report, wide_growth_extreme_report

    w = wide_table(spark)
    wide_snaps = wide_growth_extreme_report(w, IDS, ["Province_State"])
    long_snaps = growth_extreme_report(wide_to_long(w, IDS), ["Province_State"], ["Admin2"])
    same(wide_snaps, long_snaps)
    only_max = wide_growth_extreme_report(w, IDS, ["Province_State"], which=("max",))
    assert {r.stat for r in only_max.collect()} == {"max"}


def test_leading_and_trailing_empty_cells(spark):
    names = [f"1/{k}/20" for k in range(1, 8)]
    cells = [(None, None, "5", None, "4", None, None), (None,) * 7, ("3",) + (None,) * 6, (None,) * 6 + ("9",)]
    w = spark.createDataFrame([(f"p{i}", "s", *c) for i, c in enumerate(cells)], "Admin2 string, Province_State string, " + ", ".join(f"`{n}` string" for n in names))
    long = wide_to_long(w, IDS)
    same(wide_increments(w, IDS), increments(long, IDS))
    same(wide_percent_change(w, IDS), percent_change(long, IDS))
    expected = local_spikes(increments(long, IDS), IDS)
    assert rows(wide_local_spikes(w, IDS, IDS, cumulative=True), *expected.columns) == rows(expected, *expected.columns)


def test_wide_work_is_linear_over_empty_cells(spark):
    """500 columns: with an empty cell in every row about as fast as without, and
    the filled series is never computed inside a lambda."""
    import datetime as dt
    import time

    from pyspark.sql import functions as F

    n, places = 500, 400
    days = [dt.date(2020, 1, 1) + dt.timedelta(days=i) for i in range(n)]
    names = [f"{d.month}/{d.day}/{d.year % 100}" for d in days]

    def table(empty):
        cells = [f"cast({'null' if empty and i % 7 == 3 else f'id * {i}'} as bigint) AS `{c}`" for i, c in enumerate(names)]
        return spark.range(places).selectExpr("cast(id as string) AS Admin2", "'s' AS Province_State", *cells)

    def seconds(df):
        start = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    for build in (lambda w: wide_local_spikes(w, IDS, IDS, cumulative=True), lambda w: wide_increments(w, IDS)):
        seconds(build(table(False)))  # compiled
        plain, gaps = seconds(build(table(False))), seconds(build(table(True)))
        assert gaps < 1.5 * plain + 2.0
    plan = wide_local_spikes(table(True), IDS, IDS, cumulative=True)._jdf.queryExecution().optimizedPlan().toString()
    inside = [part.split("))")[0] for part in plan.split("lambdafunction(")[1:]]
    assert not any("array_repeat" in part or "flatten" in part or "aggregate" in part for part in inside)
    total = wide_increments(table(True), IDS).agg(F.sum("increment")).first()[0]
    last = max(i for i in range(n) if i % 7 != 3)
    assert total == sum(k * last for k in range(places))
