"""Null groups, empty cells, century and column order, bounded medians."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import d, rows
from pyspark.sql import functions as F

from epipanel.functions.dates import format_mdy, mdy_name, parse_mdy_name, parse_observation_date
from epipanel.functions.numeric import fractional_change
from epipanel.operators import (
    densify,
    extreme_snapshots,
    fill_identity,
    growth_daily_stats,
    growth_extreme_report,
    growth_extremes,
    growth_factor,
    increments,
    local_spikes,
    long_to_wide,
    panel_snapshots,
    population_rollup,
    wide_growth_extreme_report,
    wide_increment_table,
    wide_increments,
    wide_local_spikes,
    wide_to_long,
)
from epipanel.session import clear_scratch, ensure_checkpoint_dir, input_bytes, shared_scratch_path, write_scratch
from epipanel.sources.files import read_observations, read_wide, write_snapshot
from epipanel.streaming import observation_stream, publish, read_published, running_totals

PANEL = "grp string, place string, date date, value bigint"


def panel(spark, seed=1, days=12):
    rng = random.Random(seed)
    out = []
    for grp in (None, "a", "b"):
        for p in range(6):
            total = 0
            for i in range(days):
                total += rng.randint(0, 9)
                if rng.random() < 0.1:
                    continue  # no row on this day
                value = None if rng.random() < 0.1 else total
                out.append((grp, f"p{p}" if p else None, dt.date(2020, 3, 1) + dt.timedelta(days=i), value))
    return spark.createDataFrame(out, PANEL)


def test_a_null_group_has_snapshots_too(spark):
    frame = panel(spark)
    growth = growth_factor(frame, ["grp", "place"])
    extremes = growth_extremes(growth_daily_stats(growth, ["grp"]), ["grp"])
    direct = extreme_snapshots(growth, extremes, ["grp"])
    assert sum(1 for (g,) in rows(direct, "grp") if g is None) > 0
    cols = ["grp", "stat", "stat_value", "place", "prev_date", "prev_value", "date", "value", "delta"]
    key = lambda df: sorted(map(str, rows(df, *cols)))
    assert key(panel_snapshots(frame, extremes, ["grp"], ["place"])) == key(direct)
    assert key(growth_extreme_report(frame, ["grp"], ["place"])) == key(direct)
    assert panel_snapshots(frame, extremes, ["grp"], ["place"]).columns == direct.columns
    # beyond the broadcast limit the same rows come from shuffle joins
    assert key(panel_snapshots(frame, extremes, ["grp"], ["place"], max_broadcast_rows=1)) == key(direct)


def test_wide_snapshots_of_a_null_group_equal_the_long_ones(spark):
    wide = long_to_wide(panel(spark, 2), ["grp", "place"])
    long = wide_to_long(wide, ["grp", "place"])
    cols = ["grp", "stat", "stat_value", "place", "prev_date", "prev_value", "date", "value", "delta"]
    key = lambda df: sorted(map(str, rows(df, *cols)))
    got = key(wide_growth_extreme_report(wide, ["grp", "place"], ["grp"]))
    assert got == key(growth_extreme_report(long, ["grp"], ["place"])) and got


def test_second_pass_reads_extreme_dates_only(spark):
    frame = panel(spark)
    extremes = growth_extremes(growth_daily_stats(growth_factor(frame, ["grp", "place"]), ["grp"]), ["grp"])
    plan = panel_snapshots(frame, extremes, ["grp"], ["place"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan  # no growth of other dates


@pytest.mark.parametrize("n", [1, 2, 5, 400])
def test_two_step_median(spark, n):
    rng = random.Random(n)
    cents = [rng.randint(-99_999_999, 99_999_999) if i % 2 else rng.randint(-300, 300) for i in range(n)]
    data = [(None, d("2020-01-02"), Decimal(c) / 100) for c in cents]
    data += [("b", None, Decimal("1.50")), ("b", None, Decimal("-1.50"))]
    frame = spark.createDataFrame(data, "grp string, date date, delta decimal(8,2)")
    out = {r["grp"]: r for r in growth_daily_stats(frame, ["grp"]).collect()}
    assert out[None]["median_delta"] == sorted(cents)[(n - 1) // 2] / 100
    assert out[None]["n_entities"] == n and out[None]["max_delta"] == max(cents) / 100
    assert out["b"]["median_delta"] == -1.5 and out["b"]["avg_delta"] == 0.0


def test_median_windows_are_bounded(spark):
    """No window spans the histogram rows of a whole group and date."""
    data = [("g", d("2020-01-02"), Decimal(i) / 100) for i in range(50)]
    stats = growth_daily_stats(spark.createDataFrame(data, "grp string, date date, delta decimal(8,2)"), ["grp"])
    windows = [x for x in stats._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in x]
    assert len(windows) == 2 and all("_bucket" in w for w in windows)


def test_sketch_median_is_within_its_rank_error(spark):
    n = 20_000
    data = [(d("2020-01-02"), Decimal(i) / 100) for i in range(n)]
    frame = spark.createDataFrame(data, "date date, delta decimal(8,2)")
    got = growth_daily_stats(frame, median="sketch").first()["median_delta"]
    assert abs(round(got * 100) - n / 2) <= 0.001 * n + 1


def test_increment_after_an_empty_cell(spark):
    data = [("x", None, d("2020-01-0%d" % (i + 1)), v) for i, v in enumerate([100, None, 120, 130])]
    frame = spark.createDataFrame(data, PANEL)
    step = increments(frame, ["grp", "place"])
    assert [v for (v,) in rows(step.orderBy("date"), "increment")] == [100, None, 20, 10]
    assert rows(local_spikes(step, ["grp"]), "count_high_days", "highest_daily_value") == [(1, 100)]
    wide = long_to_wide(frame, ["grp", "place"])
    assert sorted(map(str, rows(wide_increments(wide, ["grp", "place"]), "date", "increment"))) == sorted(
        map(str, rows(step, "date", "increment"))
    )
    table = wide_increment_table(wide, ["grp", "place"]).first()
    assert list(table)[2:] == [100, None, 20, 10]
    spikes = wide_local_spikes(wide, ["grp", "place"], ["grp"], cumulative=True)
    assert rows(spikes, "count_high_days", "highest_daily_value") == [(1, 100)]


def test_leading_empty_cells(spark):
    wide = spark.createDataFrame([("x", None, None, 5, None, 9)], "grp string, `1/1/20` bigint, `1/2/20` bigint, `1/3/20` bigint, `1/4/20` bigint, `1/5/20` bigint")
    assert list(wide_increment_table(wide, "grp").first())[1:] == [None, None, 5, None, 4]


def test_percent_change_has_no_cap(spark):
    row = spark.createDataFrame([(1, 2_000_000_000_000_000)], "a bigint, b bigint").select(fractional_change("b", "a").alias("c"))
    assert row.first()["c"] == Decimal("1999999999999999.000")


def test_population_text(spark):
    frame = spark.createDataFrame([("Ohio", "12.0"), ("Ohio", "3"), ("Ohio", "n/a"), ("Ohio", None)], "state string, population string")
    assert rows(population_rollup(frame), "state", "population") == [("Ohio", 15)]


def test_densify_keeps_null_entities_and_undated_rows(spark):
    data = [(None, d("2020-01-01"), 5), (None, d("2020-01-03"), 7), ("a", d("2020-01-02"), 1), ("a", None, 9), (None, None, 8)]
    frame = spark.createDataFrame(data, "e string, date date, v bigint")
    out = sorted(map(str, rows(densify(frame, ["e"]), "e", "date", "v")))
    days = [d("2020-01-01"), d("2020-01-02"), d("2020-01-03")]
    want = [(None, x, {0: 5, 2: 7}.get(i)) for i, x in enumerate(days)] + [("a", x, {1: 1}.get(i)) for i, x in enumerate(days)]
    assert out == sorted(map(str, [*want, ("a", None, 9), (None, None, 8)]))
    outside = densify(frame.where("date is not null"), ["e"], start=d("2020-01-02"), end=d("2020-01-02"))
    assert sorted(map(str, rows(outside, "e", "date", "v"))) == sorted(
        map(str, [(None, days[1], None), ("a", days[1], 1), (None, days[0], 5), (None, days[2], 7)])
    )


def test_centuries(spark):
    assert parse_mdy_name("1/1/95") == dt.date(1995, 1, 1)
    assert parse_mdy_name("1/22/20") == dt.date(2020, 1, 22)
    for day in (dt.date(1895, 5, 6), dt.date(1941, 1, 1), dt.date(1995, 12, 31), dt.date(2040, 2, 29), dt.date(2041, 1, 1)):
        assert parse_mdy_name(mdy_name(day)) == day
    frame = spark.createDataFrame([("1/2/95",), ("01/02/1995",), ("1/2/20",), ("x",)], "t string")
    parsed = frame.select(parse_observation_date("t").alias("p"))
    assert [v for (v,) in rows(parsed, "p")] == [dt.date(1995, 1, 2), dt.date(1995, 1, 2), dt.date(2020, 1, 2), None]
    dates = spark.createDataFrame([(dt.date(1895, 5, 6),), (dt.date(1995, 5, 6),)], "x date").select(format_mdy("x").alias("t"))
    assert [v for (v,) in rows(dates, "t")] == ["5/6/1895", "5/6/95"]
    old = spark.createDataFrame([("a", dt.date(1895, 1, 1), 1), ("a", dt.date(1995, 1, 1), 2)], "e string, date date, value bigint")
    back = wide_to_long(long_to_wide(old, ["e"]), ["e"])
    assert sorted(rows(back, "date", "value")) == [(dt.date(1895, 1, 1), 1), (dt.date(1995, 1, 1), 2)]


def test_two_columns_of_one_date_are_rejected(spark):
    wide = spark.createDataFrame([("a", 1, 2)], "e string, `1/1/20` bigint, `1/1/2020` bigint")
    with pytest.raises(ValueError, match="same date"):
        wide_to_long(wide, ["e"])


HEADER = "SNo,ObservationDate,Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered"
SWAPPED = "SNo,ObservationDate,Country/Region,Province/State,Last Update,Deaths,Confirmed,Recovered"


def text_file(spark, path, lines):
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(path)


def test_reordered_columns_are_rejected(spark):
    path = shared_scratch_path(spark, "reordered")
    text_file(spark, path, [SWAPPED, "1,01/22/2020,US,Ohio,x,9,1,0"])
    with pytest.raises(Exception, match="(?i)header|schema"):
        read_observations(spark, path).collect()
    with pytest.raises(Exception, match="(?i)header|schema"):
        query = publish(running_totals(observation_stream(spark, path), "country"), shared_scratch_path(spark, "t"))
        query.awaitTermination()


def test_every_wide_file_is_checked_against_the_first(spark):
    base = shared_scratch_path(spark, "wide-files")
    text_file(spark, f"{base}/a", ["place,1/1/20,1/2/20", "x,1,2"])
    text_file(spark, f"{base}/b", ["place,1/1/20,1/2/20", "y,3,4"])
    long = wide_to_long(read_wide(spark, f"{base}/*"), ["place"])
    assert sorted(v for (v,) in rows(long, "value")) == [1, 2, 3, 4]
    text_file(spark, f"{base}/c", ["place,1/2/20,1/1/20", "z,5,6"])
    with pytest.raises(Exception, match="(?i)header|schema"):
        wide_to_long(read_wide(spark, f"{base}/*"), ["place"]).collect()


def test_fill_identity(spark):
    frame = spark.createDataFrame([(None, None, 1), ("a", "b", None)], "`p/s` string, c string, v bigint")
    out = [tuple(r) for r in fill_identity(frame, ["p/s", "c"], "-").collect()]
    assert out == [("-", "-", 1), ("a", "b", None)]
    with pytest.raises(ValueError):
        fill_identity(frame, "zz")


def test_partitioned_write_makes_few_files(spark):
    frame = spark.range(0, 2000, 1, 8).select((F.col("id") % 5).alias("k"), F.col("id").alias("v"))
    path = shared_scratch_path(spark, "few-files")
    write_snapshot(frame, path, partition_cols=["k"], sort_cols=[F.col("v").desc()])
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{path}/k=*/part-*")
    found = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(root)
    assert len(list(found)) <= 10  # not one per task and folder
    assert spark.read.option("header", True).csv(path).count() == 2000


def test_input_bytes_accepts_globs(spark):
    base = shared_scratch_path(spark, "globs")
    text_file(spark, f"{base}/a", ["abc"])
    text_file(spark, f"{base}/b", ["defgh"])
    assert input_bytes(spark, [f"{base}/*"]) >= 10
    with pytest.raises(FileNotFoundError):
        input_bytes(spark, [f"{base}/none*"])


def test_published_versions(spark):
    source, table = shared_scratch_path(spark, "feed"), shared_scratch_path(spark, "published")
    with pytest.raises(FileNotFoundError):
        read_published(spark, table)
    state = shared_scratch_path(spark, "feed-state")
    for day in (22, 23, 24, 25):
        text_file(spark, f"{source}/d{day}", [HEADER, f"1,01/{day}/2020,Ohio,US,x,1,0,0"])
        publish(running_totals(observation_stream(spark, f"{source}/*"), "country"), table, state).awaitTermination()
        assert rows(read_published(spark, table), "total_confirmed") == [(day - 21,)]
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{table}/version=*")
    assert len(root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(root)) <= 2


class _NoDir:
    master = "spark://cluster:7077"

    def getCheckpointDir(self):
        return None


class _Cluster:
    sparkContext = _NoDir()

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Cluster())
    _Cluster.sparkContext.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(_Cluster())


def test_scratch_is_cleared(spark):
    table = write_scratch(spark.range(5), "cleared")
    path = table.inputFiles()[0].rpartition("/")[0]
    assert table.count() == 5 and spark.read.parquet(path).count() == 5
    assert clear_scratch(spark) >= 1
    with pytest.raises(Exception, match="(?i)not.*exist|infer"):
        spark.read.parquet(path)
