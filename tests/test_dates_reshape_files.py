"""Date shift (FIXTURES M6), date parsing, reshape round trips, CSV files."""

import datetime as dt

from conftest import d, rows
from pyspark.sql import functions as F

from epipanel.functions import parse_mdy_name, parse_observation_date
from epipanel.operators import long_to_wide, shift_observed_date, wide_to_long
from epipanel.session import shared_scratch_path
from epipanel.sources.files import read_observations, read_snapshot, read_wide, write_snapshot


def observed(spark):
    return spark.createDataFrame([(d("1/22/20"),), (d("2/28/20"),)], "obs_date date")


def test_m6_shift_observed_date(spark):
    df = observed(spark)
    assert rows(shift_observed_date(df, "obs_date", "1/22/20", 14), "shifted_date", "shifted_text") == [
        (d("2/5/20"), "2/5/20")
    ]
    assert rows(shift_observed_date(df, "obs_date", "1/22/20", -1), "shifted_text") == [("1/21/20",)]
    assert rows(shift_observed_date(df, "obs_date", "2/28/20", 1), "shifted_text") == [("2/29/20",)]
    assert shift_observed_date(df, "obs_date", "1/23/20", 14).count() == 0


def test_observation_date_formats(spark):
    df = spark.createDataFrame([("01/22/2020",), ("1/22/20",), ("12/31/2021",), ("junk",)], "t string")
    got = [r[0] for r in df.select(parse_observation_date("t")).collect()]
    assert got == [dt.date(2020, 1, 22), dt.date(2020, 1, 22), dt.date(2021, 12, 31), None]


def test_wide_column_names():
    assert parse_mdy_name("1/22/20") == dt.date(2020, 1, 22)
    assert parse_mdy_name("5/2/21") == dt.date(2021, 5, 2)
    assert parse_mdy_name("Combined_Key") is None
    assert parse_mdy_name("2/30/20") is None


def test_long_wide_long_is_identity(spark):
    long = spark.createDataFrame(
        [("a", d("1/22/20"), 1), ("a", d("1/23/20"), 3), ("b", d("1/22/20"), 0), ("b", d("1/23/20"), 2)],
        "loc string, date date, value bigint",
    )
    wide = long_to_wide(long, ["loc"])
    assert wide.columns == ["loc", "1/22/20", "1/23/20"]
    back = wide_to_long(wide, ["loc"])
    assert sorted(rows(back, "loc", "date", "value")) == sorted(rows(long, "loc", "date", "value"))


def test_wide_csv_round_trip(spark):
    wide = spark.createDataFrame(
        [("Maricopa, Arizona, US", "4013", "0", "1", "x")],
        "Combined_Key string, FIPS string, `1/22/20` string, `1/23/20` string, `1/24/20` string",
    )
    path = shared_scratch_path(spark, "test-wide")
    write_snapshot(wide, path)
    long = wide_to_long(read_wide(spark, path), ["Combined_Key", "FIPS"]).orderBy("date")
    assert rows(long, "date", "value") == [(d("1/22/20"), 0), (d("1/23/20"), 1), (d("1/24/20"), None)]


def test_observation_file_reader(spark):
    lines = [
        "SNo,ObservationDate,Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered",
        "1,01/22/2020,Anhui,Mainland China,1/22/2020 17:00,1.0,0.0,0.0",
        "2,01/22/2020,,Japan,1/22/2020 17:00,2.0,0.0,0.0",
    ]
    path = shared_scratch_path(spark, "test-obs")
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(path)
    obs = read_observations(spark, path)
    assert obs.columns == ["obs_date", "state", "country", "confirmed", "deaths", "recovered"]
    assert sorted(rows(obs, "state", "country", "confirmed"), key=str) == [
        ("Anhui", "Mainland China", 1),
        (None, "Japan", 2),
    ]
    assert {r.obs_date for r in obs.collect()} == {d("2020-01-22")}


def test_snapshot_writer_layout(spark):
    df = spark.createDataFrame(
        [("g1", "max", "a", 1.5), ("g1", "min", "b", -2.0), ("g2", "max", "c", 0.0)],
        "grp string, stat string, location string, delta double",
    )
    path = shared_scratch_path(spark, "test-snap")
    write_snapshot(df, path, partition_cols=["grp", "stat"])
    back = read_snapshot(spark, path, "location string, delta double, grp string, stat string")
    assert sorted(rows(back, "grp", "stat", "location", "delta")) == sorted(rows(df, "grp", "stat", "location", "delta"))
    assert back.where(F.col("grp") == "g1").count() == 2


def test_densify_fills_every_day(spark):
    from epipanel.operators import densify

    sparse = spark.createDataFrame(
        [("a", d("1/1/20"), 1), ("a", d("1/4/20"), 4), ("b", d("1/2/20"), 2)], "loc string, date date, value bigint"
    )
    dense = densify(sparse, ["loc"])
    got = sorted(rows(dense, "loc", "date", "value"), key=str)
    assert len(got) == 8  # 2 places x 4 days
    assert ("a", d("1/2/20"), None) in got and ("b", d("1/4/20"), None) in got
    assert ("a", d("1/4/20"), 4) in got


def test_snapshot_reader_rejects_misordered_schema(spark):
    import pytest

    df = spark.createDataFrame([("g1", "a", 1.5)], "grp string, location string, delta double")
    path = shared_scratch_path(spark, "test-snap-order")
    write_snapshot(df, path, partition_cols=["grp"])
    with pytest.raises(Exception):
        read_snapshot(spark, path, "delta double, location string, grp string").collect()


def test_partition_sizing():
    from epipanel.session import scale_conf

    tb = 1024**4
    assert scale_conf(tb)["spark.sql.shuffle.partitions"] == "4096"  # 1 TB / 256 MB
    assert scale_conf(100 * tb)["spark.sql.shuffle.partitions"] == "100000"  # capped
    assert scale_conf(1)["spark.sql.shuffle.partitions"] == "200"
    assert scale_conf(tb)["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 * 1024)


def test_long_to_wide_with_fixed_dates(spark):
    long = spark.createDataFrame(
        [("a", d("1/22/20"), 1), ("a", d("1/24/20"), 3), ("a", d("1/25/20"), 9)], "loc string, date date, value bigint"
    )
    # the schema is fixed by the list: 1/23/20 exists (empty), 1/25/20 is left out
    wide = long_to_wide(long, ["loc"], dates=[d("1/22/20"), d("1/23/20"), d("1/24/20")])
    assert wide.columns == ["loc", "1/22/20", "1/23/20", "1/24/20"]
    assert rows(wide, "1/22/20", "1/23/20", "1/24/20") == [(1, None, 3)]


def test_bad_inputs_are_rejected(spark):
    import pytest

    from epipanel.operators import like_entity, wide_growth_factor

    no_dates = spark.createDataFrame([("a", 1)], "k string, n int")
    with pytest.raises(ValueError):
        wide_to_long(no_dates, ["k"])
    with pytest.raises(ValueError):
        wide_growth_factor(no_dates, ["k"])
    with pytest.raises(ValueError):
        like_entity(no_dates, "k", "a", how="prefix")
