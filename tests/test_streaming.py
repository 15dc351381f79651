"""Streaming totals and first dates stay current as files arrive."""

from conftest import d, rows

from epipanel.session import shared_scratch_path
from epipanel.streaming import observation_stream, publish, read_published, running_first_occurrence, running_totals

HEADER = "SNo,ObservationDate,Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered"


def drop_file(spark, folder: str, name: str, lines: list[str]) -> None:
    df = spark.createDataFrame([(x,) for x in [HEADER, *lines]], "v string").coalesce(1)
    df.write.text(f"{folder}/{name}")


def test_totals_and_first_dates_follow_new_files(spark):
    source = shared_scratch_path(spark, "test-feed")
    table = shared_scratch_path(spark, "test-feed-table")
    firsts = shared_scratch_path(spark, "test-feed-firsts")
    ckpt_totals = shared_scratch_path(spark, "test-feed-ckpt")
    ckpt_firsts = shared_scratch_path(spark, "test-feed-ckpt2")

    drop_file(spark, source, "day1", ["1,01/22/2020,Washington,US,x,1.0,0.0,0.0", "2,01/22/2020,,Japan,x,2.0,0.0,0.0"])

    def run():
        stream = observation_stream(spark, f"{source}/*")
        publish(running_totals(stream, "country", ["US", "Japan"]), table, ckpt_totals).awaitTermination()
        publish(running_first_occurrence(stream, "deaths", "country"), firsts, ckpt_firsts).awaitTermination()

    run()
    assert sorted(rows(read_published(spark, table), "country", "total_confirmed")) == [("Japan", 2), ("US", 1)]
    assert read_published(spark, firsts).count() == 0  # no deaths yet

    drop_file(spark, source, "day2", ["3,01/23/2020,Washington,US,x,4.0,1.0,0.0", "4,01/23/2020,Atlantis,Atlantis,x,9,9,9"])
    run()
    assert sorted(rows(read_published(spark, table), "country", "total_confirmed", "total_deaths")) == [
        ("Japan", 2, 0),
        ("US", 5, 1),
    ]
    got = sorted(rows(read_published(spark, firsts), "country", "first_deaths_date", "deaths"))
    assert got == [("Atlantis", d("2020-01-23"), 9), ("US", d("2020-01-23"), 1)]
