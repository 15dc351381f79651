"""The whole-application job on tiny files in the original layouts."""

from decimal import Decimal

from conftest import d, rows

from epipanel.plans.report import case_report, write_report
from epipanel.session import shared_scratch_path

OBS = [
    "SNo,ObservationDate,Province/State,Country/Region,Last Update,Confirmed,Deaths,Recovered",
    "1,01/22/2020,Washington,US,x,1.0,0.0,0.0",
    "2,01/23/2020,Washington,US,x,1.0,0.0,0.0",
    "3,01/24/2020,Washington,US,x,4.0,1.0,1.0",
    "4,01/24/2020,New York,US,x,2.0,0.0,0.0",
    "5,01/25/2020,New York,US,x,5.0,2.0,1.0",
    "6,01/22/2020,,Japan,x,2.0,0.0,0.0",
    "7,01/24/2020,,Japan,x,3.0,1.0,0.0",
]
US_HEAD = "UID,iso2,iso3,code3,FIPS,Admin2,Province_State,Country_Region,Lat,Long_,Combined_Key"
CONFIRMED_US = [
    US_HEAD + ",1/22/20,1/23/20,1/24/20",
    '1,US,USA,840,4013,Maricopa,Arizona,US,33.3,-112.5,"Maricopa, Arizona, US",0,1,3',
    '2,US,USA,840,4019,Pima,Arizona,US,32.1,-111.8,"Pima, Arizona, US",0,0,2',
    '3,US,USA,840,53033,King,Washington,US,47.5,-121.8,"King, Washington, US",1,1,4',
]
DEATHS_US = [
    US_HEAD + ",Population,1/22/20,1/23/20,1/24/20",
    '1,US,USA,840,4013,Maricopa,Arizona,US,33.3,-112.5,"Maricopa, Arizona, US",60,0,0,0',
    '3,US,USA,840,53033,King,Washington,US,47.5,-121.8,"King, Washington, US",100,0,0,1',
    '4,US,USA,840,36061,New York,New York,US,40.7,-74.0,"New York, New York, US",50,0,0,0',
]
WORLD = [
    "Province/State,Country/Region,Lat,Long,1/22/20,1/23/20,1/24/20",
    ",Peru,-9,-75,5,7,10",
    "Hubei,Mainland China,30,112,444,444,549",
]


def put(spark, name, lines):
    path = shared_scratch_path(spark, name)
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(path)
    return path


def test_report_end_to_end(spark):
    res = case_report(
        spark,
        put(spark, "obs", OBS),
        put(spark, "cus", CONFIRMED_US),
        put(spark, "dus", DEATHS_US),
        put(spark, "world", WORLD),
        ["US", "Japan", "Peru"],
    )
    rel = rows(res["relationship_states"], "state", "case_fatality_ratio", "mortality_ratio", "case_recovery_ratio")
    assert sorted(rel) == [("New York", 0.29, 0.04, 0.14), ("Washington", 0.17, 0.01, 0.17)]
    assert [r.country for r in res["most_infected_countries"].collect()] == ["US", "Japan"]

    inc = res["increments_us"].where("Admin2 = 'Maricopa'").first()
    assert (inc["1/22/20"], inc["1/23/20"], inc["1/24/20"]) == (0, 1, 2)

    world = rows(res["spikes_world"], "Province/State", "Country/Region", "count_high_days", "highest_daily_value")
    assert world == [("Hubei", "Mainland China", 1, 444), (None, "Peru", 1, 5)]

    ext = {(r.Province_State, r.stat): (r.date, r.value) for r in res["growth_extremes_us"].collect()}
    assert ext[("Arizona", "max")] == (d("1/24/20"), 200.0)
    assert ext[("Arizona", "greatest_avg")] == (d("1/24/20"), 100.0)
    assert ext[("Arizona", "min")] == (d("1/23/20"), 0.0)  # tie -> earliest
    assert ext[("Washington", "max")] == (d("1/24/20"), 300.0)

    out = shared_scratch_path(spark, "report-out")
    write_report(res, out)
    back = spark.read.option("header", True).csv(f"{out}/growth_snapshots_us")
    maxes = back.where("state = 'Arizona' AND stat = 'max'")
    assert sorted(rows(maxes, "location", "delta")) == [("Maricopa, Arizona, US", "200.00"), ("Pima, Arizona, US", "0.00")]
    assert back.count() == 6 * 2 + 6 * 1
    assert Decimal(back.where("state = 'Washington' AND stat = 'max'").first()["delta"]) == Decimal("300.00")


def test_report_command_line(spark):
    from epipanel.plans.report import main

    out = shared_scratch_path(spark, "report-cli")
    main([
        "--observations", put(spark, "obs2", OBS),
        "--confirmed-us", put(spark, "cus2", CONFIRMED_US),
        "--deaths-us", put(spark, "dus2", DEATHS_US),
        "--confirmed-world", put(spark, "world2", WORLD),
        "--countries", put(spark, "countries", ["US", "Japan", ""]),
        "--out", out,
    ])
    rel = spark.read.option("header", True).csv(f"{out}/relationship_countries")
    assert sorted(r.country for r in rel.collect()) == ["Japan", "US"]


def test_summary_gives_what_the_observations_give(spark):
    """Totals, ratios and first dates from one stored row a place."""
    from epipanel.operators import accumulate, outcome_ratios
    from epipanel.operators.occurrence import place_summary, ratios_of_summary, totals_of_summary
    from pyspark.sql import functions as F

    data = [
        (d("1/22/20"), "Washington", "US", 1, 0, 0), (d("1/24/20"), "Washington", "US", 4, 1, 1), (d("1/21/20"), "Washington", "Elsewhere", 9, 9, 0),
        (None, "Washington", "US", 7, 7, 7), (d("1/22/20"), None, "Japan", 2, 0, 0), (d("1/22/20"), "Tokyo", "Japan", 1, 1, None),
        (d("1/23/20"), "New York", "US", 0, 0, 0), (d("1/25/20"), "New York", "US", 5, None, 1), (d("1/25/20"), "New York", "US", 3, 2, 1),
    ]
    obs = spark.createDataFrame(data, "obs_date date, state string, country string, confirmed bigint, deaths bigint, recovered bigint")
    summary = place_summary(obs)
    for entity, names, extra in (("country", ["US", "Japan"], {"tie_break": ["state"]}), ("state", ["Washington", "New York", "Tokyo"], {"first_where": F.col("country") == "US"})):
        same = lambda a, b: sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
        assert same(totals_of_summary(summary, entity, names), accumulate(obs, entity, names))
        assert same(ratios_of_summary(summary, entity, names, **extra), outcome_ratios(obs, entity, names, **extra))
    assert totals_of_summary(place_summary(obs.limit(0)), "country").collect() == []


def test_comparison_report(spark):
    from epipanel.plans.report import comparison_report

    res = comparison_report(spark, put(spark, "cus3", CONFIRMED_US), put(spark, "dus3", DEATHS_US), k=1)
    near = {r["place"]: r["neighbour"] for r in res["nearest_places"].collect()}
    assert near["Maricopa, Arizona, US"] == "Pima, Arizona, US"
    first = {r["place"]: r["days_after"] for r in res["first_against_neighbours"].collect()}
    assert first["Maricopa, Arizona, US"] == -1 and first["Pima, Arizona, US"] == 1
    assert {r["level"] for r in res["growth_level_stats"].collect()} == {"all", "country", "state"}
    assert {r["class"] for r in res["growth_by_class"].collect()} <= {"rural", "mixed", "urban", None}
    out = shared_scratch_path(spark, "compare-out")
    write_report(res, out)
    assert spark.read.option("header", True).csv(f"{out}/season_spike_rates").count() == 1
