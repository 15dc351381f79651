"""First occurrences, totals, ratios and rankings (FIXTURES M5)."""

from conftest import d, rows
from pyspark.sql import functions as F

from epipanel.functions import parse_observation_date
from epipanel.operators import (
    accumulate,
    first_occurrence,
    keep_entities,
    least_infected,
    most_infected,
    population_rollup,
    relationship,
)

M5 = [
    ("01/22/2020", "Washington", "US", 1, 0, 0),
    ("01/23/2020", "Washington", "US", 1, 0, 0),
    ("01/24/2020", "Washington", "US", 4, 1, 1),
    ("01/23/2020", "New York", "US", 0, 0, 0),
    ("01/24/2020", "New York", "US", 2, 0, 0),
    ("01/25/2020", "New York", "US", 5, 2, 1),
    ("01/22/2020", None, "Japan", 2, 0, 0),
    ("01/24/2020", None, "Japan", 3, 1, 0),
    ("01/24/2020", "Atlantis", "Atlantis", 9, 9, 9),
]
COUNTRIES = ["US", "Japan"]


def observations(spark):
    raw = spark.createDataFrame(
        M5, "obs_text string, state string, country string, confirmed bigint, deaths bigint, recovered bigint"
    )
    return raw.select(parse_observation_date("obs_text").alias("obs_date"), *raw.columns[1:])


def test_allow_lists(spark):
    obs = observations(spark)
    assert sorted({r.country for r in keep_entities(obs, "country", COUNTRIES).collect()}) == ["Japan", "US"]
    states = keep_entities(obs, "state")  # default: the US state list
    assert sorted({r.state for r in states.collect()}) == ["New York", "Washington"]


def test_allow_list_as_dataframe(spark):
    allow = spark.createDataFrame([("Japan",)], "name string")
    got = keep_entities(observations(spark), "country", allow)
    assert {r.country for r in got.collect()} == {"Japan"}


def test_first_confirmed_and_deaths(spark):
    obs = observations(spark)
    states = keep_entities(first_occurrence(obs.where(F.col("country") == "US"), "confirmed", "state"), "state")
    assert sorted(rows(states, "state", "first_confirmed_date", "confirmed")) == [
        ("New York", d("2020-01-24"), 2),
        ("Washington", d("2020-01-22"), 1),
    ]
    countries = keep_entities(first_occurrence(obs, "confirmed", "country", tie_break=["state"]), "country", COUNTRIES)
    assert sorted(rows(countries, "country", "first_confirmed_date", "confirmed")) == [
        ("Japan", d("2020-01-22"), 2),
        ("US", d("2020-01-22"), 1),
    ]
    deaths = keep_entities(first_occurrence(obs, "deaths", "country", tie_break=["state"]), "country", COUNTRIES)
    assert sorted(rows(deaths, "country", "first_deaths_date", "deaths")) == [
        ("Japan", d("2020-01-24"), 1),
        ("US", d("2020-01-24"), 1),
    ]
    sdeaths = keep_entities(first_occurrence(obs, "deaths", "state"), "state")
    assert sorted(rows(sdeaths, "state", "first_deaths_date", "deaths")) == [
        ("New York", d("2020-01-25"), 2),
        ("Washington", d("2020-01-24"), 1),
    ]


def test_first_occurrence_target_contains(spark):
    got = first_occurrence(observations(spark), "confirmed", "state", target="York")
    assert [r.state for r in got.collect()] == ["New York"]


def test_totals(spark):
    obs = observations(spark)
    c = accumulate(obs, "country", COUNTRIES)
    assert sorted(rows(c, "country", "total_confirmed", "total_deaths", "total_recovered")) == [
        ("Japan", 5, 1, 0),
        ("US", 13, 3, 2),
    ]
    s = accumulate(obs, "state", allowed=__import__("epipanel").functions.US_STATES)
    assert sorted(rows(s, "state", "total_confirmed", "total_deaths", "total_recovered")) == [
        ("New York", 7, 2, 1),
        ("Washington", 6, 1, 1),
    ]
    suffix = accumulate(obs, "country", COUNTRIES, target="an")
    assert [r.country for r in suffix.collect()] == ["Japan"]


def test_population_and_relationship(spark):
    obs = observations(spark)
    pop = spark.createDataFrame(
        [("Washington", 60), ("Washington", 40), ("New York", 50), ("Atlantis", 7)], "state string, population int"
    )
    rolled = population_rollup(pop)
    assert sorted(rows(rolled, "state", "population")) == [("New York", 50), ("Washington", 100)]

    country_rel = relationship(
        first_occurrence(obs, "confirmed", "country", tie_break=["state"]),
        first_occurrence(obs, "deaths", "country", tie_break=["state"]),
        accumulate(obs, "country", COUNTRIES),
        "country",
    )
    assert sorted(rows(country_rel, "country", "case_fatality_ratio", "case_recovery_ratio")) == [
        ("Japan", 0.2, 0.0),
        ("US", 0.23, 0.15),
    ]
    us = obs.where(F.col("country") == "US")
    state_rel = relationship(
        first_occurrence(us, "confirmed", "state"),
        first_occurrence(us, "deaths", "state"),
        accumulate(obs, "state", allowed=["Washington", "New York"]),
        "state",
        population=rolled,
    )
    assert state_rel.columns == [
        "first_confirmed_date", "confirmed", "first_deaths_date", "deaths", "state",
        "case_fatality_ratio", "mortality_ratio", "case_recovery_ratio",
    ]
    assert sorted(rows(state_rel, "state", "case_fatality_ratio", "mortality_ratio", "case_recovery_ratio")) == [
        ("New York", 0.29, 0.04, 0.14),
        ("Washington", 0.17, 0.01, 0.17),
    ]


def test_rankings(spark):
    obs = observations(spark)
    c = accumulate(obs, "country", COUNTRIES)
    assert [r.country for r in most_infected(c, "country").collect()] == ["US", "Japan"]
    assert [r.country for r in least_infected(c, "country").collect()] == ["Japan", "US"]
    s = accumulate(obs, "state", allowed=["Washington", "New York"])
    assert rows(most_infected(s, "state", k=1), "state", "infected") == [("New York", 7)]


def test_zero_confirmed_gives_null_ratio(spark):
    first = spark.createDataFrame([("X", d("2020-01-01"), 1)], "e string, first_confirmed_date date, confirmed bigint")
    deaths = spark.createDataFrame([("X", d("2020-01-02"), 1)], "e string, first_deaths_date date, deaths bigint")
    totals = spark.createDataFrame([("X", 0, 1, 1)], "e string, total_confirmed bigint, total_deaths bigint, total_recovered bigint")
    r = relationship(first, deaths, totals, "e").first()
    assert r.case_fatality_ratio is None and r.case_recovery_ratio is None


def test_long_allow_list_becomes_semi_join(spark, monkeypatch):
    import epipanel.operators.entities as entities

    monkeypatch.setattr(entities, "INLIST_MAX", 1)
    got = entities.keep_entities(observations(spark), "country", COUNTRIES)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan
    assert sorted({r.country for r in got.collect()}) == ["Japan", "US"]


def test_single_pass_ratios_equal_composed(spark):
    from epipanel.operators import outcome_ratios

    obs = observations(spark)
    countries = outcome_ratios(obs, "country", COUNTRIES, tie_break=["state"])
    composed = relationship(
        keep_entities(first_occurrence(obs, "confirmed", "country", tie_break=["state"]), "country", COUNTRIES),
        keep_entities(first_occurrence(obs, "deaths", "country", tie_break=["state"]), "country", COUNTRIES),
        accumulate(obs, "country", COUNTRIES),
        "country",
    )
    assert countries.columns == composed.columns
    assert sorted(rows(countries, *countries.columns)) == sorted(rows(composed, *composed.columns))

    pop = spark.createDataFrame([("Washington", 100), ("New York", 50)], "state string, population bigint")
    states = outcome_ratios(
        obs, "state", ["Washington", "New York"], first_where=F.col("country") == "US", population=pop
    )
    assert sorted(rows(states, "state", "first_confirmed_date", "case_fatality_ratio", "mortality_ratio")) == [
        ("New York", d("2020-01-24"), 0.29, 0.04),
        ("Washington", d("2020-01-22"), 0.17, 0.01),
    ]


def test_totals_of_latest_values(spark):
    obs = observations(spark)
    latest = accumulate(obs, "country", COUNTRIES, mode="latest", within=["state"])
    assert sorted(rows(latest, "country", "total_confirmed", "total_deaths", "total_recovered")) == [
        ("Japan", 3, 1, 0),
        ("US", 9, 3, 2),
    ]
    import pytest

    with pytest.raises(ValueError):
        accumulate(obs, "country", COUNTRIES, mode="median")
