"""The whole case-file analysis as one job over files in the original layouts.

    python -m epipanel.plans.report --observations obs.csv \\
        --confirmed-us confirmed_US.csv --deaths-us deaths_US.csv \\
        --confirmed-world confirmed_world.csv --countries countries.txt \\
        --out hdfs:///results/run-42

Produces every result of the original application (first-occurrence
relationships, most/least infected, increments, percent changes, local
spikes) plus the six growth-extreme snapshots of every US state. Each
result is a DataFrame; ``write_report`` stores them as CSV folders, the
growth snapshots partitioned ``state=<state>/stat=<statistic>``.

The wide time-series files are analysed row-locally (``operators.wide``):
no result of the original's shuffles the time series themselves. Every file is
read once: observations are reduced to one row per place, wide files are stored
with typed columns, and all results derive from these.

``--compare`` adds :func:`comparison_report`: places against their neighbours,
around holidays, by season, and growth by level and class of places.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.functions.allow_lists import US_STATES
from epipanel.operators import (
    growth_daily_stats,
    growth_factor,
    growth_extremes,
    least_infected,
    most_infected,
    population_rollup,
    spike_days,
    spike_lengths,
    wide_growth_factor,
    wide_increment_table,
    wide_increments,
    wide_local_spikes,
    wide_percent_change_table,
    wide_snapshots,
    wide_to_long,
)
from epipanel.operators.growth_levels import (
    compare_spike_lengths,
    growth_by_class,
    growth_level_stats,
    growth_moments,
    growth_statistics,
    population_classes,
)
from epipanel.operators.holidays import holiday_calendar, holiday_spike_rates
from epipanel.operators.neighbours import compare_with_neighbours, lagged_correlation, nearest_places
from epipanel.operators.occurrence import place_summary, ratios_of_summary, totals_of_summary
from epipanel.operators.seasons import season_spike_rates, seasonal_residuals
from epipanel.operators.wide import typed_wide
from epipanel.plans.joins import materialize
from epipanel.session import write_scratch
from epipanel.sources.files import read_observations, read_wide, write_snapshot
from epipanel.sources.uniform import load_uniform

# Identity columns of the wide files, by name (never by position).
US_IDS = ("UID", "iso2", "iso3", "code3", "FIPS", "Admin2", "Province_State",
          "Country_Region", "Lat", "Long_", "Combined_Key")
WORLD_IDS = ("Province/State", "Country/Region", "Lat", "Long")
US = "US"


def _ids_present(df: DataFrame, ids: Iterable[str]) -> list[str]:
    return [c for c in ids if c in df.columns] + (["Population"] if "Population" in df.columns else [])


def case_report(
    spark: SparkSession,
    observations_path: str,
    confirmed_us_path: str,
    deaths_us_path: str,
    confirmed_world_path: str,
    countries: Iterable[str] | DataFrame,
) -> dict[str, DataFrame]:
    """All results, keyed by name.

    The places' totals and first dates, the typed wide US file and the growth
    extremes are computed and stored in the shared checkpoint folder when this
    is called: several results are derived from each, and each input is
    parsed once. The other results are lazy.
    """
    summary = write_scratch(place_summary(read_observations(spark, observations_path)), "place-summary")
    raw_us = read_wide(spark, confirmed_us_path)
    us_ids = _ids_present(raw_us, US_IDS)
    confirmed_us = write_scratch(typed_wide(raw_us, us_ids), "confirmed-us")
    world = read_wide(spark, confirmed_world_path)
    world_ids = _ids_present(world, WORLD_IDS)

    totals_country = totals_of_summary(summary, "country", countries)
    totals_state = totals_of_summary(summary, "state", US_STATES)
    deaths_us = read_wide(spark, deaths_us_path)
    population = population_rollup(
        deaths_us.select(F.col("Province_State").alias("state"), F.col("Population").alias("population"))
    )

    growth = wide_growth_factor(confirmed_us, us_ids)
    extremes = materialize(growth_extremes(growth_daily_stats(growth, ["Province_State"]), ["Province_State"]))
    increments_us = wide_increment_table(confirmed_us, us_ids)

    return {
        "relationship_countries": ratios_of_summary(summary, "country", countries, tie_break=["state"]),
        "relationship_states": ratios_of_summary(
            summary, "state", US_STATES, first_where=F.col("country") == US, population=population
        ),
        "most_infected_countries": most_infected(totals_country, "country"),
        "least_infected_countries": least_infected(totals_country, "country"),
        "most_infected_states": most_infected(totals_state, "state"),
        "least_infected_states": least_infected(totals_state, "state"),
        "increments_us": increments_us,
        "percent_change_us": wide_percent_change_table(confirmed_us, us_ids),
        "percent_change_of_increments_us": wide_percent_change_table(increments_us, us_ids),
        "spikes_us": wide_local_spikes(confirmed_us, us_ids, ["Combined_Key"], cumulative=True),
        "spikes_world": wide_local_spikes(world, world_ids, ["Province/State", "Country/Region"], cumulative=True),
        "growth_extremes_us": extremes,
        "growth_snapshots_us": _snapshots(confirmed_us, extremes, us_ids),
    }


def _snapshots(confirmed_us: DataFrame, extremes: DataFrame, us_ids: list[str]) -> DataFrame:
    snaps = wide_snapshots(confirmed_us, extremes, us_ids, ["Province_State"])
    return snaps.select(
        F.col("Province_State").alias("state"),
        "stat",
        F.col("Combined_Key").alias("location"),
        "prev_date",
        "prev_value",
        "date",
        "value",
        "delta",
    )


def comparison_report(spark: SparkSession, confirmed_us_path: str, deaths_us_path: str | None = None, k: int = 4) -> dict[str, DataFrame]:
    """Places compared with each other, keyed by result name.

    Reads wide files of any layout (``sources.uniform``) with the columns place, state, country, lat and lon.
    With the deaths file's population, places are also cut into rural, mixed and urban thirds.
    The typed wide table, the daily increments and the neighbours are stored when this is called.
    """
    wide = load_uniform(spark, confirmed_us_path)
    ids = ["place", "state", "country", "lat", "lon"]
    wide = write_scratch(wide.select(*ids, *[F.col(f"`{c}`") for c in wide.columns if "/" in c]), "compare-wide")
    steps = write_scratch(wide_increments(wide, ids), "compare-steps")
    near = write_scratch(nearest_places(wide, "place", "lat", "lon", k), "compare-near")
    panel = wide_to_long(wide, ids)
    growth = write_scratch(growth_factor(panel.select("country", "state", "place", "date", "value"), ["country", "state", "place"]), "compare-growth")
    first = panel.where("value > 0").groupBy("place").agg(F.min("date").alias("date"))
    high = spike_days(steps, "place", threshold=0.95)
    flagged = steps.select("state", "place", "date").join(high.select("place", "date", F.lit(True).alias("high")), ["place", "date"], "left")
    years = steps.agg(F.min(F.year("date")), F.max(F.year("date"))).first()
    residuals = write_scratch(seasonal_residuals(steps, "place", value_col="increment", lat_col="lat"), "compare-residuals")
    results = {
        "nearest_places": near,
        "first_against_neighbours": compare_with_neighbours(first, near),
        "first_spike_against_neighbours": compare_with_neighbours(high, near),
        "lagged_correlation": lagged_correlation(steps, near, value_col="increment"),
        "holiday_spike_rates": holiday_spike_rates(flagged, holiday_calendar(spark, years[0] or 1900, years[1] or 1900), "state"),
        "seasonal_spikes": residuals.where("spike"),
        "season_spike_rates": season_spike_rates(residuals),
        "spike_length_ranks": compare_spike_lengths(spike_lengths(steps, ["state", "place"]), ["state", "place"], "state"),
        "growth_level_stats": growth_level_stats(growth, ["country", "state"]),
        "growth_more_stats": growth_statistics(growth_moments(growth, "state")),
    }
    if deaths_us_path is not None:
        people = load_uniform(spark, deaths_us_path, ["place", "population"])
        classes = population_classes(people.groupBy("place").agg(F.max("population").alias("population")), "population", "population")
        results["population_classes"] = classes
        results["growth_by_class"] = growth_by_class(growth, classes, "place")
    return results


def write_report(results: dict[str, DataFrame], out_dir: str, mode: str = "errorifexists") -> None:
    """Store each result as a CSV folder with a header under ``out_dir``.

    Growth snapshots go to ``state=/stat=`` folders, each file listing places
    by their previous-day count (descending) like the original's files. The
    order is applied within each write task: a state holding most places is
    written by many tasks (several sorted files), never funnelled into one.
    """
    for name, df in results.items():
        parts, order = [], []
        if name == "growth_snapshots_us":
            parts, order = ["state", "stat"], [F.col("prev_value").desc(), "location"]
        write_snapshot(df, f"{out_dir.rstrip('/')}/{name}", partition_cols=parts, mode=mode, sort_cols=order)


def _read_countries(spark: SparkSession, path: str) -> DataFrame:
    """One country name per line."""
    return spark.read.text(path).select(F.trim("value").alias("country")).where(F.col("country") != "")


def main(argv: list[str] | None = None) -> None:
    from epipanel.session import build_session, size_partitions_for

    parser = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    parser.add_argument("--observations", required=True)
    parser.add_argument("--confirmed-us", required=True)
    parser.add_argument("--deaths-us", required=True)
    parser.add_argument("--confirmed-world", required=True)
    parser.add_argument("--countries", required=True, help="text file, one country name per line")
    parser.add_argument("--out", required=True)
    parser.add_argument("--compare", action="store_true", help="also compare places with each other")
    args = parser.parse_args(argv)
    spark = build_session(app_name="epipanel-report")
    size_partitions_for(
        spark, [args.observations, args.confirmed_us, args.deaths_us, args.confirmed_world]
    )
    results = case_report(
        spark,
        args.observations,
        args.confirmed_us,
        args.deaths_us,
        args.confirmed_world,
        _read_countries(spark, args.countries),
    )
    if args.compare:
        results |= comparison_report(spark, args.confirmed_us, args.deaths_us)
    write_report(results, args.out)


if __name__ == "__main__":
    main()
