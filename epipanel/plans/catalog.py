"""Named queries: each reads the test tables of one scale factor and runs
one operator of the package on them. ``queries()`` maps a name to a
callable ``(spark, sf_dir) -> DataFrame``; ``epipanel.plans.oracle`` holds
the matching SQL for an independent engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.operators import (
    accumulate,
    change_over_time,
    densify,
    fill_identity,
    first_occurrence,
    growth_daily_stats,
    growth_extreme_report,
    growth_extremes,
    growth_factor,
    increments,
    keep_entities,
    least_infected,
    local_spikes,
    long_to_wide,
    most_infected,
    outcome_ratios,
    percent_change,
    population_rollup,
    relationship,
    shift_observed_date,
    spike_days,
    spike_lengths,
    wide_growth_extreme_report,
    wide_growth_factor,
    wide_increment_table,
    wide_increments,
    wide_local_spikes,
    wide_percent_change,
    wide_percent_change_table,
    wide_to_long,
)
from epipanel.functions.dates import parse_mdy_name
from epipanel.plans.joins import materialize
from epipanel.sources import proxies
from epipanel.sources.files import read_observations, read_snapshot, read_wide, write_snapshot
from epipanel.session import shared_scratch_path
from epipanel.streaming import (
    observation_stream,
    publish,
    read_published,
    running_first_occurrence,
    running_outcome_ratios,
    running_totals,
)

# Fixed parameters of the stand-in queries (the test tables have nations
# and regions where the case files have states and countries).
STATE_ALLOW = tuple(f"NATION_{i}" for i in range(20))          # NATION_20..24 left out
COUNTRY_ALLOW = ("AFRICA", "AMERICA", "ASIA", "EUROPE")         # MIDDLE EAST left out
STATE_COUNTRY = "AMERICA"                                       # states are those of one country
TARGET_CONTAINS = "_1"
TARGET_SUFFIX = "_1"
CHANGE_START = "2024-01-05"
CHANGE_DAYS = 14
SHIFT_START = "1995-03-01"
SHIFT_DAYS = 14

PANEL_GROUP = ["grp"]
PANEL_ENTITY = ["grp", "location"]

Query = Callable[[SparkSession, str], DataFrame]


# ---- growth family ---------------------------------------------------------

def q_growth_factor(spark, sf):
    return growth_factor(proxies.user_panel(spark, sf), PANEL_ENTITY)


def q_growth_daily_stats(spark, sf):
    return growth_daily_stats(q_growth_factor(spark, sf), PANEL_GROUP)


def q_growth_daily_stats_sketch(spark, sf):
    """Per-date statistics with the original's quantile sketch for the median."""
    return growth_daily_stats(q_growth_factor(spark, sf), PANEL_GROUP, median="sketch")


def q_growth_extremes(spark, sf):
    return growth_extremes(q_growth_daily_stats(spark, sf), PANEL_GROUP)


def q_growth_extreme_snapshots(spark, sf):
    return growth_extreme_report(proxies.user_panel(spark, sf), PANEL_GROUP, ["location"])


def _increment_panel(spark, sf):
    inc = increments(proxies.user_panel(spark, sf), PANEL_ENTITY)
    return inc.withColumnRenamed("increment", "value")


def q_growth_factor_of_increment(spark, sf):
    return growth_factor(_increment_panel(spark, sf), PANEL_ENTITY)


def q_growth_extremes_of_increment(spark, sf):
    stats = growth_daily_stats(q_growth_factor_of_increment(spark, sf), PANEL_GROUP)
    return growth_extremes(stats, PANEL_GROUP)


def _single_extreme(which: str) -> Query:
    def run(spark, sf):
        return growth_extreme_report(proxies.user_panel(spark, sf), PANEL_GROUP, ["location"], which=(which,))

    run.__name__ = f"q_growth_{which}"
    return run


# ---- daily series ----------------------------------------------------------

def q_daily_increment(spark, sf):
    return increments(proxies.user_panel(spark, sf), PANEL_ENTITY)


def q_percent_change(spark, sf):
    return percent_change(proxies.user_panel(spark, sf), PANEL_ENTITY)


def q_percent_change_of_increment(spark, sf):
    return percent_change(_increment_panel(spark, sf), PANEL_ENTITY)


def q_local_spikes_us(spark, sf):
    step = increments(proxies.type_panel(spark, sf), ["combined_key"])
    return local_spikes(step, ["combined_key"])


def q_local_spikes_world(spark, sf):
    step = increments(proxies.world_panel(spark, sf), ["province", "country"])
    return local_spikes(step, ["province", "country"])


def q_local_spikes_threshold_095(spark, sf):
    step = increments(proxies.type_panel(spark, sf), ["combined_key"])
    return local_spikes(step, ["combined_key"], threshold=0.95)


def q_spike_days(spark, sf):
    """The dates that the spike count stands for, in a panel with empty cells."""
    return spike_days(q_gap_daily_increment(spark, sf), PANEL_ENTITY)


def q_spike_lengths(spark, sf):
    """Runs of days at half the highest increment or more."""
    return spike_lengths(q_gap_daily_increment(spark, sf), PANEL_ENTITY)


def q_change_over_time(spark, sf):
    return change_over_time(proxies.user_panel(spark, sf), PANEL_ENTITY, CHANGE_START, CHANGE_DAYS)


def q_shift_observed_date(spark, sf):
    return shift_observed_date(proxies.observations(spark, sf), "obs_date", SHIFT_START, SHIFT_DAYS)


# ---- observations: cleansing, first occurrences, totals --------------------

def q_cleanse_states(spark, sf):
    return keep_entities(proxies.observations(spark, sf), "state", STATE_ALLOW)


def q_cleanse_countries(spark, sf):
    return keep_entities(proxies.observations(spark, sf), "country", COUNTRY_ALLOW)


def _first_country(spark, sf, measure, obs=None):
    obs = proxies.observations(spark, sf) if obs is None else obs
    first = first_occurrence(obs, measure, "country", tie_break=["state"])
    return keep_entities(first, "country", COUNTRY_ALLOW)


def _first_state(spark, sf, measure, obs=None):
    obs = proxies.observations(spark, sf) if obs is None else obs
    first = first_occurrence(obs.where(F.col("country") == STATE_COUNTRY), measure, "state", tie_break=["country"])
    return keep_entities(first, "state", STATE_ALLOW)


def q_first_confirmed_country(spark, sf):
    return _first_country(spark, sf, "confirmed")


def q_first_confirmed_state(spark, sf):
    return _first_state(spark, sf, "confirmed")


def q_first_deaths_country(spark, sf):
    return _first_country(spark, sf, "deaths")


def q_first_deaths_state(spark, sf):
    return _first_state(spark, sf, "deaths")


def q_first_occurrence_target(spark, sf):
    return first_occurrence(
        proxies.observations(spark, sf), "confirmed", "state", tie_break=["country"], target=TARGET_CONTAINS
    )


def q_accum_country(spark, sf):
    return accumulate(proxies.observations(spark, sf), "country", COUNTRY_ALLOW)


def q_accum_state(spark, sf):
    return accumulate(proxies.observations(spark, sf), "state", STATE_ALLOW)


def q_accum_country_latest(spark, sf):
    """Country totals as the sum of each state's latest values."""
    return accumulate(proxies.observations(spark, sf), "country", COUNTRY_ALLOW, mode="latest", within=["state"])


def q_accum_target(spark, sf):
    return accumulate(proxies.observations(spark, sf), "state", STATE_ALLOW, target=TARGET_SUFFIX)


def q_population_rollup(spark, sf):
    return population_rollup(proxies.population(spark, sf), allowed=STATE_ALLOW)


def q_top10_country(spark, sf):
    return most_infected(q_accum_country(spark, sf), "country")


def q_bottom10_country(spark, sf):
    return least_infected(q_accum_country(spark, sf), "country")


def q_top10_state(spark, sf):
    return most_infected(q_accum_state(spark, sf), "state")


def q_bottom10_state(spark, sf):
    return least_infected(q_accum_state(spark, sf), "state")


def q_relationship_country(spark, sf):
    """Two first dates and three totals per country from one aggregation."""
    return outcome_ratios(proxies.observations(spark, sf), "country", COUNTRY_ALLOW, tie_break=["state"])


def q_relationship_state(spark, sf):
    return outcome_ratios(
        proxies.observations(spark, sf),
        "state",
        STATE_ALLOW,
        tie_break=["country"],
        first_where=F.col("country") == STATE_COUNTRY,
        population=q_population_rollup(spark, sf),
    )


def q_relationship_state_joined(spark, sf):
    """The same result composed as in the original: first occurrences and
    totals computed separately (from one materialised daily table), then
    joined."""
    obs = materialize(proxies.observations(spark, sf))
    return relationship(
        _first_state(spark, sf, "confirmed", obs),
        _first_state(spark, sf, "deaths", obs),
        accumulate(obs, "state", STATE_ALLOW),
        "state",
        population=q_population_rollup(spark, sf),
    )


# ---- the same analyses straight on wide tables (no shuffle) ---------------

def _wide_user_panel(spark, sf):
    """Stand-in wide file: the user panel pivoted to ``M/d/yy`` columns."""
    return long_to_wide(proxies.user_panel(spark, sf), PANEL_ENTITY)


def q_wide_growth_factor(spark, sf):
    return wide_growth_factor(_wide_user_panel(spark, sf), PANEL_ENTITY)


def q_wide_growth_extremes(spark, sf):
    stats = growth_daily_stats(q_wide_growth_factor(spark, sf), PANEL_GROUP)
    return growth_extremes(stats, PANEL_GROUP)


def q_wide_growth_extreme_snapshots(spark, sf):
    return wide_growth_extreme_report(_wide_user_panel(spark, sf), PANEL_ENTITY, PANEL_GROUP)


def q_wide_daily_increment(spark, sf):
    return wide_increments(_wide_user_panel(spark, sf), PANEL_ENTITY)


def q_wide_percent_change(spark, sf):
    return wide_percent_change(_wide_user_panel(spark, sf), PANEL_ENTITY)


def q_wide_local_spikes_us(spark, sf):
    wide = long_to_wide(proxies.type_panel(spark, sf), ["combined_key"])
    return wide_local_spikes(wide, ["combined_key"], ["combined_key"], cumulative=True)


def q_wide_local_spikes_world(spark, sf):
    keys = ["province", "country"]
    wide = long_to_wide(proxies.world_panel(spark, sf), keys)
    return wide_local_spikes(wide_increment_table(wide, keys), keys, keys)  # the original's two steps


# ---- null groups and empty cells -------------------------------------------

def q_gap_daily_increment(spark, sf):
    """Increments over empty cells, in a panel with a null group."""
    return increments(proxies.gap_panel(spark, sf), PANEL_ENTITY)


def q_gap_percent_change(spark, sf):
    return percent_change(proxies.gap_panel(spark, sf), PANEL_ENTITY)


def q_gap_local_spikes(spark, sf):
    return local_spikes(q_gap_daily_increment(spark, sf), PANEL_ENTITY)


def q_gap_growth_extreme_snapshots(spark, sf):
    return growth_extreme_report(proxies.gap_panel(spark, sf), PANEL_GROUP, ["location"])


def _wide_gap_panel(spark, sf):
    return long_to_wide(proxies.gap_panel(spark, sf), PANEL_ENTITY)


def q_wide_gap_daily_increment(spark, sf):
    return wide_increments(_wide_gap_panel(spark, sf), PANEL_ENTITY)


def q_wide_gap_local_spikes(spark, sf):
    return wide_local_spikes(_wide_gap_panel(spark, sf), PANEL_ENTITY, PANEL_ENTITY, cumulative=True)


def q_wide_gap_growth_extreme_snapshots(spark, sf):
    return wide_growth_extreme_report(_wide_gap_panel(spark, sf), PANEL_ENTITY, PANEL_GROUP)


def q_densify_null_entity(spark, sf):
    """One state without a name, and one day's records without a date."""
    obs = proxies.observations(spark, sf).select(
        F.nullif("state", F.lit("NATION_3")).alias("state"),
        F.nullif("obs_date", F.lit(SHIFT_START).cast("date")).alias("obs_date"),
        "confirmed",
    )
    return densify(obs, ["state"], "obs_date")


def q_population_text(spark, sf):
    return population_rollup(proxies.population_text(spark, sf), allowed=STATE_ALLOW)


def q_fill_identity(spark, sf):
    return fill_identity(proxies.gap_panel(spark, sf), "grp")


def q_cleanse_states_table(spark, sf):
    """An allow-list given as a table (the nations of one region)."""
    allowed = proxies.geography(spark, sf).where(F.col("country") == STATE_COUNTRY).select("state")
    return keep_entities(proxies.observations(spark, sf), "state", allowed)


# ---- reshape and files -----------------------------------------------------

def q_densify_observations(spark, sf):
    """Every state on every day from the first to the last observation;
    counts stay empty on days without a record."""
    obs = proxies.observations(spark, sf).select("state", "obs_date", "confirmed")
    return densify(obs, ["state"], "obs_date")


def q_long_to_wide(spark, sf):
    return long_to_wide(
        proxies.user_panel(spark, sf), PANEL_ENTITY, name_of=lambda d: d.strftime("d%Y%m%d")
    )


def _by_day(wide):
    """Date columns named ``dYYYYMMDD`` instead of ``M/d/yy``."""
    ids = len(PANEL_ENTITY)
    days = [parse_mdy_name(c) for c in wide.columns[ids:]]
    return wide.toDF(*PANEL_ENTITY, *[d.strftime("d%Y%m%d") for d in days])


def q_wide_increment_table(spark, sf):
    return _by_day(wide_increment_table(_wide_gap_panel(spark, sf), PANEL_ENTITY))


def q_wide_percent_change_table(spark, sf):
    return _by_day(wide_percent_change_table(_wide_gap_panel(spark, sf), PANEL_ENTITY))


def q_wide_round_trip(spark, sf):
    """Region totals of all dates, those of the last century included: long ->
    wide ``M/d/yy`` CSV of some 2,400 columns -> long."""
    days = proxies.observations(spark, sf)
    panel = days.groupBy("country", F.col("obs_date").alias("date")).agg(F.sum("confirmed").alias("value"))
    path = shared_scratch_path(spark, "wide-csv-all")
    write_snapshot(long_to_wide(panel, ["country"]), path)
    return wide_to_long(read_wide(spark, path), ["country"]).where("value IS NOT NULL")


def _single_file(header: bool) -> Query:
    def run(spark, sf):
        path = shared_scratch_path(spark, "single-file")
        write_snapshot(q_accum_state(spark, sf), path, header=header, single_file=True)
        schema = "state string, total_confirmed bigint, total_deaths bigint, total_recovered bigint"
        return spark.read.schema(schema).option("header", header).option("enforceSchema", not header).csv(path)

    run.__name__ = "q_single_file_header" if header else "q_single_file_no_header"
    return run


def q_wide_to_long(spark, sf):
    """Panel -> wide ``M/d/yy`` CSV file -> read back as text -> long panel."""
    wide = long_to_wide(proxies.user_panel(spark, sf), PANEL_ENTITY)
    path = shared_scratch_path(spark, "wide-csv")
    write_snapshot(wide, path)
    long = wide_to_long(read_wide(spark, path), PANEL_ENTITY)
    return long.select(
        *[F.col(c).try_cast("bigint").alias(c) for c in PANEL_ENTITY], "date", "value"
    )


def q_csv_round_trip(spark, sf):
    """Six extreme snapshots written as ``grp=/stat=`` CSV directories and
    read back with a declared schema."""
    snaps = q_growth_extreme_snapshots(spark, sf)
    path = shared_scratch_path(spark, "snapshots")
    write_snapshot(snaps, path, partition_cols=["grp", "stat"])
    schema = (
        "stat_value double, location bigint, prev_date date, prev_value bigint, "
        "date date, value bigint, delta decimal(8,2), grp bigint, stat string"
    )
    return read_snapshot(spark, path, schema)


def _write_original_observations(spark, sf, path: str, by_year: bool = False) -> None:
    """Observations in the original daily-file layout: text dates
    ``MM/dd/yyyy`` and counts written like ``5.0``. ``by_year`` writes one
    folder of files per year, as a feed that grows over time would."""
    obs = proxies.observations(spark, sf)
    original = obs.select(
        F.lit(None).cast("string").alias("SNo"),
        F.date_format("obs_date", "MM/dd/yyyy").alias("ObservationDate"),
        F.col("state").alias("Province/State"),
        F.col("country").alias("Country/Region"),
        F.lit(None).cast("string").alias("Last Update"),
        F.format_string("%d.0", "confirmed").alias("Confirmed"),
        F.format_string("%d.0", "deaths").alias("Deaths"),
        F.format_string("%d.0", "recovered").alias("Recovered"),
        F.year("obs_date").alias("year"),
    )
    if by_year:
        write_snapshot(original, path, partition_cols=["year"])
    else:
        write_snapshot(original.drop("year"), path)


def q_observations_csv(spark, sf):
    """Observations written in the original daily-file layout and parsed back."""
    path = shared_scratch_path(spark, "observations-csv")
    _write_original_observations(spark, sf, path)
    return read_observations(spark, path)


def _streamed(spark, sf, build):
    """Feed the original-layout files (one folder per year) through a file
    stream, four files per micro-batch (so state carries across batches),
    and return the published table."""
    source = shared_scratch_path(spark, "observation-feed")
    _write_original_observations(spark, sf, source, by_year=True)
    table = shared_scratch_path(spark, "stream-table")
    query = publish(build(observation_stream(spark, source, max_files_per_trigger=4)), table)
    query.awaitTermination()
    return read_published(spark, table)


def q_streaming_accum_state(spark, sf):
    return _streamed(spark, sf, lambda s: running_totals(s, "state", STATE_ALLOW))


def q_streaming_first_confirmed_country(spark, sf):
    first = _streamed(spark, sf, lambda s: running_first_occurrence(s, "confirmed", "country", tie_break=["state"]))
    return keep_entities(first, "country", COUNTRY_ALLOW)


def q_streaming_relationship_country(spark, sf):
    return _streamed(
        spark, sf, lambda s: running_outcome_ratios(s, "country", COUNTRY_ALLOW, tie_break=["state"])
    )


QUERIES: dict[str, Query] = {
    # growth family (flagship)
    "growth_factor": q_growth_factor,
    "growth_daily_stats": q_growth_daily_stats,
    "growth_daily_stats_sketch": q_growth_daily_stats_sketch,
    "growth_extremes": q_growth_extremes,
    "growth_extreme_snapshots": q_growth_extreme_snapshots,
    "growth_factor_of_increment": q_growth_factor_of_increment,
    "growth_extremes_of_increment": q_growth_extremes_of_increment,
    "growth_greatest_median": _single_extreme("greatest_median"),
    "growth_greatest_avg": _single_extreme("greatest_avg"),
    "growth_least_median": _single_extreme("least_median"),
    "growth_least_avg": _single_extreme("least_avg"),
    "growth_max": _single_extreme("max"),
    "growth_min": _single_extreme("min"),
    # daily series
    "daily_increment": q_daily_increment,
    "percent_change": q_percent_change,
    "percent_change_of_increment": q_percent_change_of_increment,
    "local_spikes_us": q_local_spikes_us,
    "local_spikes_world": q_local_spikes_world,
    "local_spikes_threshold_095": q_local_spikes_threshold_095,
    "spike_days": q_spike_days,
    "spike_lengths": q_spike_lengths,
    "change_over_time": q_change_over_time,
    "shift_observed_date": q_shift_observed_date,
    # observations
    "cleanse_states": q_cleanse_states,
    "cleanse_countries": q_cleanse_countries,
    "first_confirmed_country": q_first_confirmed_country,
    "first_confirmed_state": q_first_confirmed_state,
    "first_deaths_country": q_first_deaths_country,
    "first_deaths_state": q_first_deaths_state,
    "first_occurrence_target": q_first_occurrence_target,
    "accum_country": q_accum_country,
    "accum_state": q_accum_state,
    "accum_target": q_accum_target,
    "accum_country_latest": q_accum_country_latest,
    "population_rollup": q_population_rollup,
    "top10_country": q_top10_country,
    "bottom10_country": q_bottom10_country,
    "top10_state": q_top10_state,
    "bottom10_state": q_bottom10_state,
    "relationship_country": q_relationship_country,
    "relationship_state": q_relationship_state,
    "relationship_state_joined": q_relationship_state_joined,
    # wide tables, no shuffle
    "wide_growth_factor": q_wide_growth_factor,
    "wide_growth_extremes": q_wide_growth_extremes,
    "wide_growth_extreme_snapshots": q_wide_growth_extreme_snapshots,
    "wide_daily_increment": q_wide_daily_increment,
    "wide_percent_change": q_wide_percent_change,
    "wide_local_spikes_us": q_wide_local_spikes_us,
    "wide_local_spikes_world": q_wide_local_spikes_world,
    # null groups and empty cells
    "gap_daily_increment": q_gap_daily_increment,
    "gap_percent_change": q_gap_percent_change,
    "gap_local_spikes": q_gap_local_spikes,
    "gap_growth_extreme_snapshots": q_gap_growth_extreme_snapshots,
    "wide_gap_daily_increment": q_wide_gap_daily_increment,
    "wide_gap_local_spikes": q_wide_gap_local_spikes,
    "wide_gap_growth_extreme_snapshots": q_wide_gap_growth_extreme_snapshots,
    "densify_null_entity": q_densify_null_entity,
    "population_text": q_population_text,
    "fill_identity": q_fill_identity,
    "cleanse_states_table": q_cleanse_states_table,
    # reshape and files
    "wide_increment_table": q_wide_increment_table,
    "wide_percent_change_table": q_wide_percent_change_table,
    "wide_round_trip": q_wide_round_trip,
    "single_file_header": _single_file(True),
    "single_file_no_header": _single_file(False),
    "densify_observations": q_densify_observations,
    "long_to_wide": q_long_to_wide,
    "wide_to_long": q_wide_to_long,
    "csv_round_trip": q_csv_round_trip,
    "observations_csv": q_observations_csv,
    # structured streaming
    "streaming_accum_state": q_streaming_accum_state,
    "streaming_first_confirmed_country": q_streaming_first_confirmed_country,
    "streaming_relationship_country": q_streaming_relationship_country,
}


def queries() -> dict[str, Query]:
    from epipanel.plans import comparisons

    return {**QUERIES, **comparisons.QUERIES}
