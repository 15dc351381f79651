"""DataFrame -> DataFrame analytic operators."""

from epipanel.operators.entities import fill_identity, keep_entities, like_entity
from epipanel.operators.growth import (
    EXTREMES,
    extreme_snapshots,
    growth_daily_stats,
    growth_extreme_report,
    growth_extremes,
    growth_factor,
    panel_snapshots,
)
from epipanel.operators.occurrence import (
    accumulate,
    first_occurrence,
    outcome_ratios,
    place_summary,
    population_rollup,
    ratios_of_summary,
    relationship,
    totals_of_summary,
)
from epipanel.operators.ranking import least_infected, most_infected
from epipanel.operators.reshape import densify, long_to_wide, wide_to_long
from epipanel.operators.wide import (
    typed_wide,
    wide_growth_extreme_report,
    wide_growth_factor,
    wide_increment_table,
    wide_increments,
    wide_local_spikes,
    wide_percent_change,
    wide_percent_change_table,
    wide_snapshots,
)
from epipanel.operators.series import (
    change_over_time,
    increments,
    local_spikes,
    percent_change,
    shift_observed_date,
    spike_days,
    spike_lengths,
)
from epipanel.operators.growth_levels import (
    compare_spike_lengths,
    growth_by_class,
    growth_level_stats,
    growth_moments,
    growth_statistics,
    merge_moments,
    population_classes,
)
from epipanel.operators.holidays import (
    holiday_calendar,
    holiday_spike_rates,
    interval_join,
)
from epipanel.operators.names import (
    match_names,
    match_places,
    rename_matched,
)
from epipanel.operators.neighbours import (
    compare_with_neighbours,
    lagged_correlation,
    nearest_places,
)
from epipanel.operators.ranges import (
    percent_rank,
    running_total,
)
from epipanel.operators.seasons import (
    season_spike_rates,
    seasonal_residuals,
)

__all__ = [
    "EXTREMES",
    "accumulate",
    "change_over_time",
    "compare_spike_lengths",
    "compare_with_neighbours",
    "densify",
    "extreme_snapshots",
    "fill_identity",
    "first_occurrence",
    "growth_by_class",
    "growth_daily_stats",
    "growth_extreme_report",
    "growth_extremes",
    "growth_factor",
    "growth_level_stats",
    "growth_moments",
    "growth_statistics",
    "holiday_calendar",
    "holiday_spike_rates",
    "increments",
    "interval_join",
    "keep_entities",
    "lagged_correlation",
    "least_infected",
    "like_entity",
    "local_spikes",
    "long_to_wide",
    "match_names",
    "match_places",
    "merge_moments",
    "most_infected",
    "nearest_places",
    "outcome_ratios",
    "panel_snapshots",
    "percent_change",
    "percent_rank",
    "place_summary",
    "population_classes",
    "population_rollup",
    "ratios_of_summary",
    "relationship",
    "rename_matched",
    "running_total",
    "season_spike_rates",
    "seasonal_residuals",
    "shift_observed_date",
    "spike_days",
    "spike_lengths",
    "totals_of_summary",
    "typed_wide",
    "wide_growth_extreme_report",
    "wide_growth_factor",
    "wide_increment_table",
    "wide_increments",
    "wide_local_spikes",
    "wide_percent_change",
    "wide_percent_change_table",
    "wide_snapshots",
    "wide_to_long",
]
