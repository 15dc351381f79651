"""Growth factor and the dates of extreme growth across places.

The original computes the growth snapshot of one date at a time and loops
over every date on the driver, issuing four Spark actions per date to find
six extremes. Here the whole family is one declarative plan:

    panel --lag over entity--> growth rows (every entity, every date)
          --groupBy(group, date)--> per-date median / avg / max / min
          --groupBy(group), max/min of (stat, date) structs--> six extremes
    panel --only the extreme dates and the days before--> six snapshots

Scale notes
* The lag window is partitioned by (group, entity); an entity holds at most
  one row per date, so no window partition grows with the data volume.
* Per-date statistics come from a ``(group, date, delta) -> count``
  histogram, a hash aggregate combined map-side. The exact median is found
  in two steps, each over a fixed number of rows of a group and date: the
  histogram is folded into at most 12,208 buckets, the bucket that holds the
  median is found, and then the median among that bucket's 16,384 possible
  deltas. A group holding a third of all rows never lands in one task.
* Extremes are picked with ``max``/``min`` over ``struct(stat, day)`` in one
  aggregation over the small per-date table (sort-based, as struct buffers
  require; no window, no driver loop); ties go to the earliest date, as the
  original's strict comparison while walking dates upwards.
* The extremes table (six rows per group) is counted before it is
  broadcast; beyond the limit the join falls back to a shuffle join. With
  it known, the second reading of the panel keeps only the extreme dates
  and the days before them, reduced to one row per entity before the shuffle.
* Group columns may be null (a null province is normal): all joins on them
  are null-safe.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.functions.columns import as_list
from epipanel.functions.numeric import GROWTH_TYPE, growth_percent
from epipanel.plans.joins import BROADCAST_MAX_ROWS, checked_broadcast

# Fixed names of the six extremes, in the original's order of output files
# (greatestMed, greatestAvg, leastMed, leastAvg, max, min).
EXTREMES = (
    "greatest_median",
    "greatest_avg",
    "least_median",
    "least_avg",
    "max",
    "min",
)

# Fixed value: the original's quantile sketch has relative error 0.001,
# i.e. percentile_approx accuracy 1/0.001.
SKETCH_ACCURACY = 1000

# Deltas (decimal(8,2), counted in hundredths) per bucket of the median's first step.
MEDIAN_BUCKET = 1 << 14

# statistic column and direction of each extreme
_EXTREME_SPEC = {
    "greatest_median": ("median_delta", "greatest"),
    "greatest_avg": ("avg_delta", "greatest"),
    "least_median": ("median_delta", "least"),
    "least_avg": ("avg_delta", "least"),
    "max": ("max_delta", "greatest"),
    "min": ("min_delta", "least"),
}


def growth_factor(
    panel: DataFrame,
    entity_cols: str | Sequence[str],
    date_col: str = "date",
    value_col: str = "value",
) -> DataFrame:
    """Day-over-day growth percent of every entity on every date.

    Output: ``entity_cols..., prev_date, prev_value, date, value, delta``
    where ``delta = ((value / prev_value) - 1) * 100`` as decimal(8,2).

    * ``prev_value`` is the value of the previous *calendar* day. A missing
      previous day (a gap in a sparse panel) reads like an empty cell: 0.
    * Zero or missing previous values, missing values and results that do
      not fit decimal(8,2) all give ``delta = 0.00`` (e.g. 0 -> 1 is 0.00).
    * An entity's first row has nothing before it and gives no growth row
      (the first date of a dense panel has no growth, as in the original).

    The panel holds one row per entity and date (as unpivoted wide files
    do); combine duplicate rows first, e.g. ``groupBy(entity, date)``.
    """
    entity_cols = as_list(entity_cols)
    w = Window.partitionBy(*entity_cols).orderBy(date_col)
    lagged = panel.select(
        *entity_cols,
        F.col(date_col),
        F.col(value_col),
        F.lag(date_col).over(w).alias("_prev_row_date"),
        F.lag(value_col).over(w).alias("_prev_row_value"),
    )
    day_before = F.date_sub(F.col(date_col), 1)
    with_prev = lagged.where(F.col("_prev_row_date").isNotNull()).select(
        *entity_cols,
        F.col(date_col),
        F.col(value_col),
        F.when(F.col("_prev_row_date") == day_before, F.col("_prev_row_value")).alias("_prev_value"),
    )
    zero = F.lit(0).cast(panel.schema[value_col].dataType)
    return with_prev.select(
        *entity_cols,
        F.date_sub(F.col(date_col), 1).alias("prev_date"),
        F.coalesce(F.col("_prev_value"), zero).alias("prev_value"),
        F.col(date_col).alias("date"),
        F.coalesce(F.col(value_col), zero).alias("value"),
        growth_percent(F.col(value_col), F.col("_prev_value")).alias("delta"),
    )


def growth_daily_stats(
    growth: DataFrame,
    group_cols: str | Sequence[str] = (),
    date_col: str = "date",
    delta_col: str = "delta",
    median: str = "exact",
) -> DataFrame:
    """Across-entity statistics of the growth of each group and date.

    Output: ``group_cols..., date, median_delta, avg_delta, max_delta,
    min_delta, n_entities``. The median is the exact lower median (the
    smallest delta whose cumulative share reaches one half; of ``1, 2, 3,
    4`` it is 2, like the original's quantile sketch). ``avg_delta`` is the
    exact decimal average (6 places, HALF_UP) shown as a double.

    Computed from a value histogram, so no task ever holds a group's rows:
    ``(group, date, delta) -> count`` is a hash aggregate combined map-side
    and spread by the delta value itself. It is folded into buckets of
    ``MEDIAN_BUCKET`` neighbouring deltas; a running count over the buckets
    of a group and date finds the median's bucket, and one over the
    deltas of that bucket the median. Sums, extremes and counts come from
    the buckets.

    ``median="sketch"`` uses the original's quantile sketch instead
    (``percentile_approx`` with relative error 0.001): one aggregation whose
    buffer has a fixed size however many distinct deltas a group-date has.
    It equals the exact lower median whenever the sketch is exact (every
    group of up to several hundred places), and is within the sketch's rank
    error beyond that. ``median="none"`` leaves ``median_delta`` out: one
    plain aggregation, enough for extremes of other statistics.
    """
    group_cols = as_list(group_cols)
    keys = [*group_cols, date_col]
    delta = F.col(delta_col)
    if median == "sketch":
        return growth.groupBy(*keys).agg(
            F.percentile_approx(delta, 0.5, SKETCH_ACCURACY).cast("double").alias("median_delta"),
            F.avg(delta).cast("double").alias("avg_delta"),
            F.max(delta).cast("double").alias("max_delta"),
            F.min(delta).cast("double").alias("min_delta"),
            F.count(F.lit(1)).alias("n_entities"),
        )
    if median == "none":
        plain = growth.groupBy(*keys).agg(
            F.sum(delta).alias("_sum"),
            F.max(delta).cast("double").alias("max_delta"),
            F.min(delta).cast("double").alias("min_delta"),
            F.count(F.lit(1)).alias("n_entities"),
        )
        mean = (F.col("_sum") / F.col("n_entities")).cast("decimal(12,6)").cast("double")
        return plain.select(*keys, mean.alias("avg_delta"), "max_delta", "min_delta", "n_entities")
    if median != "exact":
        raise ValueError("median must be 'exact', 'sketch' or 'none'")
    hist = growth.groupBy(*keys, delta_col).agg(F.count(F.lit(1)).alias("_n"))
    return stats_from_histogram(hist, keys, delta_col)


def stats_from_histogram(hist: DataFrame, keys: Sequence[str], delta_col: str = "delta") -> DataFrame:
    """The statistics of :func:`growth_daily_stats` for every combination of
    ``keys``, from ``keys..., delta, _n`` (how many places have that delta)."""
    keys, delta = list(keys), F.col(delta_col)
    bucket = F.floor((delta * 100).cast("bigint") / MEDIAN_BUCKET)
    buckets = hist.groupBy(*keys, bucket.alias("_bucket")).agg(
        F.sum("_n").alias("_n"),
        F.sum(delta * F.col("_n")).alias("_sum"),
        F.max(delta).alias("_max"),
        F.min(delta).alias("_min"),
    )
    ordered = Window.partitionBy(*keys).orderBy("_bucket")
    running = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counted = buckets.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_bucket").alias("_mid_bucket"),
        F.sum("_n").over(running).alias("_cum"),
        F.col("_n"),
        F.sum("_n").over(whole).alias("n_entities"),
        F.sum("_sum").over(whole).alias("_sum"),
        F.max("_max").over(whole).cast("double").alias("max_delta"),
        F.min("_min").over(whole).cast("double").alias("min_delta"),
    )
    before = F.col("_cum") - F.col("_n")
    half_reached = (F.col("_cum") * 2 >= F.col("n_entities")) & (before * 2 < F.col("n_entities"))
    stats = counted.where(half_reached).select(
        "*",
        before.alias("_before"),
        (F.col("_sum") / F.col("n_entities")).cast("decimal(12,6)").cast("double").alias("avg_delta"),
    ).drop("_cum", "_n", "_sum")
    inside = hist.withColumn("_bucket", bucket).join(
        stats, _same(keys, [f"_k{i}" for i in range(len(keys))]) & (F.col("_bucket") == F.col("_mid_bucket"))
    )
    within = Window.partitionBy(*keys, "_bucket").orderBy(delta_col).rowsBetween(Window.unboundedPreceding, 0)
    located = inside.withColumn("_cum", F.col("_before") + F.sum("_n").over(within))
    one = lambda c: F.max(c).alias(c)  # noqa: E731  the same on all rows of a group and date
    return located.groupBy(*keys, "_bucket").agg(
        F.min(F.when(F.col("_cum") * 2 >= F.col("n_entities"), delta)).cast("double").alias("median_delta"),
        one("avg_delta"),
        one("max_delta"),
        one("min_delta"),
        one("n_entities"),
    ).drop("_bucket")


def _same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Column by column equal, nulls being equal; true for no columns."""
    return reduce(and_, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)], F.lit(True))


def growth_extremes(
    stats: DataFrame,
    group_cols: str | Sequence[str] = (),
    date_col: str = "date",
    which: Sequence[str] = EXTREMES,
) -> DataFrame:
    """The date of each extreme statistic, per group, in one aggregation.

    Output: ``group_cols..., stat, date, value``. ``greatest_*``/``max`` take
    the largest statistic, ``least_*``/``min`` the smallest; ties go to the
    earliest date.
    """
    group_cols = as_list(group_cols)
    unknown = set(which) - set(EXTREMES)
    if unknown:
        raise ValueError(f"unknown extremes: {sorted(unknown)}")
    day = F.unix_date(F.col(date_col))
    picks = []
    for name in which:
        stat_col, direction = _EXTREME_SPEC[name]
        if direction == "greatest":
            # largest value first, then the largest negated day = earliest date
            picks.append(F.max(F.struct(F.col(stat_col).alias("v"), (-day).alias("k"))).alias(name))
        else:
            picks.append(F.min(F.struct(F.col(stat_col).alias("v"), day.alias("k"))).alias(name))
    best = stats.groupBy(*group_cols).agg(*picks)
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("stat"),
                F.date_from_unix_date(
                    F.col(f"{name}.k") if _EXTREME_SPEC[name][1] == "least" else -F.col(f"{name}.k")
                ).alias("date"),
                F.col(f"{name}.v").alias("value"),
            )
            for name in which
        ]
    )
    return best.select(*group_cols, F.inline(rows))


def extreme_snapshots(
    growth: DataFrame,
    extremes: DataFrame,
    group_cols: str | Sequence[str] = (),
    date_col: str = "date",
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """The growth rows of every place on each extreme date.

    Output: ``group_cols..., stat, stat_value, <growth columns>``. The
    extremes side is written once to the shared checkpoint folder and
    counted. Within ``max_broadcast_rows`` it is broadcast and the large
    growth side is not shuffled for this join; beyond it Spark plans a
    shuffle join instead.
    """
    group_cols = as_list(group_cols)
    small, names = _extreme_dates(extremes, group_cols, date_col)
    small = checked_broadcast(small, max_broadcast_rows)
    joined = growth.join(small, _same([*group_cols, date_col], [*names, "_on"]), "inner")
    rest = [c for c in growth.columns if c not in group_cols]
    return joined.select(*group_cols, "stat", "stat_value", *rest)


def _extreme_dates(extremes: DataFrame, group_cols: list[str], date_col: str) -> tuple[DataFrame, list[str]]:
    """``stat, stat_value, _on`` and the group under names of its own."""
    names = [f"_g{i}" for i in range(len(group_cols))]
    cols = [F.col(c).alias(n) for c, n in zip(group_cols, names)]
    return extremes.select(*cols, "stat", F.col(date_col).alias("_on"), F.col("value").alias("stat_value")), names


def panel_snapshots(
    panel: DataFrame,
    extremes: DataFrame,
    group_cols: str | Sequence[str],
    entity_cols: str | Sequence[str],
    date_col: str = "date",
    value_col: str = "value",
    max_broadcast_rows: int = BROADCAST_MAX_ROWS,
) -> DataFrame:
    """:func:`extreme_snapshots` of a panel's growth, without computing the
    growth of any other date.

    Each entity is reduced to its first date and its values on the extreme
    dates and the days before (at most two per statistic) in one aggregation,
    combined map-side. A place has a growth row on a date when it is observed
    there and on any earlier date, as in :func:`growth_factor`.
    """
    group_cols = as_list(group_cols)
    keys = group_cols + [c for c in as_list(entity_cols) if c not in group_cols]
    small, names = _extreme_dates(extremes, group_cols, date_col)
    small = checked_broadcast(small, max_broadcast_rows)
    days = F.array(F.col("_on"), F.date_sub("_on", 1))
    near = small.select(*names, F.explode(days).alias("_day")).distinct().withColumn("_near", F.lit(True))
    near = checked_broadcast(near, 2 * max_broadcast_rows)
    rows = panel.select(*keys, F.col(date_col).alias("date"), F.col(value_col).alias("value"))
    flagged = rows.join(near, _same([*group_cols, "date"], [*names, "_day"]), "left")
    observed = F.collect_list(F.when(F.col("_near"), F.struct("date", "value")))
    series = flagged.groupBy(*keys).agg(F.min("date").alias("_first"), observed.alias("_observed"))
    series = series.where(F.size("_observed") > 0)
    dated = series.select(*keys, "_first", "_observed", F.explode("_observed").alias("_now")).where("_now.date > _first")
    before = F.filter("_observed", lambda x: x["date"] == F.date_sub(F.col("_now.date"), 1))
    with_prev = dated.select(*keys, "_now.date", "_now.value", F.get(before, F.lit(0))["value"].alias("_prev_value"))
    joined = with_prev.join(small, _same([*group_cols, "date"], [*names, "_on"]), "inner")
    zero = F.lit(0).cast(panel.schema[value_col].dataType)
    return joined.select(
        *group_cols,
        "stat",
        "stat_value",
        *[c for c in keys if c not in group_cols],
        F.date_sub("date", 1).alias("prev_date"),
        F.coalesce("_prev_value", zero).alias("prev_value"),
        "date",
        F.coalesce("value", zero).alias("value"),
        growth_percent(F.col("value"), F.col("_prev_value")).alias("delta"),
    )


def median_for(which: Sequence[str]) -> str:
    """Whether the statistics need a median to find these extremes."""
    return "exact" if any(_EXTREME_SPEC.get(name, ("median_delta",))[0] == "median_delta" for name in which) else "none"


def growth_extreme_report(
    panel: DataFrame,
    group_cols: str | Sequence[str],
    entity_cols: str | Sequence[str],
    date_col: str = "date",
    value_col: str = "value",
    which: Sequence[str] = EXTREMES,
) -> DataFrame:
    """Panel in, snapshots of the chosen extremes out (all six by default).

    ``which=("max",)`` etc. gives the single-statistic variants. Each group
    is an independent panel (e.g. the counties of one state).
    """
    group_cols = as_list(group_cols)
    keys = group_cols + [c for c in as_list(entity_cols) if c not in group_cols]
    growth = growth_factor(panel, keys, date_col, value_col)
    stats = growth_daily_stats(growth, group_cols, median=median_for(which))
    extremes = growth_extremes(stats, group_cols, which=which)
    return panel_snapshots(panel, extremes, group_cols, entity_cols, date_col, value_col)


__all__ = [
    "EXTREMES",
    "GROWTH_TYPE",
    "extreme_snapshots",
    "growth_daily_stats",
    "growth_extreme_report",
    "growth_extremes",
    "growth_factor",
    "panel_snapshots",
]
