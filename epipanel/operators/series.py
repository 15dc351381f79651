"""Per-entity daily series: increments, percent change, spikes, changes.

Inputs are long panels ``(entity cols..., date, value)`` with one row per
entity and date (what :func:`epipanel.operators.reshape.wide_to_long`
produces from a wide file). Windows are partitioned by the entity, so a
window partition holds one entity's days — bounded by the calendar, not by
the data volume — and a panel already partitioned by entity is not
shuffled again.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epipanel.functions.columns import as_list
from epipanel.functions.dates import format_mdy, parse_mdy_name
from epipanel.functions.numeric import fractional_change


def _previous(value_col: str, entity_cols: list[str], date_col: str):
    w = Window.partitionBy(*entity_cols).orderBy(date_col)
    return F.lag(value_col).over(w)


def increments(
    panel: DataFrame,
    entity_cols: str | Sequence[str],
    date_col: str = "date",
    value_col: str = "value",
) -> DataFrame:
    """Day-over-day difference of a cumulative series.

    Output: ``entity_cols..., date, increment``; the first value's increment
    is the value itself (the series is taken to start from 0). A missing
    value has no increment, and the next one counts from the last value
    before the gap.
    """
    entity_cols = as_list(entity_cols)
    before = Window.partitionBy(*entity_cols).orderBy(date_col).rowsBetween(Window.unboundedPreceding, -1)
    prev = F.coalesce(F.last(value_col, ignorenulls=True).over(before), F.lit(0))
    return panel.select(
        *entity_cols, F.col(date_col), (F.col(value_col) - prev).alias("increment")
    )


def percent_change(
    panel: DataFrame,
    entity_cols: str | Sequence[str],
    date_col: str = "date",
    value_col: str = "value",
) -> DataFrame:
    """Fractional day-over-day change ``today / yesterday - 1``.

    Output: ``entity_cols..., date, pct_change`` (decimal, 3 places, HALF_UP).
    It is 0.000 on the first day and whenever yesterday is 0. Despite the
    name it is a fraction (0.5 = +50 %), as in the original.
    """
    entity_cols = as_list(entity_cols)
    prev = _previous(value_col, entity_cols, date_col)
    return panel.select(
        *entity_cols,
        F.col(date_col),
        fractional_change(F.col(value_col), prev).alias("pct_change"),
    )


def local_spikes(
    series: DataFrame,
    entity_cols: str | Sequence[str],
    value_col: str = "increment",
    threshold: float = 1.0,
) -> DataFrame:
    """Count each entity's "high days" and its highest daily value.

    A high day has ``value >= threshold * max`` where ``max`` is the
    entity's largest value; an entity whose max is <= 0 has no high days.
    ``threshold=1.0`` counts the days equal to the max, which is what the
    original's integer ratio computes; ``0.95`` is its stated intent.

    Output: ``entity_cols..., count_high_days, highest_daily_value`` ordered
    by both descending, then by the entity.
    """
    entity_cols = as_list(entity_cols)
    peak = F.max(value_col).over(Window.partitionBy(*entity_cols))
    flagged = series.select(
        *entity_cols,
        F.col(value_col),
        ((peak > 0) & (F.col(value_col).cast("double") >= F.lit(float(threshold)) * peak.cast("double"))).alias("_high"),
    )
    # grouped on the window's partitioning keys: no second shuffle
    return (
        flagged.groupBy(*entity_cols)
        .agg(
            F.count_if(F.col("_high")).alias("count_high_days"),
            F.max(value_col).alias("highest_daily_value"),
        )
        .orderBy(
            F.col("count_high_days").desc(),
            F.col("highest_daily_value").desc(),
            *[F.col(c).asc_nulls_first() for c in entity_cols],
        )
    )


def spike_days(
    series: DataFrame,
    entity_cols: str | Sequence[str],
    value_col: str = "increment",
    threshold: float = 1.0,
    date_col: str = "date",
) -> DataFrame:
    """The high days that :func:`local_spikes` counts, one row each:
    ``entity_cols..., date, value, share`` with ``share`` the value's part
    of the entity's highest value (1.0 on the highest days)."""
    entity_cols = as_list(entity_cols)
    value = F.col(value_col)
    peak = F.max(value_col).over(Window.partitionBy(*entity_cols))
    with_peak = series.select(*entity_cols, F.col(date_col).alias("date"), value.alias("value"), peak.alias("_peak"))
    peak, value = F.col("_peak").cast("double"), F.col("value").cast("double")
    return with_peak.where((peak > 0) & (value >= F.lit(float(threshold)) * peak)).select(
        *entity_cols, "date", "value", F.try_divide(value, peak).alias("share")
    )


def spike_lengths(
    series: DataFrame,
    entity_cols: str | Sequence[str],
    value_col: str = "increment",
    threshold: float = 0.5,
    date_col: str = "date",
) -> DataFrame:
    """Runs of consecutive high days: ``entity_cols..., first_day, last_day,
    days, total`` (the sum of the run's values). A day without a row, an
    empty cell and a day below the threshold all end a run."""
    entity_cols = as_list(entity_cols)
    high = spike_days(series, entity_cols, value_col, threshold, date_col)
    place = F.row_number().over(Window.partitionBy(*entity_cols).orderBy("date"))
    # consecutive days minus their place among the high days are one date
    run = high.select(*entity_cols, "date", "value", F.date_sub("date", place).alias("_run"))
    return run.groupBy(*entity_cols, "_run").agg(
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.count("*").alias("days"),
        F.sum("value").alias("total"),
    ).drop("_run")


def as_date(d) -> _dt.date:
    """A date parameter given as ``date``, ISO text or ``M/d/yy`` text."""
    if isinstance(d, _dt.datetime):
        return d.date()
    if isinstance(d, _dt.date):
        return d
    text = str(d)
    parsed = parse_mdy_name(text)
    return parsed if parsed is not None else _dt.date.fromisoformat(text)


def change_over_time(
    panel: DataFrame,
    entity_cols: str | Sequence[str],
    start,
    days: int,
    date_col: str = "date",
    value_col: str = "value",
) -> DataFrame:
    """Value on ``start`` and ``days`` later, and their difference.

    Output: ``entity_cols..., start_date, start_value, end_date, end_value,
    delta``. Only entities observed on both dates appear. The date filter
    reaches the scan; the two dates are then folded per entity by one
    conditional aggregation (no self-join).
    """
    entity_cols = as_list(entity_cols)
    first = as_date(start)
    last = first + _dt.timedelta(days=days)
    d = F.col(date_col)
    v = F.col(value_col)
    per_entity = (
        panel.where(d.isin(first, last))
        .groupBy(*entity_cols)
        .agg(
            F.count_if(d == F.lit(first)).alias("_n_start"),
            F.max(F.when(d == F.lit(first), v)).alias("start_value"),
            F.count_if(d == F.lit(last)).alias("_n_end"),
            F.max(F.when(d == F.lit(last), v)).alias("end_value"),
        )
    )
    return per_entity.where((F.col("_n_start") > 0) & (F.col("_n_end") > 0)).select(
        *entity_cols,
        F.lit(first).alias("start_date"),
        F.col("start_value"),
        F.lit(last).alias("end_date"),
        F.col("end_value"),
        (F.col("end_value") - F.col("start_value")).alias("delta"),
    )


def shift_observed_date(df: DataFrame, date_col: str, start, days: int) -> DataFrame:
    """``start`` moved by ``days`` calendar days, if ``start`` is observed.

    Output: one row ``start_date, shifted_date, shifted_text`` (``M/d/yy``),
    or no row when no record has that date. Real calendar arithmetic: months
    and leap days roll over correctly.
    """
    first = as_date(start)
    observed = df.where(F.col(date_col) == F.lit(first)).select(F.col(date_col).alias("start_date")).distinct()
    shifted = F.date_add(F.col("start_date"), days)
    return observed.select(
        "start_date",
        shifted.alias("shifted_date"),
        format_mdy(shifted).alias("shifted_text"),
    )
