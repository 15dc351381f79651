"""Spikes as residuals of a seasonal decomposition, not as raw maxima.

``value = trend + day of the week + season + residual``, per entity: the trend is
a centred moving mean, the weekday's part the mean of what is left on that weekday,
the season's part the mean of what is left in that season of the entity's
hemisphere. A day is a spike if its residual is ``z`` times the entity's usual
residual or more. All windows are an entity's days (bounded by the calendar),
after one shuffle by entity.

Everything but the last square root is whole-number arithmetic in millionths,
so results do not depend on the order in which rows are added up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.functions.columns import as_list

UNIT = 1_000_000
SEASONS = ("winter", "spring", "summer", "autumn")


def season_of(date: Column, lat: Column | None = None) -> Column:
    """The meteorological season (winter: December to February), half a year
    later south of the equator. A null latitude counts as northern."""
    quarter = F.floor(F.month(date) % 12 / 3)
    if lat is not None:
        quarter = F.pmod(quarter + F.when(lat < 0, 2).otherwise(0), F.lit(4))
    return F.element_at(F.array(*[F.lit(s) for s in SEASONS]), (quarter + 1).cast("int"))


def seasonal_residuals(
    panel: DataFrame, entity_cols: str | Sequence[str], date_col: str = "date", value_col: str = "value", lat_col: str | None = None,
    half_window: int = 45, z: float = 3.0,
) -> DataFrame:
    """``entity..., date, season, value, trend, weekday_part, season_part,
    residual, spread, spike`` of every row with a date and a value.

    ``value`` is a whole number; parts are exact to a millionth (rounded towards zero). ``spread`` is the root
    mean square of the entity's residuals; ``spike`` is true where the residual is positive and at least ``z``
    times that. The trend's window is ``half_window`` calendar days to either side, so gaps shorten it.
    Rows without a date or value are left out; of repeated entity and date each row counts; null entities are one.
    """
    keys = as_list(entity_cols)
    # numbered names: entity columns may have any name
    own = {n: F.col(n) for n in ("_d", "_x", "_s")}
    lat = None if lat_col is None else F.col(lat_col)
    rows = panel.where(F.col(date_col).isNotNull() & F.col(value_col).isNotNull()).select(
        *keys, F.col(date_col).alias("_d"), F.col(value_col).cast("bigint").alias("_x"), season_of(F.col(date_col), lat).alias("_s")
    )
    near = Window.partitionBy(*keys).orderBy(F.unix_date("_d")).rangeBetween(-half_window, half_window)
    rows = rows.withColumn("_t", _mean(own["_x"] * UNIT, near)).withColumn("_w", F.dayofweek("_d"))
    rows = rows.withColumn("_wp", _mean(own["_x"] * UNIT - F.col("_t"), Window.partitionBy(*keys, "_w")))
    rows = rows.withColumn("_sp", _mean(own["_x"] * UNIT - F.col("_t") - F.col("_wp"), Window.partitionBy(*keys, "_s")))
    rows = rows.withColumn("_r", own["_x"] * UNIT - F.col("_t") - F.col("_wp") - F.col("_sp"))
    whole = Window.partitionBy(*keys)
    square = F.col("_r").cast("decimal(19,0)") * F.col("_r").cast("decimal(19,0)")
    mean_square = F.sum(square).over(whole).cast("double") / F.count(F.lit(1)).over(whole)
    rows = rows.withColumn("_sd", F.sqrt(mean_square) / F.lit(float(UNIT)))
    part = lambda c: F.col(c).cast("double") / F.lit(float(UNIT))
    spike = (F.col("_r") > 0) & (part("_r") >= F.lit(float(z)) * F.col("_sd"))
    return rows.select(
        *keys, F.col("_d").alias("date"), F.col("_s").alias("season"), F.col("_x").alias("value"), part("_t").alias("trend"), part("_wp").alias("weekday_part"),
        part("_sp").alias("season_part"), part("_r").alias("residual"), F.round("_sd", 6).alias("spread"), spike.alias("spike"),
    )


def _mean(units: Column, window) -> Column:
    """The mean, in whole units towards zero."""
    total, n = F.sum(units.cast("decimal(38,0)")).over(window), F.count(F.lit(1)).over(window)
    return F.call_function("div", total, n.cast("decimal(38,0)")).cast("bigint")


def season_spike_rates(residuals: DataFrame, group_cols: str | Sequence[str] = ()) -> DataFrame:
    """``group..., season, n_days, n_spikes, rate`` of :func:`seasonal_residuals`' rows."""
    keys = as_list(group_cols)
    out = residuals.groupBy(*keys, "season").agg(F.count(F.lit(1)).alias("n_days"), F.count_if("spike").alias("n_spikes"))
    return out.withColumn("rate", F.round(F.col("n_spikes") / F.col("n_days"), 6))
