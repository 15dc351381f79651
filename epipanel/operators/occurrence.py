"""First occurrences, accumulated totals and the ratios relating them.

Every aggregation combines partially on the map side, so an entity holding
a third of all rows is reduced inside every map task before anything is
shuffled. Totals are hash aggregates. The original's "first row per
entity" window, which sorts all of an entity's rows inside one task, is
replaced by ``min(struct(date, tie-break..., value))``. That is a
sort-based aggregate (struct buffers), but each map task reduces its own
rows to one per entity before the shuffle, so no task ever sorts a whole
entity.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epipanel.functions.allow_lists import US_STATES
from epipanel.functions.columns import as_list
from epipanel.functions.numeric import positive, ratio, to_count
from epipanel.operators.entities import keep_entities, like_entity

MEASURES = ("confirmed", "deaths", "recovered")


def first_occurrence(
    df: DataFrame,
    measure: str,
    entity: str,
    date_col: str = "obs_date",
    tie_break: Sequence[str] = (),
    target: str | None = None,
) -> DataFrame:
    """The earliest row with ``measure > 0`` of each entity.

    Output: ``entity, first_<measure>_date, <measure>``. Rows of one entity
    on the same first date are ordered by ``tie_break`` columns (nulls
    first), then by the smaller measure, so the result is deterministic.
    ``target`` keeps entities whose name contains it (``LIKE '%t%'``); the
    filter is on the grouping key, so Catalyst applies it before the
    aggregation.
    """
    tie_break = [c for c in as_list(tie_break) if c not in (entity, date_col, measure)]
    # a plain comparison on a numeric measure reaches the Parquet scan;
    # text measures (as read from CSV) go through a tolerant cast
    numeric = isinstance(df.schema[measure].dataType, T.NumericType)
    has_cases = (F.col(measure) > 0) if numeric else positive(F.col(measure))
    first = (
        df.where(has_cases & F.col(date_col).isNotNull())
        .groupBy(entity)
        .agg(
            F.min(
                F.struct(
                    F.col(date_col).alias("d"),
                    *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie_break)],
                    F.col(measure).alias("m"),
                )
            ).alias("first")
        )
        .select(
            entity,
            F.col("first.d").alias(f"first_{measure}_date"),
            F.col("first.m").alias(measure),
        )
    )
    if target:
        first = like_entity(first, entity, target, "contains")
    return first


def accumulate(
    df: DataFrame,
    entity: str,
    allowed: Iterable[str] | DataFrame | None = None,
    target: str | None = None,
    measures: Sequence[str] = MEASURES,
    mode: str = "sum",
    date_col: str = "obs_date",
    within: Sequence[str] = (),
) -> DataFrame:
    """Per-entity totals ``total_<measure>`` over recognised entities.

    * ``mode="sum"`` (default, the original's behaviour) sums every row; for
      running counts that is a sum of cumulative values.
    * ``mode="latest"`` treats each series (the entity, or the entity split
      by ``within`` columns such as the states of a country) as cumulative
      and sums the values of each series' latest date. Both steps are
      aggregations (latest row via ``max(struct(date, ...))``), so a hot
      entity is reduced map-side and never sorted in one task.

    ``target`` keeps entities whose name ends with it (``LIKE '%t'``).
    """
    within = [c for c in as_list(within) if c != entity]
    cols = [entity, *within, *measures] + ([date_col] if mode == "latest" else [])
    source = df.select(*cols)
    if allowed is not None:
        source = keep_entities(source, entity, allowed)
    if mode == "latest":
        latest = (
            source.where(F.col(date_col).isNotNull())
            .groupBy(entity, *within)
            .agg(F.max(F.struct(F.col(date_col).alias("d"), *[F.col(m) for m in measures])).alias("_last"))
        )
        source = latest.select(entity, *[F.col(f"_last.{m}").alias(m) for m in measures])
    elif mode != "sum":
        raise ValueError("mode must be 'sum' or 'latest'")
    totals = source.groupBy(entity).agg(*[F.sum(m).alias(f"total_{m}") for m in measures])
    if target:
        totals = like_entity(totals, entity, target, "suffix")
    return totals


def population_rollup(
    population: DataFrame,
    state_col: str = "state",
    population_col: str = "population",
    allowed: Iterable[str] | DataFrame = US_STATES,
) -> DataFrame:
    """County rows summed to ``state, population`` for recognised states.
    Text counts like ``12.0`` are accepted; text that is no number is left out."""
    kept = keep_entities(population.select(state_col, population_col), state_col, allowed)
    return kept.groupBy(state_col).agg(
        F.sum(to_count(population_col)).alias("population")
    )


def relationship(
    first_confirmed: DataFrame,
    first_deaths: DataFrame,
    totals: DataFrame,
    entity: str,
    population: DataFrame | None = None,
) -> DataFrame:
    """First dates next to the outcome ratios of each entity.

    Output: ``first_confirmed_date, confirmed, first_deaths_date, deaths,
    <entity>, case_fatality_ratio, [mortality_ratio,] case_recovery_ratio``

    * case fatality = total deaths / total confirmed
    * case recovery = total recovered / total confirmed
    * mortality = total deaths / population (when ``population`` is given)

    Ratios are rounded to 2 places; a zero denominator gives null. Inner
    joins: an entity missing from any input is left out. All inputs are one
    row per entity, so the joins are key-unique (no fan-out); AQE broadcasts
    whichever side turns out small at runtime.
    """
    firsts = first_confirmed.join(first_deaths, entity, "inner")
    joined = totals.join(firsts, entity, "inner")
    ratios = [
        F.col("first_confirmed_date"),
        F.col("confirmed"),
        F.col("first_deaths_date"),
        F.col("deaths"),
        F.col(entity),
        ratio("total_deaths", "total_confirmed").alias("case_fatality_ratio"),
    ]
    if population is not None:
        pop = population.select(F.col(entity), F.col("population").alias("_population"))
        joined = joined.join(pop, entity, "inner")
        ratios.append(ratio("total_deaths", "_population").alias("mortality_ratio"))
    ratios.append(ratio("total_recovered", "total_confirmed").alias("case_recovery_ratio"))
    return joined.select(*ratios)


def outcome_ratios(
    obs: DataFrame,
    entity: str,
    allowed: Iterable[str] | DataFrame,
    date_col: str = "obs_date",
    tie_break: Sequence[str] = (),
    first_where=None,
    population: DataFrame | None = None,
) -> DataFrame:
    """:func:`relationship` of first occurrences and totals, in one pass.

    Same output as ``relationship(first_occurrence(confirmed),
    first_occurrence(deaths), accumulate(...))`` but the two first dates and
    the three totals of an entity come out of a single aggregation over the
    recognised rows, so a large observation table is read once and nothing
    is joined except ``population``. ``first_where`` restricts only the rows
    that may be first occurrences (e.g. states of one country), while the
    totals count every recognised row, as in the original.
    """
    tie_break = [c for c in as_list(tie_break) if c not in (entity, date_col)]
    rows = keep_entities(obs, entity, allowed)
    eligible = F.col(date_col).isNotNull()
    if first_where is not None:
        eligible = eligible & first_where

    def first(measure: str):
        numeric = isinstance(obs.schema[measure].dataType, T.NumericType)
        has_cases = (F.col(measure) > 0) if numeric else positive(F.col(measure))
        key = F.struct(
            F.col(date_col).alias("d"),
            *[F.col(c).alias(f"t{i}") for i, c in enumerate(tie_break)],
            F.col(measure).alias("m"),
        )
        return F.min(F.when(has_cases & eligible, key)).alias(f"_first_{measure}")

    per_entity = rows.groupBy(entity).agg(
        first("confirmed"),
        first("deaths"),
        *[F.sum(m).alias(f"total_{m}") for m in MEASURES],
    )
    return _with_ratios(per_entity, entity, population)


def _with_ratios(per_entity: DataFrame, entity: str, population: DataFrame | None) -> DataFrame:
    """The output of :func:`relationship` from ``entity, _first_confirmed,
    _first_deaths`` (structs with ``d`` and ``m``) and the totals."""
    per_entity = per_entity.where(F.col("_first_confirmed").isNotNull() & F.col("_first_deaths").isNotNull())
    cols = [
        F.col("_first_confirmed.d").alias("first_confirmed_date"),
        F.col("_first_confirmed.m").alias("confirmed"),
        F.col("_first_deaths.d").alias("first_deaths_date"),
        F.col("_first_deaths.m").alias("deaths"),
        F.col(entity),
        ratio("total_deaths", "total_confirmed").alias("case_fatality_ratio"),
    ]
    if population is not None:
        pop = population.select(F.col(entity), F.col("population").alias("_population"))
        per_entity = per_entity.join(pop, entity, "inner")
        cols.append(ratio("total_deaths", "_population").alias("mortality_ratio"))
    cols.append(ratio("total_recovered", "total_confirmed").alias("case_recovery_ratio"))
    return per_entity.select(*cols)


def place_summary(obs: DataFrame, keys: Sequence[str] = ("country", "state"), date_col: str = "obs_date") -> DataFrame:
    """One row per place: its totals, and its first dates with a count, from one
    reading of the observations: ``keys..., total_<measure>...,
    _first_confirmed, _first_deaths`` (structs ``d, m``; null where there is none).

    Totals and ratios of states, countries or other parts of ``keys`` follow from it
    (:func:`totals_of_summary`, :func:`ratios_of_summary`), with the very results of
    :func:`accumulate` and :func:`outcome_ratios` on the observations.
    """

    def first(measure: str):
        key = F.struct(F.col(date_col).alias("d"), F.col(measure).alias("m"))
        return F.min(F.when(positive(F.col(measure)) & F.col(date_col).isNotNull(), key)).alias(f"_first_{measure}")

    return obs.groupBy(*as_list(keys)).agg(
        first("confirmed"), first("deaths"), *[F.sum(m).alias(f"total_{m}") for m in MEASURES]
    )


def totals_of_summary(summary: DataFrame, entity: str, allowed: Iterable[str] | DataFrame | None = None) -> DataFrame:
    """:func:`accumulate` from a :func:`place_summary`."""
    rows = summary if allowed is None else keep_entities(summary, entity, allowed)
    return rows.groupBy(entity).agg(*[F.sum(f"total_{m}").alias(f"total_{m}") for m in MEASURES])


def ratios_of_summary(
    summary: DataFrame, entity: str, allowed: Iterable[str] | DataFrame, tie_break: Sequence[str] = (), first_where=None,
    population: DataFrame | None = None,
) -> DataFrame:
    """:func:`outcome_ratios` from a :func:`place_summary`; ``tie_break`` and
    ``first_where`` refer to its keys."""
    rows = keep_entities(summary, entity, allowed)
    ties = [c for c in as_list(tie_break) if c != entity]

    def first(measure: str):
        of = f"_first_{measure}"
        key = F.struct(F.col(f"{of}.d").alias("d"), *[F.col(c).alias(f"t{i}") for i, c in enumerate(ties)], F.col(f"{of}.m").alias("m"))
        counts = F.col(of).isNotNull()
        return F.min(F.when(counts if first_where is None else counts & first_where, key)).alias(of)

    per_entity = rows.groupBy(entity).agg(
        first("confirmed"), first("deaths"), *[F.sum(f"total_{m}").alias(f"total_{m}") for m in MEASURES]
    )
    return _with_ratios(per_entity, entity, population)
