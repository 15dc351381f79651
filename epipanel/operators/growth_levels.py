"""Growth statistics that can be merged, and those of several levels at once.

* :func:`growth_moments` stores, per group and date, sums of powers and a quantile
  sketch of the deltas; both merge, so weeks, countries or later files are
  put together without reading the growth rows again.
* :func:`growth_level_stats` gives exact medians of county, state, country and
  continent from one histogram, by grouping sets.
* :func:`population_classes` cuts places into classes of equal population.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.functions.columns import as_list
from epipanel.operators.growth import stats_from_histogram
from epipanel.operators.ranges import running_total
from epipanel.plans.joins import checked_broadcast, null_safe
from epipanel.session import write_scratch

# Size parameter of the quantile sketch: its rank error is about 1.33 % at 200, 0.35 % at 800.
SKETCH_K = 800
HUNDREDTHS = 100

_EXACT = "decimal(38,0)"


def growth_moments(
    growth: DataFrame, group_cols: str | Sequence[str] = (), date_col: str = "date", delta_col: str = "delta", k: int = SKETCH_K
) -> DataFrame:
    """``group..., date, n, s1, s2, s3, least, most, sketch``: what can be added up.

    ``s1`` to ``s3`` are exact sums of the powers of the deltas in hundredths (whole numbers: a
    decimal(8,2) has at most eight digits, so 10^14 cubes fit), ``sketch`` a quantile sketch of fixed
    size. Null deltas are left out; a group and date with none has no row.
    """
    keys = [*as_list(group_cols), date_col]
    d = (F.col(delta_col) * HUNDREDTHS).cast("bigint")
    rows = growth.where(F.col(delta_col).isNotNull()).select(*keys, d.alias("_d"))
    e = F.col("_d").cast("decimal(12,0)")
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(e).cast(_EXACT).alias("s1"),
        F.sum((e * e).cast("decimal(25,0)")).cast(_EXACT).alias("s2"),
        F.sum((e * e * e).cast("decimal(28,0)")).cast(_EXACT).alias("s3"),
        F.min("_d").alias("least"),
        F.max("_d").alias("most"),
        F.kll_sketch_agg_bigint("_d", k).alias("sketch"),
    )


def merge_moments(moments: DataFrame, keys: str | Sequence[str] = (), k: int = SKETCH_K) -> DataFrame:
    """Stored moments put together by ``keys`` (columns of ``moments``; none: all of them)."""
    return moments.groupBy(*as_list(keys)).agg(
        F.sum("n").alias("n"), *[F.sum(c).cast(_EXACT).alias(c) for c in ("s1", "s2", "s3")], F.min("least").alias("least"), F.max("most").alias("most"),
        F.kll_merge_agg_bigint("sketch", k).alias("sketch"),
    )


def growth_statistics(moments: DataFrame, quantiles: Sequence[float] = (0.1, 0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """The statistics of stored moments: the other columns of ``moments``, ``n, mean,
    deviation, skewness, least, most`` and ``q10``, ``q25``... (per cent of growth).

    ``deviation`` is that of the whole population. ``skewness`` is null where the deviation is 0. The
    central sums are exact; only the last divisions and roots are floating point, rounded to six places.
    """
    n = F.col("n").cast(_EXACT)
    dbl = lambda c: c.cast("double")
    # n^2 times the variance, in exact whole numbers as far as 38 digits hold, else in doubles
    nd, s1, s2, s3 = dbl(n), dbl(F.col("s1")), dbl(F.col("s2")), dbl(F.col("s3"))
    exact = F.try_subtract(F.try_multiply(n, F.col("s2")), F.try_multiply(F.col("s1"), F.col("s1")))
    spread = F.greatest(F.coalesce(dbl(exact), nd * s2 - s1 * s1), F.lit(0.0))
    variance = spread / (nd * nd)
    third = s3 / nd - 3.0 * (s1 / nd) * (s2 / nd) + 2.0 * F.pow(s1 / nd, 3)
    unit = float(HUNDREDTHS)
    rest = [c for c in moments.columns if c not in ("n", "s1", "s2", "s3", "least", "most", "sketch")]
    asked = F.kll_sketch_get_quantile_bigint("sketch", F.array(*[F.lit(float(q)) for q in quantiles]))
    out = moments.select(
        *rest, "n", F.round(s1 / nd / unit, 6).alias("mean"), F.round(F.sqrt(variance) / unit, 6).alias("deviation"),
        F.when(variance > 0, F.round(third / (variance * F.sqrt(variance)), 4)).alias("skewness"),
        (dbl(F.col("least")) / unit).alias("least"), (dbl(F.col("most")) / unit).alias("most"), asked.alias("_q"),
    )
    return out.select(*[c for c in out.columns if c != "_q"], *[(dbl(F.get("_q", F.lit(i))) / unit).alias(f"q{round(q * 100)}") for i, q in enumerate(quantiles)])


def growth_level_stats(
    growth: DataFrame, level_cols: Sequence[str], date_col: str = "date", delta_col: str = "delta"
) -> DataFrame:
    """:func:`epipanel.operators.growth.growth_daily_stats` of every level at once:
    ``level, <level columns>, date, median_delta, avg_delta, max_delta, min_delta, n_entities``.

    ``level_cols`` go from the widest to the narrowest (continent, country, state). ``level`` names the narrowest
    column that the row is of, ``all`` for the whole; narrower columns are null. Medians are exact
    and count places, not the medians of lower levels. The growth rows are read once: their
    histogram is spread over the levels by grouping sets. A null in a level column is a group of its own.
    """
    levels = as_list(level_cols)
    hist = growth.groupBy(*levels, date_col, delta_col).agg(F.count(F.lit(1)).alias("_n"))
    sets = [[*levels[:i], date_col, delta_col] for i in range(len(levels) + 1)]
    names = F.array(F.lit("all"), *[F.lit(c) for c in levels])
    depth = F.lit(len(levels))
    for c in levels:
        depth = depth - F.grouping(c).cast("int")
    spread = hist.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in [*levels, date_col, delta_col]]).agg(
        F.sum("_n").alias("_n"), F.element_at(names, depth + 1).alias("level")
    )
    return stats_from_histogram(spread, ["level", *levels, date_col], delta_col)


def population_classes(
    places: DataFrame, order_col: str, population_col: str, cuts: Sequence[float] = (1 / 3, 2 / 3), names: Sequence[str] = ("rural", "mixed", "urban")
) -> DataFrame:
    """``places`` with ``class``: the places in order of ``order_col`` (density, or the population itself)
    cut where ``cuts`` of all people live below.

    A place's class is the number of cuts that the people of all places with a smaller value reach, so equal values
    share a class. Null or negative populations count as 0; a null order has no class. The cut points come
    from the values' histogram and running totals over its ranges; no window over the table, and the
    values meet their class by a join in which one value of very many places may be split.
    """
    if len(names) != len(cuts) + 1:
        raise ValueError("one name more than cuts")
    if "class" in places.columns:
        raise ValueError("'class' is a column already")
    order, people = F.col(order_col), F.greatest(F.coalesce(F.col(population_col).cast("bigint"), F.lit(0)), F.lit(0))
    hist = places.where(order.isNotNull()).groupBy(order.alias("_at")).agg(F.sum(people).alias("_people"))
    placed = write_scratch(running_total(hist, [F.col("_at")], F.col("_people"), "_below"), "cuts")
    total = int(placed.agg(F.coalesce(F.sum("_people"), F.lit(0))).first()[0])
    passed = F.lit(0)
    for cut in cuts:
        passed = passed + F.when(F.col("_below").cast("double") >= float(cut) * total, 1).otherwise(0)
    by_value = placed.select("_at", F.element_at(F.array(*[F.lit(x) for x in names]), passed + 1).alias("class"))
    return places.join(write_scratch(by_value, "classes"), order == F.col("_at"), "left").drop("_at")


def growth_by_class(
    growth: DataFrame, classes: DataFrame, place_cols: str | Sequence[str], group_cols: str | Sequence[str] = (), date_col: str = "date"
) -> DataFrame:
    """Daily growth statistics of each class of places (``classes``: ``place..., class``, one row a place).
    Places without a class are the null class; none is dropped."""
    from epipanel.operators.growth import growth_daily_stats

    keys = as_list(place_cols)
    own = [f"_p{i}" for i in range(len(keys))]
    table = checked_broadcast(classes.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], "class").dropDuplicates(own))
    return growth_daily_stats(growth.join(table, null_safe(keys, own), "left"), [*as_list(group_cols), "class"], date_col)


def compare_spike_lengths(lengths: DataFrame, entity_cols: str | Sequence[str], group_cols: str | Sequence[str] = ()) -> DataFrame:
    """Each run of :func:`epipanel.operators.series.spike_lengths` against all others of its group:
    the rows with ``pct_rank`` (the share of shorter ones among the others) and ``n_ranked``, and
    ``entity_longest``, the entity's longest run."""
    from epipanel.operators.ranges import percent_rank

    keys, groups = as_list(entity_cols), as_list(group_cols)
    stored = write_scratch(lengths, "spike-lengths")
    ranked = percent_rank(stored, "days", groups)
    own = [f"_e{i}" for i in range(len(keys))]
    longest = write_scratch(stored.groupBy(*[F.col(k).alias(o) for k, o in zip(keys, own)]).agg(F.max("days").alias("entity_longest")), "longest")
    return ranked.join(longest, null_safe(keys, own)).drop(*own)

