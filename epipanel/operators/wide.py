"""Series analyses straight on wide files (one row per place, one column per
date), without a shuffle.

A wide row already holds an entity's whole series, so day-over-day work
never needs rows from other tasks. The date of every column is known from
its name at plan time, so "the previous day" is resolved while the plan is
built; each analysis is one projection of built-in expressions (the
per-date logic written once inside ``transform``, no UDF), followed by a
``Generate`` that emits long rows. On a wide input of any size this reads every row once
and shuffles nothing; the long-panel versions in ``series``/``growth``
would first have to shuffle the unpivoted panel by entity.

Results are identical to running the long-panel operator on
:func:`epipanel.operators.reshape.wide_to_long` of the same table.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.functions.columns import as_list
from epipanel.functions.numeric import fractional_change, growth_percent
from epipanel.operators.reshape import literal_array, quote, stage_cells

_ONE_DAY = _dt.timedelta(days=1)


class _Frame:
    """Plan-time view of a wide table's date columns.

    ``staged`` holds the identity columns and ``_v``, one array of the
    typed cells per row (0-based position = column order by date); ``days``
    and ``follows`` are literal arrays: the date of each column and whether
    the previous column is exactly the day before. Per-date logic is then
    written once, inside ``transform`` over the positions, and reads ``_v``:
    the plan stays small and the work per row linear however many date
    columns a file has.
    """

    def __init__(self, wide: DataFrame, id_cols: list[str], value_type: str):
        self.staged, dates = stage_cells(wide, id_cols, value_type)
        self.value_type = value_type
        self.names = [name for name, _ in dates]
        self.n = len(dates)
        self.values = F.col("_v")
        self.days = literal_array([d for _, d in dates])
        self.follows = literal_array(
            [False, *[cur - prev == _ONE_DAY for (_, prev), (_, cur) in zip(dates, dates[1:])]]
        )

    def filled(self) -> Column:
        """The cells with each empty one replaced by the last value before it
        (null before the first): every value repeated up to the next one's
        place. Linear in the number of columns, and only ever read as a whole
        array, never from inside a lambda."""
        at = F.transform(self.values, lambda x, i: F.when(x.isNotNull(), F.struct(i.alias("i"), x.alias("x"))))
        held = F.array_compact(at)
        places = F.transform(held, lambda h: h["i"])
        nexts = F.slice(F.concat(F.slice(places, 2, self.n), F.array(F.lit(self.n))), 1, F.size(held))
        runs = F.zip_with(held, nexts, lambda h, until: F.array_repeat(h["x"], until - h["i"]))
        empty = F.array_repeat(F.lit(None).cast(self.value_type), F.coalesce(F.get(places, F.lit(0)), F.lit(self.n)))
        return F.concat(empty, F.flatten(runs))

    def shifted(self, source: Column) -> Column:
        """``source`` moved one column on: null first, the last cell left out."""
        return F.slice(F.concat(F.array(F.lit(None).cast(self.value_type)), source), 1, self.n)

    def exploded(self, id_cols: list[str], previous: Column | None = None) -> DataFrame:
        """One row per date column: ``_pos``, ``_val`` (the cell) and
        ``_prev`` (the previous column's cell, null for the first; taken
        from the array ``previous`` instead of the cells if given).

        Built from codegen'd expressions only: the previous cells are the
        array shifted by one (``slice(concat(...))``) and both are exploded
        together with ``posexplode(arrays_zip(...))``.
        """
        ids = _ids(id_cols)
        source = F.col("_v") if previous is None else previous
        paired = self.staged.select(*ids, F.col("_v"), self.shifted(source).alias("_p"))
        return paired.select(*ids, F.posexplode(F.arrays_zip("_v", "_p")).alias("_pos", "_z")).select(
            *ids, F.col("_pos"), F.col("_z._v").alias("_val"), F.col("_z._p").alias("_prev")
        )


def _ids(id_cols: list[str]) -> list[Column]:
    return [F.col(quote(c)) for c in id_cols]


def _spread(staged: DataFrame, id_cols: list[str], array_col: str, names: list[str]) -> DataFrame:
    """Array elements back out as one column per date, named like the input
    (one ``selectExpr`` call however many columns)."""
    return staged.selectExpr(
        *[quote(c) for c in id_cols], *[f"{array_col}[{k}] AS {quote(name)}" for k, name in enumerate(names)]
    )


def typed_wide(wide: DataFrame, id_cols: str | Sequence[str], value_type: str = "bigint") -> DataFrame:
    """The wide table with its date columns typed and in date order; what is no
    number is null. Stored once, several analyses can then read columns
    instead of parsing text again."""
    id_cols = as_list(id_cols)
    fr = _Frame(wide, id_cols, value_type)
    return _spread(fr.staged, id_cols, "_v", fr.names)


def wide_growth_factor(wide: DataFrame, id_cols: str | Sequence[str], value_type: str = "bigint") -> DataFrame:
    """:func:`epipanel.operators.growth.growth_factor` of a wide table.

    Output: ``id_cols..., prev_date, prev_value, date, value, delta``.
    The previous value is the column of the previous calendar day; when the
    file has no such column it reads as an empty cell (0). The first date
    column has no growth row.
    """
    id_cols = as_list(id_cols)
    fr = _Frame(wide, id_cols, value_type)
    if fr.n < 2:
        raise ValueError("a growth factor needs at least two date columns")
    zero = F.lit(0).cast(value_type)
    pos = F.col("_pos")
    day = F.get(fr.days, pos)
    prev = F.when(F.get(fr.follows, pos), F.col("_prev"))
    return fr.exploded(id_cols).where(pos >= 1).select(
        *_ids(id_cols),
        F.date_sub(day, 1).alias("prev_date"),
        F.coalesce(prev, zero).alias("prev_value"),
        day.alias("date"),
        F.coalesce(F.col("_val"), zero).alias("value"),
        growth_percent(F.col("_val"), prev).alias("delta"),
    )


def wide_increments(wide: DataFrame, id_cols: str | Sequence[str], value_type: str = "bigint") -> DataFrame:
    """:func:`epipanel.operators.series.increments` of a wide table, as long
    rows ``id_cols..., date, increment``."""
    id_cols = as_list(id_cols)
    fr = _Frame(wide, id_cols, value_type)
    inc = F.col("_val") - F.coalesce(F.col("_prev"), F.lit(0))
    return fr.exploded(id_cols, fr.filled()).select(
        *_ids(id_cols), F.get(fr.days, F.col("_pos")).alias("date"), inc.alias("increment")
    )


def wide_increment_table(wide: DataFrame, id_cols: str | Sequence[str], value_type: str = "bigint") -> DataFrame:
    """The wide table with every date column replaced by its increment
    (same column names), like the original's increment generator."""
    id_cols = as_list(id_cols)
    fr = _Frame(wide, id_cols, value_type)
    # plain per-column arithmetic on the staged array (codegen'd; built in
    # one selectExpr call however many columns)
    incs = [f"_v[0] - 0 AS {quote(fr.names[0])}"] + [
        f"_v[{k}] - coalesce(_f[{k - 1}], 0) AS {quote(name)}" for k, name in enumerate(fr.names) if k > 0
    ]
    staged = fr.staged.select(*_ids(id_cols), F.col("_v"), fr.filled().alias("_f"))
    return staged.selectExpr(*[quote(c) for c in id_cols], *incs)


def wide_percent_change(wide: DataFrame, id_cols: str | Sequence[str], value_type: str = "bigint") -> DataFrame:
    """:func:`epipanel.operators.series.percent_change` of a wide table, as
    long rows ``id_cols..., date, pct_change``."""
    id_cols = as_list(id_cols)
    fr = _Frame(wide, id_cols, value_type)
    change = fractional_change(F.col("_val"), F.col("_prev"))
    return fr.exploded(id_cols).select(
        *_ids(id_cols), F.get(fr.days, F.col("_pos")).alias("date"), change.alias("pct_change")
    )


def wide_percent_change_table(
    wide: DataFrame, id_cols: str | Sequence[str], value_type: str = "bigint"
) -> DataFrame:
    """The wide table with every date column replaced by its fractional
    day-over-day change (same column names, decimal with 3 places), like
    the original's percent-change generator."""
    id_cols = as_list(id_cols)
    fr = _Frame(wide, id_cols, value_type)
    changes = F.zip_with(fr.values, fr.shifted(fr.values), fractional_change)
    staged = fr.staged.select(*_ids(id_cols), changes.alias("_chg"))
    return _spread(staged, id_cols, "_chg", fr.names)


def wide_local_spikes(
    wide: DataFrame,
    id_cols: str | Sequence[str],
    key_cols: str | Sequence[str],
    threshold: float = 1.0,
    value_type: str = "bigint",
    cumulative: bool = False,
) -> DataFrame:
    """:func:`epipanel.operators.series.local_spikes` of a wide table of
    daily values (e.g. :func:`wide_increment_table`), one row per input row.
    With ``cumulative=True`` the table holds running totals and the daily
    increments are formed inside the same array expression.

    Output: ``key_cols..., count_high_days, highest_daily_value`` ordered
    like the long version; ``key_cols`` are taken from ``id_cols``. The
    peak and the count are row-local
    expressions (``array_max`` and a filtered ``size``): no shuffle; only the
    final presentation sort moves data.
    """
    id_cols = as_list(id_cols)
    key_cols = as_list(key_cols)
    fr = _Frame(wide, id_cols, value_type)
    values = fr.values
    staged = fr.staged
    if cumulative:
        # an empty cell has no increment and the next one counts from the last
        # value before it: the differences of the cells that are not empty
        held = F.array_compact(fr.values)
        before = F.slice(F.concat(F.array(F.lit(0).cast(value_type)), held), 1, F.size(held))
        values = F.zip_with(held, before, lambda x, y: x - y)
    with_peak = staged.select(*_ids(key_cols), values.alias("_d")).select(
        *_ids(key_cols), F.col("_d"), F.array_max("_d").alias("_peak")
    )
    p = F.col("_peak")
    count = F.size(
        F.filter("_d", lambda x: (p > 0) & (x.cast("double") >= F.lit(float(threshold)) * p.cast("double")))
    )
    return with_peak.select(
        *_ids(key_cols),
        count.cast("bigint").alias("count_high_days"),
        p.alias("highest_daily_value"),
    ).orderBy(
        F.col("count_high_days").desc(),
        F.col("highest_daily_value").desc(),
        *[F.col(quote(c)).asc_nulls_first() for c in key_cols],
    )


def wide_growth_extreme_report(
    wide: DataFrame,
    id_cols: str | Sequence[str],
    group_cols: str | Sequence[str],
    which: Sequence[str] | None = None,
    value_type: str = "bigint",
) -> DataFrame:
    """:func:`epipanel.operators.growth.growth_extreme_report` of a wide
    table: growth of every place on every date, the chosen extremes per
    group (all six by default) and the snapshot rows on those dates.

    The wide file is scanned twice (statistics, then snapshots) and never
    shuffled; only the small histogram and per-date tables move.
    """
    from epipanel.operators.growth import EXTREMES, growth_daily_stats, growth_extremes, median_for

    group_cols = as_list(group_cols)
    growth = wide_growth_factor(wide, id_cols, value_type)
    which = which or EXTREMES
    extremes = growth_extremes(growth_daily_stats(growth, group_cols, median=median_for(which)), group_cols, which=which)
    return wide_snapshots(wide, extremes, id_cols, group_cols, value_type)


def wide_snapshots(
    wide: DataFrame,
    extremes: DataFrame,
    id_cols: str | Sequence[str],
    group_cols: str | Sequence[str],
    value_type: str = "bigint",
) -> DataFrame:
    """:func:`epipanel.operators.growth.extreme_snapshots` of a wide table's
    growth. Each wide row is joined with its group's extreme dates (a counted
    broadcast) and only the cells of those dates and the days before are
    read from its array; no other date is exploded, nothing is shuffled.
    """
    from epipanel.operators.growth import _extreme_dates, _same
    from epipanel.plans.joins import checked_broadcast

    id_cols, group_cols = as_list(id_cols), as_list(group_cols)
    fr = _Frame(wide, id_cols, value_type)
    small, names = _extreme_dates(extremes, group_cols, "date")
    small = small.withColumn("_pos", F.array_position(fr.days, F.col("_on")).cast("int") - 1)
    small = checked_broadcast(small.where("_pos >= 1"))
    joined = fr.staged.join(small, _same([quote(c) for c in group_cols], names))
    pos = F.col("_pos")
    prev = F.when(F.get(fr.follows, pos), F.get("_v", pos - 1))
    value = F.get("_v", pos)
    zero = F.lit(0).cast(value_type)
    rest = [c for c in id_cols if c not in group_cols]
    return joined.select(
        *_ids(group_cols),
        "stat",
        "stat_value",
        *_ids(rest),
        F.date_sub("_on", 1).alias("prev_date"),
        F.coalesce(prev, zero).alias("prev_value"),
        F.col("_on").alias("date"),
        F.coalesce(value, zero).alias("value"),
        growth_percent(value, prev).alias("delta"),
    )
