"""Null-, zero- and overflow-safe arithmetic under ANSI mode.

Spark 4 runs with ANSI semantics: ``x / 0``, a failed cast and a decimal
overflow raise instead of yielding null. The analyses need the old
"null, then zero" behaviour, so every ratio here goes through ``try_*``
functions, which stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from epipanel.functions.columns import as_col

# Fixed output types of the analyses.
GROWTH_TYPE = "decimal(8,2)"        # growth percent, two places
PCT_CHANGE_TYPE = "decimal(38,3)"   # fractional day-over-day change, three places; no bigint ratio overflows it


def ratio(numerator, denominator, places: int = 2) -> Column:
    """``round(n / d, places)`` as a double; null when ``d`` is 0 or null.

    Spark rounds a double HALF_UP on its shortest decimal text, so
    ``0.145`` becomes ``0.15``.
    """
    n = as_col(numerator).cast("double")
    d = as_col(denominator).cast("double")
    return F.round(F.try_divide(n, d), places)


def growth_percent(today, yesterday) -> Column:
    """``((today / yesterday) - 1) * 100`` as decimal(8,2); 0 when undefined.

    Undefined covers a zero or missing previous value and a result that does
    not fit decimal(8,2): all read as 0, never as an error.
    """
    t = as_col(today).cast("double")
    y = as_col(yesterday).cast("double")
    raw = (F.try_divide(t, y) - F.lit(1.0)) * F.lit(100.0)
    return F.coalesce(raw.try_cast(GROWTH_TYPE), F.lit(0).cast(GROWTH_TYPE))


def fractional_change(today, yesterday) -> Column:
    """``today / yesterday - 1`` rounded HALF_UP to 3 places; 0.000 when
    ``yesterday`` is 0 or missing (also the first day of a series). An empty
    cell today has no change: null."""
    t = as_col(today).cast("double")
    y = as_col(yesterday).cast("double")
    raw = F.try_divide(t, y) - F.lit(1.0)
    zero = F.lit(0).cast(PCT_CHANGE_TYPE)
    change = F.when(F.coalesce(y, F.lit(0.0)) == 0, zero).otherwise(
        F.coalesce(raw.try_cast(PCT_CHANGE_TYPE), zero)
    )
    return F.when(t.isNotNull(), change)


def to_count(c) -> Column:
    """A measure cell (possibly text) as a bigint count; junk becomes null."""
    c = as_col(c)
    return F.coalesce(c.try_cast("bigint"), c.try_cast("double").try_cast("bigint"))


def positive(c) -> Column:
    """``c > 0`` for a numeric or textual measure; text like ``'5.0'`` counts."""
    return F.coalesce(as_col(c).try_cast("double") > 0, F.lit(False))
