"""Wide (one column per date) <-> long (one row per entity and date) panels.

The analyses run on the long panel ``(entity cols..., date, value)``. The
wide files are an adapter at the edges: identity columns are named by the
caller, date columns are recognised by their *names* (``M/d/yy``), so a null
identity cell can never shift a series (every value keeps its own date).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.functions.columns import as_list
from epipanel.functions.dates import mdy_name, parse_mdy_name


def date_columns(df: DataFrame, id_cols: Sequence[str]) -> list[tuple[str, object]]:
    """Driver-side schema inspection: ``(column name, date)`` of every
    non-identity column whose name parses as ``M/d/yy``, in date order."""
    ids = set(id_cols)
    found = [(c, parse_mdy_name(c)) for c in df.columns if c not in ids]
    dated = sorted([(c, d) for c, d in found if d is not None], key=lambda p: p[1])
    for (a, first), (b, second) in zip(dated, dated[1:]):
        if first == second:
            raise ValueError(f"columns {a!r} and {b!r} stand for the same date")
    return dated


def stage_cells(
    df: DataFrame, id_cols: Sequence[str], value_type: str = "bigint", cells_col: str = "_v"
) -> tuple[DataFrame, list[tuple[str, _dt.date]]]:
    """Driver-side schema work plus one projection: identity columns and an
    array of the typed date cells (in date order) per row.

    The whole array is typed by one cast (codegen'd, no per-cell
    expressions): text counts go through ``decimal(38,18)``, so integers
    stay exact and ``12.0`` reads as 12 (like ``functions.to_count``); junk
    reads as null. Every later per-date expression reads this one column.
    """
    dates = date_columns(df, id_cols)
    if not dates:
        raise ValueError("no column name parses as M/d/yy")
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}  # one schema fetch
    kinds = {types[name] for name, _ in dates}
    # thousands of date columns: build the array as one SQL expression (one
    # call into the JVM) rather than one Column object per cell
    cast = "" if len(kinds) == 1 else " AS string"
    raw = F.expr(
        "array(" + ", ".join(f"CAST({quote(name)}{cast})" if cast else quote(name) for name, _ in dates) + ")"
    )
    if kinds == {value_type}:
        cells = raw
    elif value_type == "bigint":
        cells = raw.try_cast("array<decimal(38,18)>").try_cast("array<bigint>")
    else:
        cells = raw.try_cast(f"array<{value_type}>")
    staged = df.select(*[F.col(quote(c)) for c in id_cols], cells.alias(cells_col))
    return staged, dates


def quote(name: str) -> str:
    """A column name as a SQL identifier (names like ``1/22/20`` need it)."""
    return "`" + name.replace("`", "``") + "`"


def literal_array(values) -> Column:
    """A literal array of dates / booleans / ints as one SQL expression."""
    def lit(v):
        if isinstance(v, bool):
            return "true" if v else "false"
        if isinstance(v, _dt.date):
            return f"DATE'{v.isoformat()}'"
        return str(int(v))

    return F.expr("array(" + ", ".join(lit(v) for v in values) + ")")


def wide_to_long(
    df: DataFrame,
    id_cols: Sequence[str],
    value_col: str = "value",
    date_col: str = "date",
    value_type: str = "bigint",
) -> DataFrame:
    """Unpivot a wide time-series table to ``(id_cols..., date, value)``.

    Each wide row becomes one row per date column; dates come from the
    column names at plan time (a literal array), so no per-row string
    parsing happens. Cells that are not numbers become null values (not
    errors). A narrow per-row ``Generate``: no shuffle.
    """
    id_cols = as_list(id_cols)
    staged, dates = stage_cells(df, id_cols, value_type)
    days = literal_array([d for _, d in dates])
    ids = [F.col(quote(c)) for c in id_cols]
    exploded = staged.select(*ids, F.posexplode("_v").alias("_pos", value_col))
    return exploded.select(*ids, F.get(days, F.col("_pos")).alias(date_col), F.col(value_col))


def long_to_wide(
    df: DataFrame,
    id_cols: Sequence[str],
    date_col: str = "date",
    value_col: str = "value",
    dates: Sequence | None = None,
    name_of=mdy_name,
) -> DataFrame:
    """Pivot ``(id_cols..., date, value)`` to one column per date.

    ``dates`` fixes the output schema; when omitted Spark's own pivot finds
    the distinct dates (bounded by the calendar, and Spark refuses more than
    ``spark.sql.pivotMaxValues``); rows without a date have no column to go
    to and are left out. Where an entity's date is repeated the largest value
    counts, so a task run again gives the same. Columns are named ``name_of(date)``
    (``M/d/yy`` by default). One shuffle on the identity columns; each
    entity holds at most one row per date.
    """
    id_cols = as_list(id_cols)
    grouped = df.where(F.col(date_col).isNotNull()).groupBy(*id_cols)
    pivoted = (
        grouped.pivot(date_col, list(dates)) if dates is not None else grouped.pivot(date_col)
    ).agg(F.max(value_col))
    renamed = [name_of(_dt.date.fromisoformat(c)) for c in pivoted.columns[len(id_cols):]]
    return pivoted.toDF(*id_cols, *renamed)


def densify(
    df: DataFrame,
    entity_cols: Sequence[str],
    date_col: str = "date",
    start=None,
    end=None,
) -> DataFrame:
    """Give every entity a row for every day from ``start`` to ``end``.

    Missing days get null in the other columns. ``start``/``end`` default to
    the panel's first and last date (scalar subqueries, one small job each).
    The spine is generated per entity with ``sequence`` + ``explode`` — no
    cross join — and joined back on ``(entity, date)``, nulls in entity
    columns being equal. No row is lost: rows without a date, and rows
    outside ``start`` to ``end``, are passed through beside the spine.
    """
    entity_cols = as_list(entity_cols)
    lo = F.lit(start) if start is not None else df.select(F.min(date_col)).scalar()
    hi = F.lit(end) if end is not None else df.select(F.max(date_col)).scalar()
    spine = (
        df.select(*entity_cols)
        .distinct()
        .select(*entity_cols, F.explode(F.sequence(lo, hi)).alias(date_col))
    )
    keys = [*entity_cols, date_col]
    spine = spine.toDF(*[f"_spine{i}" for i in range(len(keys))])
    same = reduce(and_, [F.col(f"_spine{i}").eqNullSafe(F.col(quote(c))) for i, c in enumerate(keys)])
    rest = [c for c in df.columns if c not in keys]
    out = [F.col(f"_spine{i}").alias(c) for i, c in enumerate(keys)] + [F.col(quote(c)) for c in rest]
    on_spine = spine.join(df, same, "left").select(*out)
    inside = F.coalesce(F.col(quote(date_col)).between(lo, hi), F.lit(False))
    return on_spine.unionAll(df.where(~inside).select(*[F.col(quote(c)) for c in [*keys, *rest]]))
