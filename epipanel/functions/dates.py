"""Date parsing and formatting as Spark column expressions."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from epipanel.functions.columns import as_col

# Fixed formats of the source files: observation dates are written
# ``MM/dd/yyyy`` (or two-digit years); wide time-series columns are named
# ``M/d/yy`` (e.g. ``1/22/20``).
OBSERVATION_DATE_FORMATS = ("MM/dd/yyyy", "M/d/yyyy", "MM/dd/yy", "M/d/yy")
WIDE_COLUMN_FORMAT = "M/d/yy"
WIDE_COLUMN_LONG_FORMAT = "M/d/yyyy"

# Fixed value: the hundred years that two-digit years stand for (80 years back
# and 20 ahead of the case files, as the original's date parser reads them).
# Dates outside of it are written with four digits.
TWO_DIGIT_YEARS = range(1941, 2041)


def parse_observation_date(c) -> Column:
    """Parse an observation-date string; unparseable text becomes null.

    Four-digit years are tried first so ``01/22/2020`` is never read as the
    year 20; two-digit years stand for ``TWO_DIGIT_YEARS``. ``try_to_date``
    keeps ANSI mode from failing the whole job on one malformed cell.
    """
    c = as_col(c)
    four = [F.try_to_date(c, fmt) for fmt in OBSERVATION_DATE_FORMATS if "yyyy" in fmt]
    two = F.coalesce(*[F.try_to_date(c, fmt) for fmt in OBSERVATION_DATE_FORMATS if "yyyy" not in fmt])
    # Spark reads two-digit years as 2000 to 2099
    two = F.when(F.year(two) > TWO_DIGIT_YEARS[-1], F.add_months(two, -1200)).otherwise(two)
    return F.coalesce(*four, two)


def format_mdy(c) -> Column:
    """Format a date like the wide files' column names: ``M/d/yy``, or
    ``M/d/yyyy`` outside of ``TWO_DIGIT_YEARS``."""
    c = as_col(c)
    short = F.year(c).between(TWO_DIGIT_YEARS[0], TWO_DIGIT_YEARS[-1])
    return F.when(short, F.date_format(c, WIDE_COLUMN_FORMAT)).otherwise(F.date_format(c, WIDE_COLUMN_LONG_FORMAT))


def parse_mdy_name(name: str) -> _dt.date | None:
    """Driver-side: the date a wide column name stands for, else None.

    Only column *names* (schema metadata) are parsed here, never data.
    """
    parts = name.strip().split("/")
    if len(parts) != 3 or not all(p.isdigit() for p in parts):
        return None
    month, day, year = (int(p) for p in parts)
    if len(parts[2]) <= 2:
        year += 2000 if 2000 + year in TWO_DIGIT_YEARS else 1900
    try:
        return _dt.date(year, month, day)
    except ValueError:
        return None


def mdy_name(d: _dt.date) -> str:
    """Driver-side inverse of :func:`parse_mdy_name` (``1/22/20``, or
    ``1/22/1920`` where two digits would stand for another year)."""
    year = f"{d.year % 100:02d}" if d.year in TWO_DIGIT_YEARS else f"{d.year:04d}"
    return f"{d.month}/{d.day}/{year}"
