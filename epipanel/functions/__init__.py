"""Column-level building blocks (pure ``Column -> Column`` expressions)."""

from epipanel.functions.allow_lists import US_STATES
from epipanel.functions.dates import (
    format_mdy,
    mdy_name,
    parse_mdy_name,
    parse_observation_date,
)
from epipanel.functions.numeric import (
    fractional_change,
    growth_percent,
    positive,
    ratio,
    to_count,
)

__all__ = [
    "US_STATES",
    "format_mdy",
    "fractional_change",
    "growth_percent",
    "mdy_name",
    "parse_mdy_name",
    "parse_observation_date",
    "positive",
    "ratio",
    "to_count",
]
