"""Structured Streaming entry points (incremental totals and first dates)."""

from epipanel.streaming.feed import (
    observation_stream,
    publish,
    read_published,
    running_first_occurrence,
    running_outcome_ratios,
    running_totals,
)

__all__ = [
    "observation_stream",
    "publish",
    "read_published",
    "running_first_occurrence",
    "running_outcome_ratios",
    "running_totals",
]
