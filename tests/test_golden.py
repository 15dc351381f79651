"""Whole growth snapshots published by the original, recomputed.

Fixed values: two Arizona growth snapshots of the original's results
(county, count on the previous day, count on the day, growth delta),
transcribed as they are.
"""

from decimal import Decimal

import pytest
from conftest import rows

from epipanel.operators import growth_daily_stats, wide_growth_factor

MIN_DAY = (  # min-growth snapshot, 3/27/20 -> 3/28/20
    ("Maricopa, Arizona, US", 399, 454, "13.78"),
    ("Pima, Arizona, US", 102, 120, "17.65"),
    ("Navajo, Arizona, US", 49, 57, "16.33"),
    ("Coconino, Arizona, US", 41, 56, "36.59"),
    ("Pinal, Arizona, US", 36, 41, "13.89"),
    ("Apache, Arizona, US", 11, 13, "18.18"),
    ("Yavapai, Arizona, US", 9, 13, "44.44"),
    ("Graham, Arizona, US", 4, 2, "-50.00"),
    ("Mohave, Arizona, US", 4, 5, "25.00"),
    ("Yuma, Arizona, US", 4, 4, "0.00"),
    ("Cochise, Arizona, US", 2, 3, "50.00"),
    ("La Paz, Arizona, US", 2, 2, "0.00"),
    ("Santa Cruz, Arizona, US", 2, 2, "0.00"),
    ("Gila, Arizona, US", 0, 1, "0.00"),
    ("Greenlee, Arizona, US", 0, 0, "0.00"),
    ("Out of AZ, Arizona, US", 0, 0, "0.00"),
)

GREATEST_MEDIAN_DAY = (  # greatest-median snapshot, 3/25/20 -> 3/26/20
    ("Maricopa, Arizona, US", 251, 299, "19.12"),
    ("Pima, Arizona, US", 49, 75, "53.06"),
    ("Navajo, Arizona, US", 37, 43, "16.22"),
    ("Coconino, Arizona, US", 23, 28, "21.74"),
    ("Pinal, Arizona, US", 23, 35, "52.17"),
    ("Apache, Arizona, US", 7, 9, "28.57"),
    ("Yavapai, Arizona, US", 4, 5, "25.00"),
    ("Yuma, Arizona, US", 3, 4, "33.33"),
    ("Graham, Arizona, US", 2, 2, "0.00"),
    ("Cochise, Arizona, US", 1, 2, "100.00"),
    ("Santa Cruz, Arizona, US", 1, 2, "100.00"),
    ("Gila, Arizona, US", 0, 0, "0.00"),
    ("Greenlee, Arizona, US", 0, 0, "0.00"),
    ("La Paz, Arizona, US", 0, 2, "0.00"),
    ("Mohave, Arizona, US", 0, 2, "0.00"),
    ("Out of AZ, Arizona, US", 0, 0, "0.00"),
)


@pytest.mark.parametrize(
    "snapshot, prev_day, day, median, top, bottom",
    [
        (MIN_DAY, "3/27/20", "3/28/20", 13.78, 50.0, -50.0),
        (GREATEST_MEDIAN_DAY, "3/25/20", "3/26/20", 19.12, 100.0, 0.0),
    ],
)
def test_snapshot_file_recomputed(spark, snapshot, prev_day, day, median, top, bottom):
    # the wide file as the original reads it: all cells are text
    wide = spark.createDataFrame(
        [(loc, "Arizona", str(prev), str(cur)) for loc, prev, cur, _ in snapshot],
        f"Combined_Key string, Province_State string, `{prev_day}` string, `{day}` string",
    )
    growth = wide_growth_factor(wide, ["Combined_Key", "Province_State"])
    got = sorted(rows(growth, "Combined_Key", "prev_value", "value", "delta"))
    want = sorted((loc, prev, cur, Decimal(delta)) for loc, prev, cur, delta in snapshot)
    assert got == want

    stats = growth_daily_stats(growth, ["Province_State"]).first()
    assert (stats.median_delta, stats.max_delta, stats.min_delta, stats.n_entities) == (median, top, bottom, 16)
