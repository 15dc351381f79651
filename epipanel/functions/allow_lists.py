"""Allow-lists used to keep only recognised entities.

The country allow-list of the original analysis has about 240 spellings
(including "Mainland China" and "Russian Federation"); it is not
reproduced here. Countries are always a caller-supplied parameter: a Python
list, or a one-column DataFrame / table for long lists.
"""

from __future__ import annotations

# The 57 US states and territories accepted for state-level
# results, in their original order and spelling.
US_STATES = (
    "Alabama", "Alaska", "American Samoa", "Arizona", "Arkansas", "California",
    "Colorado", "Connecticut", "Delaware", "District of Columbia", "Florida", "Georgia", "Guam", "Hawaii",
    "Idaho", "Illinois", "Indiana", "Iowa", "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts",
    "Michigan", "Minnesota", "Minor Outlying Islands", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada",
    "New Hampshire", "New Jersey", "New Mexico", "New York", "North Carolina", "North Dakota", "Northern Mariana Islands",
    "Ohio", "Oklahoma", "Oregon", "Pennsylvania", "Puerto Rico", "Rhode Island", "South Carolina", "South Dakota", "Tennessee",
    "Texas", "U.S. Virgin Islands", "Utah", "Vermont", "Virginia", "Washington", "West Virginia", "Wisconsin", "Wyoming",
)

# Above this many literals an allow-list is applied as a left-semi join
# instead of an IN-list filter (InSet is pushed into the Parquet scan, but a
# huge literal list bloats every task's serialized plan).
INLIST_MAX = 5_000
