"""Independent SQL (DuckDB dialect) for every query of the catalogue.

The SQL is written from the definitions, not from the Spark plans: windows
with ``row_number`` where Spark uses struct aggregates, self-joins where
Spark uses conditional aggregation, an integer HALF_UP average where Spark
uses decimal arithmetic. Parity rules:

* rounding: Spark rounds a double HALF_UP on its shortest decimal text, so
  the SQL rounds ``x::varchar::decimal`` rather than the binary double;
* exact lower median: ``quantile_disc(x, 0.5)`` (never ``median``, which
  interpolates);
* ``x / 0`` is guarded with ``nullif``; integer sums are cast to BIGINT.
"""

from __future__ import annotations

import datetime as _dt

from epipanel.plans.catalog import (
    CHANGE_DAYS,
    CHANGE_START,
    COUNTRY_ALLOW,
    SHIFT_DAYS,
    SHIFT_START,
    STATE_ALLOW,
    STATE_COUNTRY,
    TARGET_CONTAINS,
    TARGET_SUFFIX,
)


def _in_list(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


STATES = _in_list(STATE_ALLOW)
COUNTRIES = _in_list(COUNTRY_ALLOW)

# ---- stand-in inputs -------------------------------------------------------

OBS = """
geo AS (
  SELECT n_nationkey AS nation_key, n_name AS state, r_name AS country
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
obs AS (
  SELECT CAST(o.o_orderdate AS DATE) AS obs_date, g.state, g.country,
         COUNT(*) AS confirmed,
         COUNT(*) FILTER (WHERE o.o_orderstatus = 'F') AS deaths,
         COUNT(*) FILTER (WHERE o.o_orderstatus = 'O') AS recovered
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN geo g ON c.c_nationkey = g.nation_key
  GROUP BY 1, 2, 3
)"""

POP = """
geo_p AS (
  SELECT n_nationkey AS nation_key, n_name AS state
  FROM nation JOIN region ON n_regionkey = r_regionkey
),
pop AS (
  SELECT g.state, CAST(floor(c.c_acctbal) AS BIGINT) AS population
  FROM customer c JOIN geo_p g ON c.c_nationkey = g.nation_key
)"""


def event_panel_sql(name: str, keys: dict[str, str]) -> str:
    """Dense cumulative panel ``<keys>, date, value`` over ``events``."""
    key_exprs = ", ".join(f"{expr} AS {k}" for k, expr in keys.items())
    key_names = ", ".join(keys)
    using = ", ".join([*keys, "date"])
    return f"""
{name}_bounds AS (
  SELECT min(CAST(ts AS DATE)) AS lo, max(CAST(ts AS DATE)) AS hi FROM events
),
{name}_keys AS (SELECT DISTINCT {key_exprs} FROM events),
{name}_daily AS (
  SELECT {key_exprs}, CAST(ts AS DATE) AS date, COUNT(*) AS n FROM events GROUP BY ALL
),
{name}_spine AS (
  SELECT k.*, CAST(b.lo + CAST(t.i AS INTEGER) AS DATE) AS date
  FROM {name}_keys k, {name}_bounds b, range(0, (b.hi - b.lo) + 1) t(i)
),
{name} AS (
  SELECT s.{key_names.replace(', ', ', s.')}, s.date,
         CAST(SUM(COALESCE(d.n, 0)) OVER (
           PARTITION BY {', '.join('s.' + k for k in keys)} ORDER BY s.date
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS value
  FROM {name}_spine s LEFT JOIN {name}_daily d USING ({using})
)"""


PANEL = event_panel_sql("panel", {"grp": "user_id % 5", "location": "user_id"})
TYPE_PANEL = event_panel_sql("tpanel", {"combined_key": "event_type"})
WORLD_PANEL = event_panel_sql(
    "wpanel", {"province": "CAST(user_id % 5 AS VARCHAR)", "country": "event_type"}
)


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


# ---- growth ----------------------------------------------------------------

def growth_sql(src: str, name: str = "growth") -> str:
    """Growth rows of panel ``src(grp, location, date, value)``."""
    return f"""
{name}_lag AS (
  SELECT grp, location, date, value,
         lag(date) OVER (PARTITION BY grp, location ORDER BY date) AS prev_row_date,
         lag(value) OVER (PARTITION BY grp, location ORDER BY date) AS prev_row_value
  FROM {src}
),
{name}_prev AS (
  SELECT grp, location, date, value,
         CASE WHEN prev_row_date = date - 1 THEN prev_row_value END AS pv
  FROM {name}_lag WHERE prev_row_date IS NOT NULL
),
{name} AS (
  SELECT grp, location, CAST(date - 1 AS DATE) AS prev_date,
         COALESCE(pv, 0) AS prev_value, date, COALESCE(value, 0) AS value,
         COALESCE(TRY_CAST(CAST(
           (CAST(value AS DOUBLE) / NULLIF(CAST(pv AS DOUBLE), 0) - 1) * 100
           AS VARCHAR) AS DECIMAL(8,2)), CAST(0 AS DECIMAL(8,2))) AS delta
  FROM {name}_prev
)"""


def stats_sql(src: str, name: str = "stats") -> str:
    """Per (grp, date) statistics; the average is computed in integer
    hundredths and rounded HALF_UP to 6 places."""
    return f"""
{name}_raw AS (
  SELECT grp, date,
         quantile_disc(delta, 0.5) AS med,
         CAST(SUM(delta) * 100 AS BIGINT) AS s100,
         COUNT(*) AS n,
         max(delta) AS mx, min(delta) AS mn
  FROM {src} GROUP BY grp, date
),
{name} AS (
  SELECT grp, date,
         CAST(med AS DOUBLE) AS median_delta,
         CAST(sign(s100) * ((2 * abs(s100) * 10000 + n) // (2 * n)) AS DOUBLE) / 1e6 AS avg_delta,
         CAST(mx AS DOUBLE) AS max_delta,
         CAST(mn AS DOUBLE) AS min_delta,
         n AS n_entities
  FROM {name}_raw
)"""


_EXTREME_ORDER = {
    "greatest_median": ("median_delta", "DESC"),
    "greatest_avg": ("avg_delta", "DESC"),
    "least_median": ("median_delta", "ASC"),
    "least_avg": ("avg_delta", "ASC"),
    "max": ("max_delta", "DESC"),
    "min": ("min_delta", "ASC"),
}


def extremes_sql(src: str, name: str = "extremes", which=tuple(_EXTREME_ORDER)) -> str:
    arms = []
    for stat in which:
        col, direction = _EXTREME_ORDER[stat]
        arms.append(
            f"SELECT grp, '{stat}' AS stat, date, {col} AS value, "
            f"row_number() OVER (PARTITION BY grp ORDER BY {col} {direction}, date ASC) AS rn FROM {src}"
        )
    union = "\n  UNION ALL ".join(arms)
    return f"""
{name}_ranked AS (
  {union}
),
{name} AS (SELECT grp, stat, date, value FROM {name}_ranked WHERE rn = 1)"""


SNAPSHOT_SELECT = """
SELECT g.grp, e.stat, e.value AS stat_value, g.location, g.prev_date, g.prev_value,
       g.date, g.value, g.delta
FROM growth g JOIN extremes e ON g.grp IS NOT DISTINCT FROM e.grp AND g.date = e.date"""

# the panel with a null group and empty cells
GAP_PANEL = """
gpanel AS (
  SELECT nullif(grp, 0) AS grp, location, date,
         CASE WHEN (location * 7 + day(date)) % 11 <> 0 THEN value END AS value
  FROM panel
)"""
GAP_STEPS = """
gsteps AS (
  SELECT grp, location, date,
         value - COALESCE(last_value(value IGNORE NULLS) OVER (
           PARTITION BY grp, location ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS increment
  FROM gpanel
)"""
GAP_SPIKES = """
SELECT grp, location,
       COUNT(*) FILTER (WHERE peak > 0 AND CAST(increment AS DOUBLE) >= CAST(peak AS DOUBLE)) AS count_high_days,
       max(increment) AS highest_daily_value
FROM (SELECT *, max(increment) OVER (PARTITION BY grp, location) AS peak FROM gsteps) t
GROUP BY grp, location"""

GAP_HIGH = """
ghigh AS (
  SELECT grp, location, date, increment, CAST(increment AS DOUBLE) / CAST(peak AS DOUBLE) AS share
  FROM (SELECT *, max(increment) OVER (PARTITION BY grp, location) AS peak FROM gsteps) t WHERE peak > 0
)"""
SPIKE_LENGTHS = """
SELECT grp, location, min(date) AS first_day, max(date) AS last_day, COUNT(*) AS days, CAST(SUM(increment) AS BIGINT) AS total
FROM (
  SELECT *, date - CAST(row_number() OVER (PARTITION BY grp, location ORDER BY date) AS INTEGER) AS run
  FROM ghigh WHERE share >= 0.5
) t GROUP BY grp, location, run"""

# The days of the events table.
DAYS = [_dt.date(2024, 1, 1) + _dt.timedelta(days=i) for i in range(30)]


def _one_column_per_day(value: str, src: str) -> str:
    """A wide table without a pivot, which a view could not hold."""
    cells = ", ".join(f"max({value}) FILTER (WHERE date = DATE '{d}') AS d{d:%Y%m%d}" for d in DAYS)
    return f"\nSELECT grp, location, {cells} FROM {src} GROUP BY grp, location"


def _single(stat: str) -> str:
    return (
        _with(PANEL, growth_sql("panel"), stats_sql("growth"), extremes_sql("stats", which=(stat,)))
        + SNAPSHOT_SELECT
    )


INCREMENT_PANEL = """
ipanel AS (
  SELECT grp, location, date,
         value - COALESCE(lag(value) OVER (PARTITION BY grp, location ORDER BY date), 0) AS value
  FROM panel
)"""


def _spikes(panel_cte: str, panel_name: str, keys: list[str], threshold: float) -> str:
    k = ", ".join(keys)
    s_keys = ", ".join("s." + c for c in keys)
    steps = f"""
steps AS (
  SELECT {k}, date,
         value - COALESCE(lag(value) OVER (PARTITION BY {k} ORDER BY date), 0) AS inc
  FROM {panel_name}
)"""
    peaks = f"""
peaks AS (SELECT {k}, max(inc) AS peak FROM steps GROUP BY {k})"""
    return _with(panel_cte, steps, peaks) + f"""
SELECT {s_keys},
       COUNT(*) FILTER (WHERE p.peak > 0
                        AND CAST(s.inc AS DOUBLE) >= {threshold!r} * CAST(p.peak AS DOUBLE)) AS count_high_days,
       max(s.inc) AS highest_daily_value
FROM steps s JOIN peaks p USING ({k})
GROUP BY {s_keys}"""


def _first(measure: str, entity: str, tie: str, where: str = "", allow: str = "", target: str = "") -> str:
    return _with(OBS, _first_cte("f", measure, entity, tie, where, allow, target)) + "SELECT * FROM f"


def _accum(entity: str, allow: str, suffix: str = "") -> str:
    extra = f" AND suffix({entity}, '{suffix}')" if suffix else ""
    return f"""
SELECT {entity},
       CAST(SUM(confirmed) AS BIGINT) AS total_confirmed,
       CAST(SUM(deaths) AS BIGINT) AS total_deaths,
       CAST(SUM(recovered) AS BIGINT) AS total_recovered
FROM obs WHERE {entity} IN ({allow}){extra}
GROUP BY {entity}"""


def _topk(entity: str, allow: str, descending: bool) -> str:
    direction = "DESC" if descending else "ASC"
    return _with(OBS, f"acc AS ({_accum(entity, allow)})") + f"""
SELECT {entity}, total_confirmed AS infected FROM acc
ORDER BY total_confirmed {direction} NULLS LAST, {entity} ASC NULLS LAST LIMIT 10"""


def _ratio(n: str, d: str) -> str:
    """round(n/d, 2) on the shortest decimal text of the double quotient."""
    q = f"CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0)"
    return f"CAST(round(CAST(CAST({q} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def _first_cte(
    name: str, measure: str, entity: str, tie: str, where: str = "", allow: str = "", target: str = ""
) -> str:
    """Earliest positive row per entity by (date, tie-break nulls first, measure)."""
    conds = [f"{measure} > 0"] + ([where] if where else [])
    outer = ["rn = 1"]
    if allow:
        outer.append(f"{entity} IN ({allow})")
    if target:
        outer.append(f"contains({entity}, '{target}')")
    return f"""
{name} AS (
  SELECT {entity}, first_{measure}_date, {measure} FROM (
    SELECT {entity}, obs_date AS first_{measure}_date, {measure},
           row_number() OVER (PARTITION BY {entity} ORDER BY obs_date, {tie} NULLS FIRST, {measure}) AS rn
    FROM obs WHERE {' AND '.join(conds)}
  ) t WHERE {' AND '.join(outer)}
)"""


REL_COUNTRY = _with(
    OBS,
    _first_cte("fc", "confirmed", "country", "state", "", COUNTRIES),
    _first_cte("fd", "deaths", "country", "state", "", COUNTRIES),
    f"acc AS ({_accum('country', COUNTRIES)})",
) + f"""
SELECT fc.first_confirmed_date, fc.confirmed, fd.first_deaths_date, fd.deaths, a.country,
       {_ratio('a.total_deaths', 'a.total_confirmed')} AS case_fatality_ratio,
       {_ratio('a.total_recovered', 'a.total_confirmed')} AS case_recovery_ratio
FROM acc a JOIN fc ON a.country = fc.country JOIN fd ON a.country = fd.country"""

REL_STATE = _with(
    OBS,
    POP,
    _first_cte("fc", "confirmed", "state", "country", f"country = '{STATE_COUNTRY}'", STATES),
    _first_cte("fd", "deaths", "state", "country", f"country = '{STATE_COUNTRY}'", STATES),
    f"acc AS ({_accum('state', STATES)})",
    f"pr AS (SELECT state, CAST(SUM(population) AS BIGINT) AS population FROM pop WHERE state IN ({STATES}) GROUP BY state)",
) + f"""
SELECT fc.first_confirmed_date, fc.confirmed, fd.first_deaths_date, fd.deaths, a.state,
       {_ratio('a.total_deaths', 'a.total_confirmed')} AS case_fatality_ratio,
       {_ratio('a.total_deaths', 'pr.population')} AS mortality_ratio,
       {_ratio('a.total_recovered', 'a.total_confirmed')} AS case_recovery_ratio
FROM acc a JOIN fc ON a.state = fc.state JOIN fd ON a.state = fd.state JOIN pr ON a.state = pr.state"""


def _pct(value: str, prev: str) -> str:
    q = f"CAST({value} AS DOUBLE) / NULLIF(CAST({prev} AS DOUBLE), 0) - 1"
    zero = "CAST(0 AS DECIMAL(38,3))"
    return (
        f"CASE WHEN {value} IS NULL THEN NULL WHEN COALESCE({prev}, 0) = 0 THEN {zero} "
        f"ELSE COALESCE(TRY_CAST(CAST({q} AS VARCHAR) AS DECIMAL(38,3)), {zero}) END"
    )


CHANGE_END = f"(DATE '{CHANGE_START}' + {CHANGE_DAYS})"

ORACLE: dict[str, str] = {
    "growth_factor": _with(PANEL, growth_sql("panel")) + "SELECT * FROM growth",
    "growth_daily_stats": _with(PANEL, growth_sql("panel"), stats_sql("growth")) + "SELECT * FROM stats",
    "growth_extremes": _with(PANEL, growth_sql("panel"), stats_sql("growth"), extremes_sql("stats"))
    + "SELECT * FROM extremes",
    "growth_extreme_snapshots": _with(PANEL, growth_sql("panel"), stats_sql("growth"), extremes_sql("stats"))
    + SNAPSHOT_SELECT,
    "growth_factor_of_increment": _with(PANEL, INCREMENT_PANEL, growth_sql("ipanel")) + "SELECT * FROM growth",
    "growth_extremes_of_increment": _with(
        PANEL, INCREMENT_PANEL, growth_sql("ipanel"), stats_sql("growth"), extremes_sql("stats")
    )
    + "SELECT * FROM extremes",
    "growth_greatest_median": _single("greatest_median"),
    "growth_greatest_avg": _single("greatest_avg"),
    "growth_least_median": _single("least_median"),
    "growth_least_avg": _single("least_avg"),
    "growth_max": _single("max"),
    "growth_min": _single("min"),
    "daily_increment": _with(PANEL) + """
SELECT grp, location, date,
       value - COALESCE(lag(value) OVER (PARTITION BY grp, location ORDER BY date), 0) AS increment
FROM panel""",
    "percent_change": _with(PANEL) + f"""
SELECT grp, location, date, {_pct('value', 'pv')} AS pct_change
FROM (SELECT *, lag(value) OVER (PARTITION BY grp, location ORDER BY date) AS pv FROM panel) t""",
    "percent_change_of_increment": _with(PANEL, INCREMENT_PANEL) + f"""
SELECT grp, location, date, {_pct('value', 'pv')} AS pct_change
FROM (SELECT *, lag(value) OVER (PARTITION BY grp, location ORDER BY date) AS pv FROM ipanel) t""",
    "local_spikes_us": _spikes(TYPE_PANEL, "tpanel", ["combined_key"], 1.0),
    "local_spikes_world": _spikes(WORLD_PANEL, "wpanel", ["province", "country"], 1.0),
    "local_spikes_threshold_095": _spikes(TYPE_PANEL, "tpanel", ["combined_key"], 0.95),
    "change_over_time": _with(PANEL) + f"""
SELECT a.grp, a.location, a.date AS start_date, a.value AS start_value,
       b.date AS end_date, b.value AS end_value, b.value - a.value AS delta
FROM panel a JOIN panel b ON a.grp = b.grp AND a.location = b.location
WHERE a.date = DATE '{CHANGE_START}' AND b.date = {CHANGE_END}""",
    "shift_observed_date": _with(OBS) + f"""
SELECT DISTINCT obs_date AS start_date, CAST(obs_date + {SHIFT_DAYS} AS DATE) AS shifted_date,
       strftime(CAST(obs_date + {SHIFT_DAYS} AS DATE), '%-m/%-d/%y') AS shifted_text
FROM obs WHERE obs_date = DATE '{SHIFT_START}'""",
    "cleanse_states": _with(OBS) + f"SELECT * FROM obs WHERE state IN ({STATES})",
    "cleanse_countries": _with(OBS) + f"SELECT * FROM obs WHERE country IN ({COUNTRIES})",
    "first_confirmed_country": _first("confirmed", "country", "state", allow=COUNTRIES),
    "first_confirmed_state": _first(
        "confirmed", "state", "country", where=f"country = '{STATE_COUNTRY}'", allow=STATES
    ),
    "first_deaths_country": _first("deaths", "country", "state", allow=COUNTRIES),
    "first_deaths_state": _first("deaths", "state", "country", where=f"country = '{STATE_COUNTRY}'", allow=STATES),
    "first_occurrence_target": _first("confirmed", "state", "country", target=TARGET_CONTAINS),
    "accum_country": _with(OBS) + _accum("country", COUNTRIES),
    "accum_state": _with(OBS) + _accum("state", STATES),
    "accum_target": _with(OBS) + _accum("state", STATES, suffix=TARGET_SUFFIX),
    "accum_country_latest": _with(OBS) + f"""
SELECT country,
       CAST(SUM(confirmed) AS BIGINT) AS total_confirmed,
       CAST(SUM(deaths) AS BIGINT) AS total_deaths,
       CAST(SUM(recovered) AS BIGINT) AS total_recovered
FROM (
  SELECT *, row_number() OVER (PARTITION BY country, state ORDER BY obs_date DESC) AS rn
  FROM obs WHERE country IN ({COUNTRIES}) AND obs_date IS NOT NULL
) t WHERE rn = 1
GROUP BY country""",
    "population_rollup": _with(POP) + f"""
SELECT state, CAST(SUM(population) AS BIGINT) AS population
FROM pop WHERE state IN ({STATES}) GROUP BY state""",
    "top10_country": _topk("country", COUNTRIES, True),
    "bottom10_country": _topk("country", COUNTRIES, False),
    "top10_state": _topk("state", STATES, True),
    "bottom10_state": _topk("state", STATES, False),
    "relationship_country": REL_COUNTRY,
    "relationship_state": REL_STATE,
    "densify_observations": _with(OBS) + """
SELECT s.state, CAST(b.lo + CAST(t.i AS INTEGER) AS DATE) AS obs_date, o.confirmed
FROM (SELECT DISTINCT state FROM obs) s
CROSS JOIN (SELECT min(obs_date) AS lo, max(obs_date) AS hi FROM obs) b
CROSS JOIN range(0, (b.hi - b.lo) + 1) t(i)
LEFT JOIN obs o ON o.state = s.state AND o.obs_date = CAST(b.lo + CAST(t.i AS INTEGER) AS DATE)""",
    "long_to_wide": _with(PANEL) + _one_column_per_day("value", "panel"),
    "gap_daily_increment": _with(PANEL, GAP_PANEL, GAP_STEPS) + "SELECT * FROM gsteps",
    "gap_percent_change": _with(PANEL, GAP_PANEL) + f"""
SELECT grp, location, date, {_pct('value', 'pv')} AS pct_change
FROM (SELECT *, lag(value) OVER (PARTITION BY grp, location ORDER BY date) AS pv FROM gpanel) t""",
    "gap_local_spikes": _with(PANEL, GAP_PANEL, GAP_STEPS) + GAP_SPIKES,
    "spike_days": _with(PANEL, GAP_PANEL, GAP_STEPS, GAP_HIGH)
    + "SELECT grp, location, date, increment AS value, share FROM ghigh WHERE share >= 1",
    "spike_lengths": _with(PANEL, GAP_PANEL, GAP_STEPS, GAP_HIGH) + SPIKE_LENGTHS,
    "gap_growth_extreme_snapshots": _with(
        PANEL, GAP_PANEL, growth_sql("gpanel"), stats_sql("growth"), extremes_sql("stats")
    )
    + SNAPSHOT_SELECT,
    "densify_null_entity": _with(OBS) + f"""
, o AS (
  SELECT nullif(state, 'NATION_3') AS state, nullif(obs_date, DATE '{SHIFT_START}') AS obs_date, confirmed FROM obs
)
SELECT s.state, CAST(b.lo + CAST(t.i AS INTEGER) AS DATE) AS obs_date, o.confirmed
FROM (SELECT DISTINCT state FROM o) s
CROSS JOIN (SELECT min(obs_date) AS lo, max(obs_date) AS hi FROM o) b
CROSS JOIN range(0, (b.hi - b.lo) + 1) t(i)
LEFT JOIN o ON o.state IS NOT DISTINCT FROM s.state AND o.obs_date = CAST(b.lo + CAST(t.i AS INTEGER) AS DATE)
UNION ALL SELECT * FROM o WHERE obs_date IS NULL""",
    "population_text": _with(POP) + f"""
SELECT state, CAST(SUM(population) FILTER (numbered) AS BIGINT) AS population
FROM (
  SELECT g.state, CAST(floor(c.c_acctbal) AS BIGINT) AS population, c.c_custkey % 10 <> 0 AS numbered
  FROM customer c JOIN geo_p g ON c.c_nationkey = g.nation_key
) t WHERE state IN ({STATES}) GROUP BY state""",
    "fill_identity": _with(PANEL, GAP_PANEL)
    + "SELECT COALESCE(CAST(grp AS VARCHAR), ' ') AS grp, location, date, value FROM gpanel",
    "cleanse_states_table": _with(OBS)
    + f"SELECT * FROM obs WHERE state IN (SELECT state FROM geo WHERE country = '{STATE_COUNTRY}')",
    "wide_increment_table": _with(PANEL, GAP_PANEL, GAP_STEPS) + _one_column_per_day("increment", "gsteps"),
    "wide_percent_change_table": _with(PANEL, GAP_PANEL, f"""
gpct AS (
  SELECT grp, location, date, {_pct('value', 'pv')} AS pct_change
  FROM (SELECT *, lag(value) OVER (PARTITION BY grp, location ORDER BY date) AS pv FROM gpanel) t
)""") + _one_column_per_day("pct_change", "gpct"),
    "wide_round_trip": _with(OBS) + """
SELECT country, obs_date AS date, CAST(SUM(confirmed) AS BIGINT) AS value
FROM obs GROUP BY country, obs_date""",
    "single_file_header": _with(OBS) + _accum("state", STATES),
    "single_file_no_header": _with(OBS) + _accum("state", STATES),
    "wide_to_long": _with(PANEL) + "SELECT grp, location, date, value FROM panel",
    "csv_round_trip": _with(PANEL, growth_sql("panel"), stats_sql("growth"), extremes_sql("stats"))
    + SNAPSHOT_SELECT,
    "observations_csv": _with(OBS) + "SELECT * FROM obs",
}


# The wide-table queries must give exactly the long-panel answers.
ORACLE.update(
    {
        "wide_gap_daily_increment": ORACLE["gap_daily_increment"],
        "wide_gap_local_spikes": ORACLE["gap_local_spikes"],
        "wide_gap_growth_extreme_snapshots": ORACLE["gap_growth_extreme_snapshots"],
        # the sketch is exact for groups of this size (30 / 300 places); its
        # rank error at larger groups is tested on its own
        "growth_daily_stats_sketch": ORACLE["growth_daily_stats"],
        "wide_growth_factor": ORACLE["growth_factor"],
        "wide_growth_extremes": ORACLE["growth_extremes"],
        "wide_growth_extreme_snapshots": ORACLE["growth_extreme_snapshots"],
        "wide_daily_increment": ORACLE["daily_increment"],
        "wide_percent_change": ORACLE["percent_change"],
        "wide_local_spikes_us": ORACLE["local_spikes_us"],
        "wide_local_spikes_world": ORACLE["local_spikes_world"],
        "relationship_state_joined": ORACLE["relationship_state"],
        "streaming_accum_state": ORACLE["accum_state"],
        "streaming_first_confirmed_country": ORACLE["first_confirmed_country"],
        "streaming_relationship_country": ORACLE["relationship_country"],
    }
)


def oracle_sql() -> dict[str, str]:
    from epipanel.plans import comparisons

    return {**ORACLE, **comparisons.ORACLE}
