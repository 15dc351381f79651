"""Queries of the analyses that compare places with each other (names,
neighbours, holidays, seasons, levels, classes), and their SQL.

The SQL is written from the definitions: all pairs where Spark uses a grid or a
prefix join, window functions where Spark uses histograms, published dates of Easter
where Spark computes them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epipanel.operators.growth import growth_factor
from epipanel.operators.growth_levels import (
    compare_spike_lengths,
    growth_by_class,
    growth_level_stats,
    growth_moments,
    growth_statistics,
    merge_moments,
    population_classes,
)
from epipanel.operators.holidays import holiday_calendar, holiday_spike_rates
from epipanel.operators.names import match_names, match_places, rename_matched
from epipanel.operators.neighbours import compare_with_neighbours, lagged_correlation, nearest_places
from epipanel.operators.occurrence import first_occurrence
from epipanel.operators.seasons import season_spike_rates, seasonal_residuals
from epipanel.operators.series import increments, spike_days, spike_lengths
from epipanel.plans.oracle import GAP_HIGH, GAP_PANEL, GAP_STEPS, OBS, PANEL, SPIKE_LENGTHS, _with, growth_sql
from epipanel.session import shared_scratch_path, write_scratch
from epipanel.sources import proxies
from epipanel.sources.files import write_snapshot
from epipanel.sources.uniform import load_observations, load_uniform

Query = Callable[[SparkSession, str], DataFrame]

ENTITY = ["grp", "location"]
K, MAX_KM, MAX_LAG, MIN_DAYS = 4, 6400.0, 7, 7
HALF_WINDOW, Z = 45, 3.0
HIGH_SHARE = 0.5


# ---- names -----------------------------------------------------------------

# Ways in which the stand-in customers write their state: (customer % 9, Spark and DuckDB expression).
_WRITTEN = (
    (0, "n_name"),
    (1, "lower(replace(n_name, '_', '  '))"),
    (2, "replace(n_name, 'I', 'Ï')"),
    (3, "concat(substr(n_name, 1, 2), substr(n_name, 4))"),
    (4, "concat(substr(n_name, 1, 7), 'x')"),
    (5, "concat('Province ', cast(n_nationkey as string))"),
    (6, "replace(n_name, 'TION', 'ITON')"),
    (7, "concat('Elsewhere ', cast(n_nationkey as string))"),
    (8, "cast(null as string)"),
)
_CASES = " ".join(f"WHEN {k} THEN {e}" for k, e in _WRITTEN)


def _written_states(spark, sf) -> DataFrame:
    customer = proxies.read_table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation, region = proxies.read_table(spark, sf, "nation"), proxies.read_table(spark, sf, "region")
    placed = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
    return placed.select("c_custkey", F.col("r_name").alias("country"), F.expr(f"CASE c_custkey % 9 {_CASES} END").alias("state"))


def _state_aliases(spark, sf) -> DataFrame:
    nation, region = proxies.read_table(spark, sf, "nation"), proxies.read_table(spark, sf, "region")
    placed = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return placed.select(F.col("r_name").alias("country"), F.expr("concat('PROVINCE-', cast(n_nationkey as string))").alias("alias"), F.col("n_name").alias("state"))


def _listed(matches: DataFrame) -> DataFrame:
    return matches.withColumn("candidates", F.array_join("candidates", "|"))


def _matched_states(spark, sf) -> DataFrame:
    return match_names(_written_states(spark, sf), proxies.geography(spark, sf), "state", "country", _state_aliases(spark, sf))


def q_match_state_names(spark, sf):
    """States written in nine ways, matched within their country."""
    return _listed(_matched_states(spark, sf))


def q_customers_by_matched_state(spark, sf):
    """Customers per right state; those without one stay, under null."""
    written = _written_states(spark, sf)
    named = rename_matched(written, write_scratch(_matched_states(spark, sf), "matches"), "state", "country")
    return named.groupBy("country", "match").agg(F.count(F.lit(1)).alias("n"))


def q_match_place_names(spark, sf):
    """Countries with a letter missing, then states within the right one."""
    written = _written_states(spark, sf).withColumn("country", F.expr("concat(substr(country, 1, 3), substr(country, 5))"))
    return _listed(match_places(written, proxies.geography(spark, sf), _state_aliases(spark, sf)))


# ---- neighbours ------------------------------------------------------------

LAT = "(location * 7919 % 18001) / 100.0 - 90"
LON = "(location * 104729 % 36000) / 100.0 - 180"


def _with_place(panel: DataFrame) -> DataFrame:
    return panel.select(F.col("location").alias("place"), *[c for c in panel.columns if c not in ("location", "grp")])


def _neighbours(spark, sf) -> DataFrame:
    places = proxies.read_table(spark, sf, "events").select(F.col("user_id").alias("location")).distinct()
    places = places.select("location", *[F.expr(e.replace("100.0", "double(100)")).alias(c) for c, e in (("lat", LAT), ("lon", LON))])
    return nearest_places(places, "location", "lat", "lon", K, first_km=400.0, max_km=MAX_KM)


def q_nearest_places(spark, sf):
    """The four nearest places of each place on the globe."""
    return _neighbours(spark, sf).withColumn("km", F.round("km", 3))


def q_first_against_neighbours(spark, sf):
    """First occurrences against those of the nearest places."""
    first = first_occurrence(proxies.user_panel(spark, sf), "value", "location", date_col="date")
    dated = first.select(F.col("location").alias("place"), F.col("first_value_date").alias("date"))
    out = compare_with_neighbours(dated, write_scratch(_neighbours(spark, sf), "neighbours"))
    return out.withColumn("first_neighbour_km", F.round("first_neighbour_km", 3))


def q_first_spike_against_neighbours(spark, sf):
    """First days at the highest increment against those of the nearest places."""
    high = spike_days(increments(proxies.user_panel(spark, sf), ENTITY), ENTITY)
    out = compare_with_neighbours(_with_place(high), write_scratch(_neighbours(spark, sf), "neighbours"))
    return out.withColumn("first_neighbour_km", F.round("first_neighbour_km", 3))


def q_lagged_correlation(spark, sf):
    """How each place's daily increments follow its neighbours'."""
    steps = _with_place(increments(proxies.user_panel(spark, sf), ENTITY))
    return lagged_correlation(steps, _neighbours(spark, sf), value_col="increment", max_lag=MAX_LAG, min_days=MIN_DAYS)


# ---- holidays and seasons --------------------------------------------------

def q_holiday_spike_rates(spark, sf):
    """Days at half a state's highest count or more, around holidays and outside, per country."""
    obs = proxies.observations(spark, sf)
    peak = F.max("confirmed").over(Window.partitionBy("state"))
    days = obs.select("country", "obs_date", (F.col("confirmed") >= peak * HIGH_SHARE).alias("high"))
    first, last = obs.agg(F.min(F.year("obs_date")), F.max(F.year("obs_date"))).first()
    return holiday_spike_rates(days, holiday_calendar(spark, first, last), "country", "obs_date", before=1, after=7)


def _residuals(spark, sf) -> DataFrame:
    lat = F.expr(f"{LAT.replace('100.0', 'double(100)')}".replace("location", "cast(substr(state, 8) as bigint)"))
    obs = proxies.observations(spark, sf).select("state", "obs_date", "confirmed", lat.alias("lat"))
    return seasonal_residuals(obs, "state", "obs_date", "confirmed", "lat", HALF_WINDOW, Z)


def q_seasonal_residuals(spark, sf):
    """Each state's days as trend, weekday, season and residual."""
    return _residuals(spark, sf)


def q_season_spike_rates(spark, sf):
    """Share of days whose residual is a spike, per state and its season."""
    return season_spike_rates(_residuals(spark, sf), "state")


def q_spike_length_ranks(spark, sf):
    """Runs of high days against the other runs of their group."""
    steps = increments(proxies.gap_panel(spark, sf), ENTITY)
    return compare_spike_lengths(spike_lengths(steps, ENTITY), ENTITY, "grp")


# ---- growth by level and class ---------------------------------------------

def _growth(spark, sf) -> DataFrame:
    return growth_factor(proxies.user_panel(spark, sf), ENTITY)


def q_growth_more_stats(spark, sf):
    """Mean, deviation, skew and quantiles of each group's growth, per date."""
    return growth_statistics(growth_moments(_growth(spark, sf), "grp"))


def q_growth_more_stats_merged(spark, sf):
    """The same per week over all groups, from stored moments of groups and dates."""
    stored = write_scratch(growth_moments(_growth(spark, sf), "grp"), "moments")
    weekly = merge_moments(stored.withColumn("week", F.date_sub("date", F.weekday("date"))), "week")
    return growth_statistics(weekly, ()).drop("skewness")


def q_growth_level_stats(spark, sf):
    """Exact medians of states, countries, continents and the whole in one pass."""
    placed = _growth(spark, sf).withColumn("continent", F.col("grp") % 2).withColumn("state", F.col("location") % 25)
    return growth_level_stats(placed.withColumn("country", F.nullif("grp", F.lit(3))), ["continent", "country", "state"])


def _classes(spark, sf) -> DataFrame:
    places = proxies.read_table(spark, sf, "events").select(F.col("user_id").alias("location")).distinct()
    places = places.select("location", F.expr("nullif(location * 31 % 97, 5)").alias("density"), F.expr("1 + location * 7919 % 10007").alias("population"))
    return population_classes(places, "density", "population")


def q_population_classes(spark, sf):
    """Places in thirds of the population, by density."""
    return _classes(spark, sf)


def q_growth_by_class(spark, sf):
    """Daily growth statistics of rural, mixed and urban places."""
    return growth_by_class(_growth(spark, sf), _classes(spark, sf), "location")


# ---- files of any layout ---------------------------------------------------

def _write_layouts(spark, sf, path: str) -> None:
    """Observations in three layouts, by year, in one folder."""
    obs = proxies.observations(spark, sf)
    part = lambda k: obs.where(F.year("obs_date") % 3 == k)
    text = lambda c: F.format_string("%d.0", c)
    day = F.date_format("obs_date", "MM/dd/yyyy")
    none = F.lit(None).cast("string")
    write_snapshot(
        part(0).select(none.alias("SNo"), day.alias("ObservationDate"), F.col("state").alias("Province/State"), F.col("country").alias("Country/Region"), none.alias("Last Update"),
                       text("confirmed").alias("Confirmed"), text("deaths").alias("Deaths"), text("recovered").alias("Recovered")), f"{path}/original")
    write_snapshot(
        part(1).select(F.col("country").alias("Country_Region"), F.col("recovered").alias("RECOVERED"), F.col("state").alias("Province_State"), F.lit("x").alias("Incident Rate"),
                       F.col("deaths").alias("Deaths"), F.date_format("obs_date", "M/d/yyyy").alias("Date"), F.col("confirmed").alias("Cases")), f"{path}/reordered")
    write_snapshot(
        part(2).select(day.alias("observation date"), F.col("state"), F.col("country"), text("confirmed").alias("confirmed"), F.col("deaths"), F.col("recovered")), f"{path}/plain")


def q_uniform_observations(spark, sf):
    """Observations of three layouts read as one table."""
    path = shared_scratch_path(spark, "layouts")
    _write_layouts(spark, sf, path)
    return load_observations(spark, path)


def q_uniform_wide(spark, sf):
    """Two wide files with other names and other dates, read as one and summed per place."""
    from epipanel.operators.reshape import long_to_wide, wide_to_long

    path = shared_scratch_path(spark, "wide-layouts")
    panel = proxies.user_panel(spark, sf).withColumn("location", F.col("location").cast("string"))
    half = lambda keep: long_to_wide(panel.where(keep), ["grp", "location"])
    write_snapshot(half("day(date) <= 20").withColumnsRenamed({"grp": "Province/State", "location": "Combined_Key"}), f"{path}/a")
    later = half("day(date) >= 15").drop("grp")
    write_snapshot(later.select(*[F.col(f"`{c}`") for c in later.columns[1:]], F.col("location").alias("combined key")), f"{path}/b")
    long = wide_to_long(load_uniform(spark, path), ["place", "state"])
    return long.where("value IS NOT NULL").groupBy("place", "date").agg(F.sum("value").alias("value"), F.count("state").alias("n_states"))


QUERIES: dict[str, Query] = {
    "match_state_names": q_match_state_names,
    "customers_by_matched_state": q_customers_by_matched_state,
    "match_place_names": q_match_place_names,
    "nearest_places": q_nearest_places,
    "first_against_neighbours": q_first_against_neighbours,
    "first_spike_against_neighbours": q_first_spike_against_neighbours,
    "lagged_correlation": q_lagged_correlation,
    "holiday_spike_rates": q_holiday_spike_rates,
    "seasonal_residuals": q_seasonal_residuals,
    "season_spike_rates": q_season_spike_rates,
    "spike_length_ranks": q_spike_length_ranks,
    "growth_more_stats": q_growth_more_stats,
    "growth_more_stats_merged": q_growth_more_stats_merged,
    "growth_level_stats": q_growth_level_stats,
    "population_classes": q_population_classes,
    "growth_by_class": q_growth_by_class,
    "uniform_observations": q_uniform_observations,
    "uniform_wide": q_uniform_wide,
}


# ---- SQL -------------------------------------------------------------------

def _round(x: str, places: int) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), {places}) AS DOUBLE)"


_NORMAL = "trim(regexp_replace(lower(strip_accents({c})), '[^a-z0-9]+', ' ', 'g'))"
_DUCK_CASES = _CASES.replace("as string", "AS VARCHAR")
_ALLOW = "CASE WHEN length({c}) >= 8 THEN 2 WHEN length({c}) >= 4 THEN 1 ELSE 0 END"


def _match_sql(asked: str, right: str, alias: str, name: str) -> str:
    """``name`` (country, name, match, how, edits, candidates): all pairs of names of a country."""
    n = lambda c: _NORMAL.format(c=c)
    return f"""
{name}_asked AS (SELECT DISTINCT country, name FROM {asked}),
{name}_pairs AS (
  SELECT a.country, a.name, r.name AS candidate,
         CASE WHEN a.name = r.name THEN 0 WHEN {n('a.name')} = {n('r.name')} THEN 1 ELSE 3 END AS grade,
         levenshtein({n('a.name')}, {n('r.name')}) AS edits,
         least({_ALLOW.format(c=n('a.name'))}, {_ALLOW.format(c=n('r.name'))}) AS allowed
  FROM {name}_asked a JOIN (SELECT DISTINCT country, name FROM {right}) r ON a.country IS NOT DISTINCT FROM r.country
),
{name}_graded AS (
  SELECT country, name, candidate, grade, edits FROM {name}_pairs WHERE edits <= allowed OR grade < 3
  UNION SELECT a.country, a.name, l.name, 2, 0 FROM {name}_asked a JOIN {alias} l ON a.country IS NOT DISTINCT FROM l.country AND {n('a.name')} = {n('l.alias')}
),
{name}_best AS (
  SELECT country, name, candidate, grade, edits, rank() OVER (PARTITION BY country, name ORDER BY grade, edits) AS place FROM {name}_graded
),
{name}_sets AS (
  SELECT country, name, list(candidate ORDER BY candidate) AS cs, min(grade) AS grade, min(edits) AS edits FROM {name}_best WHERE place = 1 GROUP BY country, name
),
{name} AS (
  SELECT a.country, a.name, CASE WHEN len(cs) = 1 THEN cs[1] END AS match,
         CASE WHEN cs IS NULL THEN 'none' WHEN len(cs) > 1 THEN 'ambiguous'
              ELSE ['exact', 'normal', 'alias', 'similar'][grade + 1] END AS how,
         CAST(s.edits AS INTEGER) AS edits, coalesce(array_to_string(cs, '|'), '') AS candidates
  FROM {name}_asked a LEFT JOIN {name}_sets s ON a.country IS NOT DISTINCT FROM s.country AND a.name IS NOT DISTINCT FROM s.name
)"""


_WRITTEN_SQL = f"""
written AS (
  SELECT r_name AS country, CASE c_custkey % 9 {_DUCK_CASES} END AS name
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
),
rightnames AS (SELECT r_name AS country, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey),
aliasnames AS (SELECT r_name AS country, 'PROVINCE-' || n_nationkey AS alias, n_name AS name FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_PLACE_NAMES = _with(
    _WRITTEN_SQL,
    """
cut AS (SELECT substr(country, 1, 3) || substr(country, 5) AS country, name FROM written),
countrynames AS (SELECT DISTINCT NULL::VARCHAR AS country, country AS name FROM cut),
rightcountries AS (SELECT DISTINCT NULL::VARCHAR AS country, country AS name FROM rightnames),
noalias AS (SELECT NULL::VARCHAR AS country, NULL::VARCHAR AS alias, NULL::VARCHAR AS name WHERE false)""",
    _match_sql("countrynames", "rightcountries", "noalias", "cm"),
    "placed AS (SELECT DISTINCT cut.country, cut.name, cm.match, cm.how FROM cut JOIN cm ON cut.country = cm.name)",
    "asked AS (SELECT match AS country, name FROM placed WHERE match IS NOT NULL)",
    _match_sql("asked", "rightnames", "aliasnames", "sm"),
) + """
SELECT p.country, p.name AS state, p.match AS country_match, p.how AS country_how, sm.match AS state_match,
       coalesce(sm.how, 'none') AS state_how, sm.edits, coalesce(sm.candidates, '') AS candidates
FROM placed p LEFT JOIN sm ON p.match = sm.country AND p.name IS NOT DISTINCT FROM sm.name"""

_NEAR = f"""
spots AS (SELECT DISTINCT location AS place, ({LAT})::DOUBLE AS lat, ({LON})::DOUBLE AS lon FROM panel),
apart AS (
  SELECT a.place, b.place AS neighbour, power(sin(radians(b.lat - a.lat) / 2), 2) + cos(radians(a.lat)) * cos(radians(b.lat)) * power(sin(radians(b.lon - a.lon) / 2), 2) AS h
  FROM spots a JOIN spots b ON a.place <> b.place
),
far AS (SELECT place, neighbour, {_round('2 * 6371.0::DOUBLE * asin(sqrt(least(h, 1.0::DOUBLE)))', 7)} AS km FROM apart),
near AS (
  SELECT place, neighbour, CAST(row_number() OVER (PARTITION BY place ORDER BY km, neighbour) AS INTEGER) AS rank, km FROM far WHERE km <= {MAX_KM}
  QUALIFY rank <= {K}
)"""
_STEPS = """
steps AS (
  SELECT location AS place, date, value - COALESCE(lag(value) OVER (PARTITION BY grp, location ORDER BY date), 0) AS increment FROM panel
)"""


def _against(dated: str) -> str:
    return f"""
dated AS ({dated}),
told AS (
  SELECT n.place, n.neighbour, n.rank, n.km, d.date FROM near n LEFT JOIN dated d ON d.place = n.neighbour
),
firsts AS (
  SELECT place, neighbour, km, date FROM told WHERE date IS NOT NULL QUALIFY row_number() OVER (PARTITION BY place ORDER BY date, rank) = 1
),
everyone AS (SELECT place FROM near UNION SELECT place FROM dated)
SELECT e.place, d.date, (SELECT count(*) FROM told t WHERE t.place = e.place) AS n_neighbours,
       (SELECT count(date) FROM told t WHERE t.place = e.place) AS n_dated,
       (SELECT count(*) FROM told t WHERE t.place = e.place AND t.date < d.date) AS n_earlier,
       f.neighbour AS first_neighbour, f.date AS first_neighbour_date, {_round('f.km', 3)} AS first_neighbour_km,
       CAST(d.date - f.date AS INTEGER) AS days_after
FROM everyone e LEFT JOIN dated d USING (place) LEFT JOIN firsts f USING (place)"""


# Published dates of Easter Sunday, western and orthodox, in the years of the stand-in observations.
_EASTERS = """
easters(western, orthodox) AS (VALUES
  (DATE '1995-04-16', DATE '1995-04-23'), (DATE '1996-04-07', DATE '1996-04-14'), (DATE '1997-03-30', DATE '1997-04-27'),
  (DATE '1998-04-12', DATE '1998-04-19'), (DATE '1999-04-04', DATE '1999-04-11'), (DATE '2000-04-23', DATE '2000-04-30'),
  (DATE '2001-04-15', DATE '2001-04-15')
)"""
_CALENDAR = _EASTERS + """,
years AS (SELECT DISTINCT year(obs_date) AS y FROM obs),
somedays AS (SELECT CAST(make_date(y, 1, 1) + i::INTEGER AS DATE) AS date FROM years, range(366) r(i) WHERE year(CAST(make_date(y, 1, 1) + i::INTEGER AS DATE)) = y),
lunars AS (
  SELECT CAST(DATE '1970-01-01' + CAST((11 * h + 3) // 30 + 354 * h + 30 * m - (m - 1) // 2 + d + 1948440 - 386 - 2440587 AS INTEGER) AS DATE) AS date, name AS holiday
  FROM range(1410, 1430) r(h), (VALUES (10, 1, 'eid_al_fitr'), (12, 10, 'eid_al_adha')) f(m, d, name)
),
feasts AS (
  SELECT date, CASE strftime(date, '%m-%d') WHEN '01-01' THEN 'new_year' WHEN '02-14' THEN 'valentine' WHEN '03-17' THEN 'st_patrick' WHEN '07-04' THEN 'independence_day'
                    WHEN '10-31' THEN 'halloween' WHEN '12-25' THEN 'christmas' WHEN '12-31' THEN 'new_years_eve' END AS holiday FROM somedays
  UNION ALL SELECT date, 'memorial_day' FROM somedays WHERE month(date) = 5 AND dayofweek(date) = 1 AND day(date) > 24
  UNION ALL SELECT date, 'labor_day' FROM somedays WHERE month(date) = 9 AND dayofweek(date) = 1 AND day(date) <= 7
  UNION ALL SELECT date, 'thanksgiving' FROM somedays WHERE month(date) = 11 AND dayofweek(date) = 4 AND day(date) BETWEEN 22 AND 28
  UNION ALL SELECT CAST(western - 2 AS DATE), 'good_friday' FROM easters
  UNION ALL SELECT western, 'easter' FROM easters
  UNION ALL SELECT CAST(western + 49 AS DATE), 'pentecost' FROM easters
  UNION ALL SELECT orthodox, 'orthodox_easter' FROM easters
  UNION ALL SELECT date, holiday FROM lunars WHERE year(date) IN (SELECT y FROM years)
)"""

_RESIDUALS = f"""
lit AS (
  SELECT state, obs_date AS date, confirmed AS value, month(obs_date) % 12 // 3 AS quarter,
         ((CAST(substr(state, 8) AS BIGINT) * 7919 % 18001) / 100.0 - 90) < 0 AS south
  FROM obs
),
seasoned AS (
  SELECT state, date, value, ['winter', 'spring', 'summer', 'autumn'][(quarter + CASE WHEN south THEN 2 ELSE 0 END) % 4 + 1] AS season FROM lit
),
trended AS (
  SELECT *, CAST(SUM(value * 1000000) OVER w // COUNT(*) OVER w AS BIGINT) AS t FROM seasoned
  WINDOW w AS (PARTITION BY state ORDER BY date RANGE BETWEEN INTERVAL {HALF_WINDOW} DAYS PRECEDING AND INTERVAL {HALF_WINDOW} DAYS FOLLOWING)
),
weekdays AS (SELECT *, CAST(SUM(value * 1000000 - t) OVER w // COUNT(*) OVER w AS BIGINT) AS wp FROM trended WINDOW w AS (PARTITION BY state, dayofweek(date))),
parts AS (SELECT *, CAST(SUM(value * 1000000 - t - wp) OVER w // COUNT(*) OVER w AS BIGINT) AS sp FROM weekdays WINDOW w AS (PARTITION BY state, season)),
rests AS (SELECT *, value * 1000000 - t - wp - sp AS r FROM parts),
spread AS (SELECT *, sqrt(CAST(SUM(r::HUGEINT * r) OVER (PARTITION BY state) AS DOUBLE) / COUNT(*) OVER (PARTITION BY state)) / 1e6 AS sd FROM rests),
residuals AS (
  SELECT state, date, season, value, t / 1e6 AS trend, wp / 1e6 AS weekday_part, sp / 1e6 AS season_part, r / 1e6 AS residual,
         sd AS spread, r > 0 AND r / 1e6 >= {Z} * sd AS spike FROM spread
)"""

_CLASSES = """
people AS (
  SELECT DISTINCT location, nullif(location * 31 % 97, 5) AS density, 1 + location * 7919 % 10007 AS population FROM panel
),
below AS (
  SELECT p.*, (SELECT coalesce(sum(q.population), 0) FROM people q WHERE q.density < p.density) AS under,
         (SELECT sum(q.population) FROM people q WHERE q.density IS NOT NULL) AS total
  FROM people p
),
classes AS (
  SELECT location, density, population,
         CASE WHEN density IS NULL THEN NULL WHEN under >= 2.0 / 3 * total THEN 'urban' WHEN under >= 1.0 / 3 * total THEN 'mixed' ELSE 'rural' END AS class
  FROM below
)"""


def _stats(src: str, keys: str) -> str:
    """Growth statistics by ``keys``, of growth rows that have them."""
    return f"""
SELECT {keys}, CAST(quantile_disc(delta, 0.5) AS DOUBLE) AS median_delta,
       CAST(sign(SUM(delta)) * ((2 * abs(CAST(SUM(delta) * 100 AS BIGINT)) * 10000 + COUNT(*)) // (2 * COUNT(*))) AS DOUBLE) / 1e6 AS avg_delta,
       CAST(max(delta) AS DOUBLE) AS max_delta, CAST(min(delta) AS DOUBLE) AS min_delta, COUNT(*) AS n_entities
FROM {src} GROUP BY ALL"""


def _level(*known: str) -> str:
    cols = ", ".join(c if c in known else f"CAST(NULL AS BIGINT) AS {c}" for c in ("continent", "country", "state"))
    return _stats("placed", f"'{known[-1] if known else 'all'}' AS level, {cols}, date")


_MEAN = "CAST(SUM(delta) * 100 AS DOUBLE) / COUNT(*) / 100"
_E = "CAST(delta * 100 AS HUGEINT)"
_SPREAD = f"CAST(COUNT(*) * SUM({_E} * {_E}) - SUM({_E}) * SUM({_E}) AS DOUBLE)"
_N = "CAST(COUNT(*) AS DOUBLE)"
_VARIANCE = f"({_SPREAD} / ({_N} * {_N}))"
_S1, _S2, _S3 = f"CAST(SUM({_E}) AS DOUBLE)", f"CAST(SUM({_E} * {_E}) AS DOUBLE)", f"CAST(SUM({_E} * {_E} * {_E}) AS DOUBLE)"
_THIRD = f"({_S3} / {_N} - 3.0::DOUBLE * ({_S1} / {_N}) * ({_S2} / {_N}) + 2.0::DOUBLE * power({_S1} / {_N}, 3))"

ORACLE: dict[str, str] = {
    "match_state_names": _with(_WRITTEN_SQL, _match_sql("written", "rightnames", "aliasnames", "m")) + "SELECT * FROM m",
    "customers_by_matched_state": _with(_WRITTEN_SQL, _match_sql("written", "rightnames", "aliasnames", "m"))
    + "SELECT w.country, m.match, count(*) AS n FROM written w JOIN m ON w.country = m.country AND w.name IS NOT DISTINCT FROM m.name GROUP BY ALL",
    "match_place_names": _PLACE_NAMES,
    "nearest_places": _with(PANEL, _NEAR) + f"SELECT place, neighbour, rank, {_round('km', 3)} AS km FROM near",
    "first_against_neighbours": _with(PANEL, _NEAR, _against("SELECT location AS place, min(date) AS date FROM panel WHERE value > 0 GROUP BY location").lstrip()),
    "first_spike_against_neighbours": _with(
        PANEL, _NEAR, _STEPS,
        _against(
            "SELECT place, min(date) AS date FROM (SELECT *, max(increment) OVER (PARTITION BY place) AS peak FROM steps) t WHERE peak > 0 AND increment >= peak GROUP BY place"
        ).lstrip(),
    ),
    "lagged_correlation": _with(
        PANEL, _NEAR, _STEPS,
        f"""
sums AS (
  SELECT n.place, n.neighbour, l.lag, COUNT(*)::DOUBLE AS n, SUM(a.increment)::DOUBLE AS sx, SUM(b.increment)::DOUBLE AS sy,
         SUM(a.increment * a.increment)::DOUBLE AS sxx, SUM(b.increment * b.increment)::DOUBLE AS syy, SUM(a.increment * b.increment)::DOUBLE AS sxy
  FROM near n, range(-{MAX_LAG}, {MAX_LAG} + 1) l(lag)
  JOIN steps a ON a.place = n.place JOIN steps b ON b.place = n.neighbour AND b.date = a.date - CAST(l.lag AS INTEGER)
  GROUP BY ALL
),
scored AS (
  SELECT place, neighbour, lag, CAST(n AS BIGINT) AS n_days, {_round('(n * sxy - sx * sy) / sqrt((n * sxx - sx * sx) * (n * syy - sy * sy))', 6)} AS strength
  FROM sums WHERE n >= {MIN_DAYS} AND (n * sxx - sx * sx) * (n * syy - sy * sy) > 0
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY place, neighbour ORDER BY strength DESC, abs(lag), lag) = 1)""",
    )
    + "SELECT n.place, n.neighbour, CAST(b.lag AS INTEGER) AS best_lag, b.strength, b.n_days FROM near n LEFT JOIN best b USING (place, neighbour)",
    "holiday_spike_rates": _with(
        OBS, _CALENDAR,
        f"""
flagged AS (SELECT country, obs_date AS date, confirmed >= {HIGH_SHARE} * max(confirmed) OVER (PARTITION BY state) AS high FROM obs),
inside AS (
  SELECT country, holiday, COUNT(*) AS n, COUNT(*) FILTER (WHERE high) AS nh
  FROM flagged f JOIN (SELECT DISTINCT CAST(date + i::INTEGER AS DATE) AS date, holiday FROM feasts, range(-1, 8) r(i) WHERE holiday IS NOT NULL) w USING (date) GROUP BY country, holiday
),
outside AS (
  SELECT country, COUNT(*) AS n, COUNT(*) FILTER (WHERE high) AS nh FROM flagged f
  WHERE NOT EXISTS (SELECT 1 FROM feasts t WHERE t.holiday IS NOT NULL AND f.date BETWEEN t.date - 1 AND t.date + 7) GROUP BY country
)""",
    )
    + f"""
SELECT i.country, holiday, i.n AS n_days_in, i.nh AS n_high_in, {_round('i.nh::DOUBLE / i.n::DOUBLE', 6)} AS rate_in,
       coalesce(o.n, 0) AS n_days_out, coalesce(o.nh, 0) AS n_high_out, {_round('o.nh::DOUBLE / o.n::DOUBLE', 6)} AS rate_out,
       {_round('(i.nh::DOUBLE / i.n::DOUBLE) / nullif(o.nh::DOUBLE / o.n::DOUBLE, 0)', 6)} AS lift
FROM inside i LEFT JOIN outside o ON i.country = o.country""",
    "seasonal_residuals": _with(OBS, _RESIDUALS) + f"SELECT * REPLACE ({_round('spread', 6)} AS spread) FROM residuals",
    "season_spike_rates": _with(OBS, _RESIDUALS)
    + f"SELECT state, season, COUNT(*) AS n_days, COUNT(*) FILTER (WHERE spike) AS n_spikes, {_round('COUNT(*) FILTER (WHERE spike)::DOUBLE / COUNT(*)', 6)} AS rate FROM residuals GROUP BY state, season",
    "spike_length_ranks": _with(PANEL, GAP_PANEL, GAP_STEPS, GAP_HIGH)
    + f"""SELECT *, percent_rank() OVER (PARTITION BY grp ORDER BY days) AS pct_rank, COUNT(*) OVER (PARTITION BY grp) AS n_ranked,
       max(days) OVER (PARTITION BY grp, location) AS entity_longest FROM ({SPIKE_LENGTHS}) t""",
    "growth_more_stats": _with(PANEL, growth_sql("panel"))
    + f"""
SELECT grp, date, COUNT(*) AS n, {_round(_MEAN, 6)} AS mean, {_round(f'sqrt({_VARIANCE}) / 100', 6)} AS deviation,
       CASE WHEN {_VARIANCE} > 0 THEN {_round(f'{_THIRD} / ({_VARIANCE} * sqrt({_VARIANCE}))', 4)} END AS skewness,
       CAST(min(delta) AS DOUBLE) AS least, CAST(max(delta) AS DOUBLE) AS most,
       {', '.join(f'CAST(quantile_disc(delta, {q}) AS DOUBLE) AS q{round(q * 100)}' for q in (0.1, 0.25, 0.5, 0.75, 0.9))}
FROM growth GROUP BY grp, date""",
    "growth_more_stats_merged": _with(PANEL, growth_sql("panel"))
    + f"""
SELECT CAST(date_trunc('week', date) AS DATE) AS week, CAST(COUNT(*) AS BIGINT) AS n, {_round(_MEAN, 6)} AS mean, {_round(f'sqrt({_VARIANCE}) / 100', 6)} AS deviation,
       CAST(min(delta) AS DOUBLE) AS least, CAST(max(delta) AS DOUBLE) AS most
FROM growth GROUP BY 1""",
    "growth_level_stats": _with(PANEL, growth_sql("panel"), "placed AS (SELECT grp % 2 AS continent, nullif(grp, 3) AS country, location % 25 AS state, date, delta FROM growth)")
    + " UNION ALL ".join([_level(), _level("continent"), _level("continent", "country"), _level("continent", "country", "state")]),
    "population_classes": _with(PANEL, _CLASSES) + "SELECT * FROM classes",
    "growth_by_class": _with(PANEL, growth_sql("panel"), _CLASSES, "placed AS (SELECT class, date, delta FROM growth JOIN classes USING (location))")
    + _stats("placed", "class, date"),
    "uniform_observations": _with(OBS) + "SELECT obs_date, state, country, confirmed, deaths, recovered FROM obs",
    "uniform_wide": _with(PANEL)
    + """
SELECT CAST(location AS VARCHAR) AS place, date, CAST(SUM(value * CASE WHEN day(date) BETWEEN 15 AND 20 THEN 2 ELSE 1 END) AS BIGINT) AS value,
       COUNT(*) FILTER (WHERE day(date) <= 20) AS n_states
FROM panel GROUP BY location, date""",
}
