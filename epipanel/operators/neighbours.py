"""Places against their neighbours on the globe.

The k nearest places are found on a grid of latitude bands, each cut into
cells about as wide as high, that wraps over the date line and closes at the poles. A
place looks into the cells that its circle touches. Circles start small: places
that find k neighbours are done, the others go on with a circle ``WIDEN`` times
as large. A place still looking has fewer than k places within the circle before, so few places of a
cell are still looking, and the pairs met grow with k times the number of
places and not with the square of a crowded cell.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.functions.columns import as_list
from epipanel.session import write_scratch

EARTH_KM = 6371.0
WIDEN = 4
CROWD = 512  # places of a cell beyond which the first circle is made smaller
LEAST_KM = 0.01


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance of two points in degrees."""
    half = lambda a, b: F.pow(F.sin(F.radians(b - a) / 2), 2)
    h = half(lat1, lat2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half(lon1, lon2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


class _Grid:
    """Bands ``km`` high; the cells of a band are at least ``km`` wide where it is widest."""

    def __init__(self, km: float):
        self.angle = km / EARTH_KM  # radians
        self.height = max(math.degrees(self.angle), 1e-9)
        self.bands = max(1, math.ceil(180.0 / self.height))

    def band(self, lat: Column) -> Column:
        return F.least(F.floor((lat + 90.0) / self.height), F.lit(self.bands - 1)).cast("bigint")

    def cells(self, band: Column) -> Column:
        """Number of cells of a band: its longest parallel over the height, at least one."""
        south = band * F.lit(self.height) - 90.0
        nearest = F.when((south <= 0) & (south + self.height >= 0), 0.0).otherwise(F.least(F.abs(south), F.abs(south + self.height)))
        return F.greatest(F.lit(1), F.floor(F.cos(F.radians(nearest)) * 360.0 / self.height)).cast("bigint")

    def cell(self, lon: Column, band: Column) -> Column:
        n = self.cells(band)
        return F.pmod(F.floor((lon + 180.0) / 360.0 * n), n).cast("bigint")

    def touched(self, df: DataFrame, lat: str, lon: str) -> DataFrame:
        """A row per cell that the circle of ``km`` around the row's point may touch, as ``_band, _cell``."""
        lat_, lon_ = F.col(lat), F.col(lon)
        bands = F.sequence(F.greatest(self.band(lat_) - 1, F.lit(0)), F.least(self.band(lat_) + 1, F.lit(self.bands - 1)))
        rows = df.select("*", F.explode(bands).alias("_band"))
        polar = F.abs(F.radians(lat_)) + self.angle >= math.pi / 2 - 1e-9
        # half the circle's width in degrees, a hair wider against rounding
        reach = F.degrees(F.asin(F.least(F.lit(1.0), F.sin(F.lit(min(self.angle, math.pi / 2))) / F.cos(F.radians(lat_))))) * 1.000001 + 1e-9
        n = self.cells(F.col("_band"))
        first, last = (F.floor((lon_ + sign * reach + 180.0) / 360.0 * n).cast("bigint") for sign in (-1, 1))
        whole = polar | (last - first + 1 >= n)
        cells = F.when(whole, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.sequence(F.least(first, last), last))
        rows = rows.select("*", F.explode(cells).alias("_cell"))
        return rows.withColumn("_cell", F.pmod("_cell", self.cells(F.col("_band"))).cast("bigint")).distinct()


def nearest_places(
    places: DataFrame, place_col: str, lat_col: str, lon_col: str, k: int = 4, first_km: float = 50.0, max_km: float = 6400.0
) -> DataFrame:
    """The k nearest other places of each place, within ``max_km``: ``place,
    neighbour, rank, km``. Exact; ties go to the smaller neighbour.

    * places without coordinates, or outside of the globe's, have no neighbours and are none;
    * a longitude is taken modulo 360; a place's repeated rows count once (its smallest coordinates);
    * places at the very same spot are one site: only sites are compared, and of a site
      the first ``k + 1`` places can be anyone's neighbours;
    * distances are compared to a tenth of a millimetre, so that places equally far away tie; an empty table gives no rows.

    Sites and each circle's results are written to the shared checkpoint folder.
    """
    lat, lon = F.col(lat_col).cast("double"), F.col(lon_col).cast("double")
    rows = places.where(F.col(place_col).isNotNull() & lat.between(-90, 90) & lon.isNotNull() & (F.abs(lon) <= 1e6))
    # every spelling of one point: longitudes in [-180, 180), one at the poles, no negative zero
    lon = F.when(F.abs(lat) == 90, 0.0).otherwise(F.pmod(lon + 180.0, F.lit(360.0)) - 180.0)
    spots = rows.groupBy(F.col(place_col).alias("place")).agg(F.min(F.struct((lat + 0.0).alias("lat"), (lon + 0.0).alias("lon"))).alias("at"))
    spots = write_scratch(spots.select("place", "at.lat", "at.lon"), "places")
    in_site = F.row_number().over(Window.partitionBy("lat", "lon").orderBy("place"))
    members = write_scratch(spots.withColumn("_no", in_site).where(F.col("_no") <= k + 1).drop("_no"), "members")
    sites = write_scratch(spots.groupBy("lat", "lon").agg(F.min("place").alias("site")), "sites")

    km = first_km
    while km > LEAST_KM:
        grid = _Grid(km)
        band = grid.band(F.col("lat"))
        crowded = sites.groupBy(band.alias("b"), grid.cell(F.col("lon"), band).alias("c")).count().where(F.col("count") > CROWD)
        if not crowded.limit(1).count():
            break
        km /= WIDEN
    near = []
    looking = sites
    while True:
        km = min(km, max_km)
        found = write_scratch(_within(looking, sites, km, k), "circle")
        if km >= max_km:
            near.append(found)
            break
        done = found.where(F.col("_rank") == k).select("site")
        near.append(found.join(done, "site", "left_semi"))
        looking = write_scratch(looking.join(done, "site", "left_anti"), "looking")
        if not looking.limit(1).count():
            break
        km *= WIDEN
    pairs = near[0]
    for part in near[1:]:
        pairs = pairs.unionAll(part)
    # a place's own site is a neighbour at distance 0
    pairs = pairs.select("site", "other", "km").unionAll(sites.select("site", F.col("site").alias("other"), F.lit(0.0).alias("km")))
    of_site = members.join(sites, ["lat", "lon"]).select(F.col("site").alias("other"), F.col("place").alias("neighbour"))
    of_place = spots.join(sites, ["lat", "lon"]).select("place", "site")
    offered = write_scratch(pairs.join(of_site, "other").select("site", "neighbour", "km"), "offered")
    all_ = of_place.join(offered, "site").where("place <> neighbour")
    rank = F.row_number().over(Window.partitionBy("place").orderBy("km", "neighbour"))
    return all_.select("place", "neighbour", rank.cast("int").alias("rank"), "km").where(F.col("rank") <= k)


def _within(looking: DataFrame, sites: DataFrame, km: float, k: int) -> DataFrame:
    """Up to k nearest other sites within ``km`` of each site of ``looking``."""
    grid = _Grid(km)
    band = grid.band(F.col("_lat"))
    targets = sites.toDF("_lat", "_lon", "other")
    targets = targets.select("*", band.alias("_band")).select("*", grid.cell(F.col("_lon"), F.col("_band")).alias("_cell"))
    pairs = grid.touched(looking, "lat", "lon").join(targets, ["_band", "_cell"]).where("site <> other")
    far = F.round(haversine_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")), 7)
    pairs = pairs.select("site", "other", far.alias("km")).where(F.col("km") <= km)
    rank = F.row_number().over(Window.partitionBy("site").orderBy("km", "other"))
    return pairs.withColumn("_rank", rank).where(F.col("_rank") <= k)


def compare_with_neighbours(
    events: DataFrame, neighbours: DataFrame, place_col: str = "place", date_col: str = "date"
) -> DataFrame:
    """Each place's date against its neighbours' dates (first occurrences,
    first spikes): ``place, date, n_neighbours, n_dated, n_earlier, first_neighbour, first_neighbour_date,
    first_neighbour_km, days_after``.

    ``events`` has one date a place (of repeated places the earliest counts),
    ``neighbours`` is what :func:`nearest_places` gives. ``days_after`` is how long after its first neighbour a place
    follows (negative: the place was first). Of neighbours with one date the nearest is named. Places without a
    date, or without a dated neighbour, keep null; every place with a date or a neighbour is listed.
    """
    dated = events.groupBy(F.col(place_col).alias("place")).agg(F.min(date_col).alias("date")).where("place IS NOT NULL")
    dated = write_scratch(dated, "dated")
    theirs = dated.select(F.col("place").alias("neighbour"), F.col("date").alias("_theirs"))
    mine = dated.select(F.col("place").alias("_place"), "date")
    near = neighbours.select("place", "neighbour", "rank", "km").join(theirs, "neighbour", "left")
    listed = near.join(mine, F.col("place") == F.col("_place"), "full")
    listed = listed.withColumn("place", F.coalesce("place", "_place"))
    earliest = F.min(F.when(F.col("_theirs").isNotNull(), F.struct(F.col("_theirs").alias("date"), "rank", "neighbour", "km")))
    out = listed.groupBy("place").agg(
        F.max("date").alias("date"),
        F.count("neighbour").alias("n_neighbours"),
        F.count("_theirs").alias("n_dated"),
        F.count_if(F.col("_theirs") < F.col("date")).alias("n_earlier"),
        earliest.alias("_first"),
    )
    return out.select(
        "place", "date", "n_neighbours", "n_dated", "n_earlier", F.col("_first.neighbour").alias("first_neighbour"),
        F.col("_first.date").alias("first_neighbour_date"), F.col("_first.km").alias("first_neighbour_km"),
        F.datediff("date", F.col("_first.date")).alias("days_after"),
    )


def daily_series(panel: DataFrame, entity_cols: str | Sequence[str], date_col: str = "date", value_col: str = "value") -> DataFrame:
    """One row per entity: ``entity..., first_day, values``, the values of all
    days from its first to its last, null where a day has none. Bounded by
    the calendar. Rows without a date are left out; of a repeated date the largest value counts."""
    keys = as_list(entity_cols)
    one = panel.where(F.col(date_col).isNotNull()).groupBy(*keys, F.col(date_col).alias("_d")).agg(F.max(value_col).alias("_v"))
    kept = one.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(F.unix_date("_d").alias("d"), F.col("_v").alias("v")))).alias("_s"))
    nexts = F.slice(F.concat(F.transform(F.slice("_s", 2, 1 << 30), lambda x: x["d"]), F.array(F.element_at("_s", -1)["d"] + 1)), 1, F.size("_s"))
    # every value stands for its own day, then nulls up to the next
    empty = F.lit(None).cast(panel.schema[value_col].dataType)
    runs = F.zip_with("_s", nexts, lambda x, until: F.concat(F.array(x["v"]), F.array_repeat(empty, until - x["d"] - 1)))
    return kept.select(*keys, F.date_from_unix_date(F.get("_s", F.lit(0))["d"]).alias("first_day"), F.flatten(runs).alias("values"))


def lagged_correlation(
    panel: DataFrame, neighbours: DataFrame, place_col: str = "place", date_col: str = "date", value_col: str = "value",
    max_lag: int = 14, min_days: int = 7,
) -> DataFrame:
    """How a place's series follows each neighbour's: ``place, neighbour,
    best_lag, strength, n_days``.

    ``strength`` is the largest Pearson correlation, over lags of up to ``max_lag``
    days either way, of the neighbour's value ``lag`` days before with the place's value: a
    positive ``best_lag`` means the place follows its neighbour. Ties go to the shorter lag, then to the
    earlier. Days on which either has no value are skipped; lags with fewer than
    ``min_days`` days or without variation do not count (null ``best_lag`` if none does).

    Whole-number series give the same to the last place however rows are dealt
    out. Each series is gathered once (bounded by the calendar); pairs are joined
    with two of them, and all lags of a pair are one row's arithmetic.
    """
    series = write_scratch(
        daily_series(panel.where(F.col(place_col).isNotNull()).select(F.col(place_col).alias("place"), F.col(date_col).alias("date"), F.col(value_col).cast("double").alias("value")), "place"),
        "series",
    )
    mine = series.select("place", F.unix_date("first_day").alias("_a0"), F.col("values").alias("_a"))
    theirs = series.select(F.col("place").alias("neighbour"), F.unix_date("first_day").alias("_b0"), F.col("values").alias("_b"))
    pairs = neighbours.select("place", "neighbour").join(mine, "place", "left").join(theirs, "neighbour", "left")
    lags = pairs.select("*", F.explode(F.sequence(F.lit(-max_lag), F.lit(max_lag))).alias("lag"))
    # the days on which both have a cell: the place's day d, the neighbour's day d - lag
    start = F.greatest(F.col("_a0"), F.col("_b0") + F.col("lag"))
    size = F.least(F.col("_a0") + F.size("_a"), F.col("_b0") + F.col("lag") + F.size("_b")) - start
    cut = lags.select("place", "neighbour", "lag", "_a", "_b", F.greatest(size, F.lit(0)).alias("_n"), (start - F.col("_a0")).alias("_ai"), (start - F.col("_b0") - F.col("lag")).alias("_bi"))
    both = F.filter(F.arrays_zip(F.slice("_a", F.greatest(F.col("_ai"), F.lit(0)) + 1, F.col("_n")).alias("x"), F.slice("_b", F.greatest(F.col("_bi"), F.lit(0)) + 1, F.col("_n")).alias("y")), lambda p: p["x"].isNotNull() & p["y"].isNotNull())
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])
    add = lambda s, p: F.struct(
        (s["n"] + 1.0).alias("n"), (s["x"] + p["x"]).alias("x"), (s["y"] + p["y"]).alias("y"),
        (s["xx"] + p["x"] * p["x"]).alias("xx"), (s["yy"] + p["y"] * p["y"]).alias("yy"), (s["xy"] + p["x"] * p["y"]).alias("xy"),
    )
    summed = cut.select("place", "neighbour", "lag", F.aggregate(both, zero, add).alias("s"))
    s = lambda c: F.col(f"s.{c}")
    spread = (s("n") * s("xx") - s("x") * s("x")) * (s("n") * s("yy") - s("y") * s("y"))
    strength = F.round((s("n") * s("xy") - s("x") * s("y")) / F.sqrt(spread), 6)
    scored = summed.select("place", "neighbour", "lag", s("n").cast("bigint").alias("n_days"), F.when((s("n") >= min_days) & (spread > 0), strength).alias("strength"))
    best = F.min(F.when(F.col("strength").isNotNull(), F.struct((-F.col("strength")).alias("k"), F.abs("lag").alias("far"), "lag", "n_days")))
    return scored.groupBy("place", "neighbour").agg(best.alias("b")).select(
        "place", "neighbour", F.col("b.lag").alias("best_lag"), (F.lit(0.0) - F.col("b.k")).alias("strength"), F.col("b.n_days").alias("n_days")
    )


__all__ = ["compare_with_neighbours", "daily_series", "haversine_km", "lagged_correlation", "nearest_places"]
