"""High days around holidays: a calendar with movable feasts, and an interval join.

The calendar is computed by Spark from the years alone. Days are reduced to one
row per group and date before they meet the holidays' windows, so what is joined
is bounded by the calendar; the interval join itself goes by buckets of days and
works for any number of rows and intervals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.functions.columns import as_list
from epipanel.plans.joins import null_safe

# Fixed values: (holiday, month, day).
FIXED = (
    ("new_year", 1, 1), ("valentine", 2, 14), ("st_patrick", 3, 17), ("independence_day", 7, 4),
    ("halloween", 10, 31), ("christmas", 12, 25), ("new_years_eve", 12, 31),
)
# Fixed values: (holiday, month, day of the week from Sunday = 1, which; -1: the last).
WEEKDAYS = (
    ("memorial_day", 5, 2, -1), ("labor_day", 9, 2, 1), ("thanksgiving", 11, 5, 4),
)
# Fixed values: (holiday, days after Easter Sunday).
EASTER = (("good_friday", -2), ("easter", 0), ("pentecost", 49))
# Fixed values: (holiday, month, day) of the arithmetic lunar calendar of 30 years.
LUNAR = (("eid_al_fitr", 10, 1), ("eid_al_adha", 12, 10))


def _staged(df: DataFrame, **steps: str) -> DataFrame:
    for name, sql in steps.items():
        df = df.withColumn(name, F.expr(sql))
    return df


def holiday_calendar(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """``holiday, date`` of every holiday of the years (Gregorian, 1900 to 2199).

    Easter by the Gregorian and the Julian computus (``orthodox_easter``, given as a Gregorian date); weekday
    rules; lunar feasts by the arithmetic calendar, which may differ by a day
    from an observed moon and may fall twice, or not at all, in a year. No years: no rows.
    """
    years = spark.range(first_year, last_year + 1).select(F.col("id").cast("int").alias("y"))
    day = lambda month, d: F.make_date("y", F.lit(month), F.lit(d))
    fixed = years.select(F.inline(F.array(*[F.struct(F.lit(h).alias("holiday"), day(m, d).alias("date")) for h, m, d in FIXED])))

    def weekday(month: int, dow: int, which: int) -> Column:
        if which > 0:
            first = F.date_add(day(month, 1), F.pmod(F.lit(dow) - F.dayofweek(day(month, 1)), F.lit(7)))
            return F.date_add(first, 7 * (which - 1))
        last = F.last_day(day(month, 1))
        return F.date_sub(last, F.pmod(F.dayofweek(last) - F.lit(dow), F.lit(7)))

    weekdays = years.select(F.inline(F.array(*[F.struct(F.lit(h).alias("holiday"), weekday(m, w, n).alias("date")) for h, m, w, n in WEEKDAYS])))
    gregorian = _staged(
        years, a="y % 19", b="y div 100", c="y % 100", g="(b - (b + 8) div 25 + 1) div 3", h="(19 * a + b - b div 4 - g + 15) % 30",
        l="(32 + 2 * (b % 4) + 2 * (c div 4) - h - c % 4) % 7", m="(a + 11 * h + 22 * l) div 451", n="h + l - 7 * m + 114",
        sunday="make_date(y, cast(n div 31 as int), cast(n % 31 + 1 as int))",
    )
    easter = gregorian.select(F.inline(F.array(*[F.struct(F.lit(h).alias("holiday"), F.date_add("sunday", k).alias("date")) for h, k in EASTER])))
    julian = _staged(
        years, d="(19 * (y % 19) + 15) % 30", e="(2 * (y % 4) + 4 * (y % 7) - d + 34) % 7", n="d + e + 114",
        sunday="date_add(make_date(y, cast(n div 31 as int), cast(n % 31 + 1 as int)), cast(y div 100 - y div 400 - 2 as int))",
    )
    orthodox = julian.select(F.lit("orthodox_easter").alias("holiday"), F.col("sunday").alias("date"))
    # lunar years that can overlap the year; the day number is that of the arithmetic calendar
    lunar_years = years.select("y", F.explode(F.sequence(F.floor((F.col("y") - 622) * 33 / 32) - 1, F.floor((F.col("y") - 622) * 33 / 32) + 2)).alias("lunar"))
    feasts = F.array(*[F.struct(F.lit(h).alias("holiday"), F.lit(m).alias("month"), F.lit(d).alias("dom")) for h, m, d in LUNAR])
    lunar = _staged(
        lunar_years.select("y", "lunar", F.inline(feasts)),
        jd="(11 * lunar + 3) div 30 + 354 * lunar + 30 * month - (month - 1) div 2 + dom + 1948440 - 385 - 1",
        date="date_from_unix_date(cast(jd - 2440587 as int))",
    )
    lunar = lunar.where(F.year("date") == F.col("y")).select("holiday", "date")
    return fixed.unionAll(weekdays).unionAll(easter).unionAll(orthodox).unionAll(lunar)


def interval_join(
    rows: DataFrame, intervals: DataFrame, date_col: str, start_col: str, end_col: str, bucket_days: int = 16, how: str = "inner"
) -> DataFrame:
    """Rows with every interval that holds their date (both ends included).

    An interval is listed under each bucket of days it touches and a row looks
    into its own bucket: an equi-join, then the exact check. ``how`` may be ``inner`` or
    ``left``. Null dates and intervals without both ends, or with the end first, match nothing.
    The columns of ``intervals`` must have names of their own.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    clash = set(rows.columns) & set(intervals.columns)
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    bucket = lambda c: F.floor(F.unix_date(c) / bucket_days)
    start, end, date = F.col(start_col), F.col(end_col), F.col(date_col)
    listed = intervals.where(start <= end).select("*", F.explode(F.sequence(bucket(start), bucket(end))).alias("_bucket"))
    keyed = rows.withColumn("_rbucket", bucket(date))
    joined = keyed.join(listed, (F.col("_rbucket") == F.col("_bucket")) & date.between(start, end), how)
    return joined.drop("_bucket", "_rbucket")


def holiday_spike_rates(
    days: DataFrame, holidays: DataFrame, group_cols: str | Sequence[str] = (), date_col: str = "date", high_col: str = "high",
    before: int = 0, after: int = 7,
) -> DataFrame:
    """How often days are high in the window of each holiday, and outside of all windows:
    ``group..., holiday, n_days_in, n_high_in, rate_in, n_days_out, n_high_out, rate_out, lift``.

    ``days`` has one row per place and day with a boolean ``high_col`` (null: not high); a holiday's window
    goes from ``before`` days before to ``after`` days after it. Days in several windows count in each
    holiday's; a day in two windows of one holiday counts once. ``lift`` is ``rate_in / rate_out``
    (null where nothing is high outside, or no day is). Groups may be null; rows without a date
    are left out; repeated rows count each time; holidays that meet no day of a group are not listed.
    """
    keys = as_list(group_cols)
    per_day = days.where(F.col(date_col).isNotNull()).groupBy(*keys, F.col(date_col).alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(high_col)).alias("_high")
    )
    windows = holidays.select("holiday", F.date_sub("date", before).alias("_from"), F.date_add("date", after).alias("_to"))
    met = interval_join(per_day, windows, "_day", "_from", "_to", how="left")
    met = met.select(*keys, "_day", "_n", "_high", "holiday").distinct()
    total = met.groupBy(*keys, "holiday").agg(F.sum("_n").alias("n_days"), F.sum("_high").alias("n_high"))
    names = [f"_g{i}" for i in range(len(keys))]
    outside = total.where("holiday IS NULL").select(*[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("n_days").alias("_out"), F.col("n_high").alias("_high_out"))
    joined = total.where("holiday IS NOT NULL").join(outside, null_safe(keys, names), "left")
    n_out, high_out = F.coalesce("_out", F.lit(0)), F.coalesce("_high_out", F.lit(0))
    rate_in, rate_out = F.try_divide(F.col("n_high").cast("double"), F.col("n_days").cast("double")), F.try_divide(high_out.cast("double"), n_out.cast("double"))
    return joined.select(
        *keys, "holiday", F.col("n_days").alias("n_days_in"), F.col("n_high").alias("n_high_in"), F.round(rate_in, 6).alias("rate_in"),
        n_out.alias("n_days_out"), high_out.alias("n_high_out"), F.round(rate_out, 6).alias("rate_out"), F.round(F.try_divide(rate_in, rate_out), 6).alias("lift"),
    )
