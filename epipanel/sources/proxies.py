"""Stand-in inputs built from the driver's test tables.

No case files ship with the tests, so the analyses run on tables derived
from the generic test data, in exactly the schemas the case files give:

* ``observations(obs_date, state, country, confirmed, deaths, recovered)``:
  orders per day and nation (``state``) with its region (``country``);
  confirmed = orders, deaths = finished (``F``) orders, recovered = open
  (``O``) orders.
* ``population(state, population)``: one row per customer ("county") with
  ``floor(c_acctbal)`` as its population.
* ``event_panel``: for any entity expression over ``events``, one row per
  entity and calendar day from the first to the last event day of the table,
  ``value`` = running count of the entity's events (a cumulative series
  like the case time series).

These builders only shape input rows; all analysis happens in
``epipanel.operators``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epipanel.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def geography(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation_key, state, country``: nation names with their region.

    Not hinted: the planner broadcasts a file-backed relation only when its
    measured size is under ``spark.sql.autoBroadcastJoinThreshold`` (nation
    and region are a few KB), and plans a shuffle join otherwise.
    """
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("nation_key"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("country"),
    )


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    geo = geography(spark, sf_dir)
    placed = customer.join(geo, customer.c_nationkey == geo.nation_key).select(
        "c_custkey", "state", "country"
    )
    return (
        orders.join(placed, orders.o_custkey == placed.c_custkey)
        .groupBy(F.to_date("o_orderdate").alias("obs_date"), "state", "country")
        .agg(
            F.count(F.lit(1)).alias("confirmed"),
            F.count_if(F.col("o_orderstatus") == "F").alias("deaths"),
            F.count_if(F.col("o_orderstatus") == "O").alias("recovered"),
        )
    )


def population(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = read_table(spark, sf_dir, "customer").select("c_nationkey", "c_acctbal")
    geo = geography(spark, sf_dir)
    return customer.join(geo, customer.c_nationkey == geo.nation_key).select(
        "state", F.floor("c_acctbal").alias("population")
    )


def population_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`population` as text like ``12.0``; every tenth customer has no number."""
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    geo = geography(spark, sf_dir)
    text = F.format_string("%d.0", F.floor("c_acctbal"))
    return customer.join(geo, customer.c_nationkey == geo.nation_key).select(
        "state", F.when(F.col("c_custkey") % 10 == 0, "n/a").otherwise(text).alias("population")
    )


def gap_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`user_panel` with a null group and with empty cells."""
    panel = user_panel(spark, sf_dir)
    empty = (F.col("location") * 7 + F.dayofmonth("date")) % 11 == 0
    return panel.select(
        F.nullif("grp", F.lit(0)).alias("grp"), "location", "date", F.when(~empty, F.col("value")).alias("value")
    )


def event_panel(spark: SparkSession, sf_dir: str, entities: dict[str, Column]) -> DataFrame:
    """Dense cumulative daily panel of event counts per entity.

    Events are pre-aggregated to (entity, day) counts with map-side
    combining, so a hot entity is reduced before any shuffle. Each entity's
    day spine is generated with ``sequence`` (no cross join) as rows that
    count nothing, which are added to the counts; the running sum is a
    window over the entity. Events without a time have no day and are left out.
    """
    names = list(entities)
    events = read_table(spark, sf_dir, "events").where("ts IS NOT NULL").select(
        *[c.alias(n) for n, c in entities.items()], F.to_date("ts").alias("date")
    )
    first_day = events.select(F.min("date")).scalar()
    last_day = events.select(F.max("date")).scalar()
    daily = (
        events.groupBy(*names, "date")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    spine = daily.select(*names).distinct().select(
        *names, F.explode(F.sequence(first_day, last_day)).alias("date"), F.lit(0).cast("bigint").alias("n")
    )
    dense = daily.unionByName(spine).groupBy(*names, "date").agg(F.sum("n").alias("n"))
    running = Window.partitionBy(*names).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return dense.select(*names, "date", F.sum("n").over(running).alias("value"))


def user_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``grp, location, date, value``: users as places, 5 groups of users."""
    return event_panel(
        spark,
        sf_dir,
        {"grp": F.col("user_id") % 5, "location": F.col("user_id")},
    )


def type_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``combined_key, date, value``: one cumulative series per event type."""
    return event_panel(spark, sf_dir, {"combined_key": F.col("event_type")})


def world_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``province, country, date, value``: a two-key (world-file) panel."""
    return event_panel(
        spark,
        sf_dir,
        {
            "province": (F.col("user_id") % 5).cast("string"),
            "country": F.col("event_type"),
        },
    )
