"""Readers and writers for the case files.

Source files are CSV with a header. Every cell is declared as text and typed
with ``try_*`` casts, so a malformed cell becomes null instead of failing a
job that reads terabytes. Paths are any Hadoop-FS URI (``hdfs://``,
``s3a://``, ``file:``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epipanel.functions.columns import as_list
from epipanel.functions.dates import parse_observation_date
from epipanel.functions.numeric import to_count

# Column names of the daily observation file.
OBSERVATION_COLUMNS = (
    "SNo", "ObservationDate", "Province/State", "Country/Region",
    "Last Update", "Confirmed", "Deaths", "Recovered",
)

OBSERVATION_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in OBSERVATION_COLUMNS])


def read_observations(spark: SparkSession, path: str) -> DataFrame:
    """The daily observation file as a typed long table.

    Output: ``obs_date date, state string, country string, confirmed,
    deaths, recovered bigint``. Counts written as ``5.0`` are accepted. A
    file whose columns are in another order is rejected, not misread.
    """
    raw = spark.read.schema(OBSERVATION_SCHEMA).option("header", True).option("enforceSchema", False).csv(path)
    return typed_observations(raw)


def typed_observations(raw: DataFrame) -> DataFrame:
    """Observation rows as text, batch or stream, with their types."""
    return raw.select(
        parse_observation_date(F.col("ObservationDate")).alias("obs_date"),
        F.col("`Province/State`").alias("state"),
        F.col("`Country/Region`").alias("country"),
        to_count(F.col("Confirmed")).alias("confirmed"),
        to_count(F.col("Deaths")).alias("deaths"),
        to_count(F.col("Recovered")).alias("recovered"),
    )


def read_wide(spark: SparkSession, path: str) -> DataFrame:
    """A wide time-series file exactly as written (all columns text).

    No schema inference (it would scan the data twice); the header gives the
    names and :func:`epipanel.operators.reshape.wide_to_long` types the
    values. Identity columns are chosen by name by the caller. In a folder
    one file's header gives the names, and every other file is checked
    against it: a different order is rejected.
    """
    names = spark.read.option("header", True).option("inferSchema", False).csv(path).schema
    return spark.read.schema(names).option("header", True).option("enforceSchema", False).csv(path)


def write_snapshot(
    df: DataFrame,
    path: str,
    partition_cols: str | Sequence[str] = (),
    header: bool = True,
    mode: str = "errorifexists",
    single_file: bool = False,
    sort_cols: Sequence = (),
) -> None:
    """Write a result as CSV, one directory per partition value.

    The directory layout ``<col>=<value>/`` replaces the original's
    hand-built ``output/<Country>/<State>/<metric>/<stat>.csv`` paths. The
    default save mode refuses to overwrite, like the original.
    ``single_file`` funnels everything through one task: only for results
    known to be small.

    Rows are rebalanced by the partition columns first, so that a folder is
    written by few tasks (small ones share a task, a large one is split) and
    not by every task that holds a row of it. ``sort_cols`` orders the rows
    of each file.
    """
    cols = as_list(partition_cols)
    writer_df = df.coalesce(1) if single_file else df.hint("rebalance", *cols) if cols else df
    if sort_cols:
        writer_df = writer_df.sortWithinPartitions(*cols, *sort_cols)
    writer = writer_df.write.mode(mode).option("header", header)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.csv(path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read back a :func:`write_snapshot` directory with a declared schema.

    Partition columns come from the directory names and must be part of
    ``schema``; declaring them keeps their types stable. The header is
    checked against the schema's names, so a file whose columns are in
    another order is rejected instead of being read mislabelled.
    """
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
