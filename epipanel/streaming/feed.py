"""Keep totals and first occurrences current as new daily files arrive.

The batch operators are plain aggregations, so they run unchanged on a
Structured Streaming source: ``accumulate``, ``first_occurrence`` and
``outcome_ratios`` become stateful streaming aggregations whose state (one
row per entity) lives in the query's checkpoint. Each micro-batch reads
only the new files.

Results are published with ``foreachBatch``: the complete per-entity table
is written to a new folder for every batch, and readers take the newest folder
that was finished. A replayed batch rewrites its own folder, so a restarted or
partially failed query converges to the same output, and no reader ever
sees a table that is half written or missing.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from epipanel.operators.occurrence import accumulate, first_occurrence, outcome_ratios
from epipanel.session import shared_scratch_path
from epipanel.sources.files import OBSERVATION_SCHEMA, typed_observations


def observation_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """New observation CSV files under ``path`` as a typed stream (same
    columns as :func:`epipanel.sources.files.read_observations`)."""
    reader = spark.readStream.schema(OBSERVATION_SCHEMA).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return typed_observations(reader.csv(path))


def running_totals(stream: DataFrame, entity: str, allowed: Iterable[str] | None = None) -> DataFrame:
    """Streaming :func:`epipanel.operators.occurrence.accumulate`."""
    return accumulate(stream, entity, allowed)


def running_first_occurrence(stream: DataFrame, measure: str, entity: str, tie_break=()) -> DataFrame:
    """Streaming :func:`epipanel.operators.occurrence.first_occurrence`."""
    return first_occurrence(stream, measure, entity, tie_break=tie_break)


def running_outcome_ratios(stream: DataFrame, entity: str, allowed, tie_break=(), first_where=None) -> DataFrame:
    """Streaming :func:`epipanel.operators.occurrence.outcome_ratios` (first
    dates and fatality / recovery ratios from one stateful aggregation)."""
    return outcome_ratios(stream, entity, allowed, tie_break=tie_break, first_where=first_where)


def _hadoop(spark: SparkSession, path: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def _version_path(table_path: str, batch_id: int) -> str:
    return f"{table_path.rstrip('/')}/version={batch_id:019d}"


def _versions(spark: SparkSession, table_path: str) -> list[int]:
    """Batch ids of the finished versions, ascending."""
    fs, root = _hadoop(spark, table_path)
    if not fs.exists(root):
        return []
    found = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("version=") and fs.exists(_hadoop(spark, f"{table_path.rstrip('/')}/{name}/_SUCCESS")[1]):
            found.append(int(name.removeprefix("version=")))
    return sorted(found)


def read_published(spark: SparkSession, table_path: str) -> DataFrame:
    """The newest finished version of a published table."""
    versions = _versions(spark, table_path)
    if not versions:
        raise FileNotFoundError(f"nothing has been published under {table_path} yet")
    return spark.read.parquet(_version_path(table_path, versions[-1]))


def publish(
    result: DataFrame,
    table_path: str,
    checkpoint_path: str | None = None,
    available_now: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Run a streaming aggregation and keep the newest version under
    ``table_path`` (read it with :func:`read_published`) equal to its
    complete current result.

    ``available_now`` processes every file present and stops (a scheduled
    catch-up run); otherwise the query keeps running, one micro-batch per
    ``interval``. The checkpoint lives in the shared checkpoint folder unless
    a path is given. State is one row per entity, so it needs no watermark.
    """
    spark = result.sparkSession
    checkpoint_path = checkpoint_path or shared_scratch_path(spark, "stream-state")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(_version_path(table_path, batch_id))
        # the version before stays for readers that have just opened it
        for old in [v for v in _versions(spark, table_path) if v < batch_id][:-1]:
            fs, path = _hadoop(spark, _version_path(table_path, old))
            fs.delete(path, True)

    writer = (
        result.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint_path)
        .foreachBatch(write_batch)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
