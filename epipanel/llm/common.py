"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epipanel.operators.ranges import unused_name
from epipanel.session import table_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def col(name: str) -> Column:
    """The column called exactly ``name`` (dots and spaces included)."""
    return F.col("`" + name.replace("`", "``") + "`")


def narrow(df: DataFrame, **columns: str) -> DataFrame:
    """Only the given columns, under internal names. Whatever other columns
    ``df`` has can then not clash with those an operator adds."""
    return df.select(*[col(name).alias(alias) for alias, name in columns.items()])


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has."""
    return [unused_name(df, name) for name in names]


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else."""
    return F.translate(text, UPPER, LOWER)


def crc_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id written as text, modulo ``modulus``; null ids count as
    the text ``null`` so that every row has a bucket."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("null")).cast("binary")) % modulus


Batches = Iterator[pa.RecordBatch]


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``, handing its memory back to the system when a task
    ends: Spark keeps the Python worker for later stages, with all it has allocated."""

    def wrapped(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim:
                trim(0)

    return wrapped
