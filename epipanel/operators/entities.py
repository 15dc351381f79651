"""Keep only recognised entities, or those whose name matches a target."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.functions.allow_lists import INLIST_MAX, US_STATES
from epipanel.functions.columns import as_list
from epipanel.plans.joins import BROADCAST_MAX_BYTES, VALUE_BYTES


def keep_entities(df: DataFrame, col: str, allowed: Iterable[str] | DataFrame = US_STATES) -> DataFrame:
    """Rows whose ``col`` is in the allow-list; null entities are dropped.

    * A Python list up to ``INLIST_MAX`` names becomes an ``IN`` filter
      (``InSet``), which Catalyst pushes into the Parquet scan — no join.
    * A longer list, or a one-column DataFrame, becomes a left-semi join.
      The list's bytes are known on the driver: within ``BROADCAST_MAX_BYTES``
      it is broadcast, beyond Spark chooses the join; a DataFrame allow-list is left to the optimiser (AQE broadcasts it at
      runtime when it is small, otherwise it is a shuffle semi-join).
    """
    if isinstance(allowed, DataFrame):
        names = allowed.select(allowed.columns[0]).withColumnRenamed(allowed.columns[0], col)
        return df.join(names, col, "left_semi")
    names = sorted(set(allowed))
    if len(names) <= INLIST_MAX:
        return df.where(F.col(col).isin(names))
    spark = df.sparkSession
    table = spark.createDataFrame([(n,) for n in names], f"`{col}` string")
    size = sum(len(n.encode()) + VALUE_BYTES for n in names)
    return df.join(F.broadcast(table) if size <= BROADCAST_MAX_BYTES else table, col, "left_semi")


def fill_identity(df: DataFrame, cols: str | Sequence[str], value: str = " ") -> DataFrame:
    """Null cells of the named identity columns replaced by ``value``, the
    fill the original meant to apply before it read rows by position. Other
    columns, measures included, keep their nulls."""
    wanted = set(as_list(cols))
    missing = wanted - set(df.columns)
    if missing:
        raise ValueError(f"no such columns: {sorted(missing)}")
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in df.columns}
    return df.select(*[F.coalesce(quoted[c].cast("string"), F.lit(value)).alias(c) if c in wanted else quoted[c] for c in df.columns])


def like_entity(df: DataFrame, col: str, text: str, how: str = "contains") -> DataFrame:
    """Rows whose ``col`` contains (``LIKE '%t%'``) or ends with
    (``LIKE '%t'``) ``text``, matched literally (no wildcard injection)."""
    if how == "contains":
        return df.where(F.col(col).contains(text))
    if how == "suffix":
        return df.where(F.col(col).endswith(text))
    raise ValueError("how must be 'contains' or 'suffix'")
