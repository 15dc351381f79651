"""Most and least affected entities (top-k / bottom-k)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ranked(totals: DataFrame, entity: str, by: str, k: int, descending: bool) -> DataFrame:
    infected = F.col("infected")
    order = infected.desc_nulls_last() if descending else infected.asc_nulls_last()
    # ``orderBy(...).limit(k)`` plans as TakeOrderedAndProject: every task
    # keeps its own top k and only k rows per task reach the final merge.
    return (
        totals.select(F.col(entity), F.col(by).alias("infected"))
        .orderBy(order, F.col(entity).asc_nulls_last())
        .limit(k)
    )


def most_infected(totals: DataFrame, entity: str, by: str = "total_confirmed", k: int = 10) -> DataFrame:
    """The ``k`` entities with the largest ``by`` (``entity, infected``);
    ties are broken by entity name so the cut is deterministic."""
    return _ranked(totals, entity, by, k, descending=True)


def least_infected(totals: DataFrame, entity: str, by: str = "total_confirmed", k: int = 10) -> DataFrame:
    """The ``k`` entities with the smallest ``by`` (``entity, infected``)."""
    return _ranked(totals, entity, by, k, descending=False)
