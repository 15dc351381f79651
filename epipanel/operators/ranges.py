"""Ranks and running totals over a whole table, without a whole-table window.

Rows are range-partitioned by the order, each partition's total is taken (one
number a partition), and a row's running total is its partition's base plus the
running total inside the partition. No task holds more than one range.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epipanel.session import write_scratch


def running_total(
    df: DataFrame, order: Sequence[Column], weight: Column | None = None, name: str = "before", partitions: int | None = None
) -> DataFrame:
    """``df`` with ``name`` (decimal(38,0) for a weight, else bigint): the sum of ``weight`` (default: the
    number of rows) over all rows that come earlier in ``order``.

    * rows equal in all of ``order`` are told apart by their place in the stored
      table, so that many equal rows spread over partitions too;
    * a null weight counts as 0; an empty table gives no rows.

    ``df`` is written to the shared checkpoint folder when this is called, and
    once more by ranges. The driver sees one number a partition.
    """
    own = {n: unused_name(df, n) for n in ("_w", "_tie", "_part", "_base")}
    w, tie, part, base = own.values()
    amount = F.lit(1).cast("bigint") if weight is None else F.coalesce(weight.cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))
    stored = write_scratch(df.select("*", amount.alias(w), F.monotonically_increasing_id().alias(tie)), "to-rank")
    by = [*order, F.col(tie)]
    ranged = stored.repartitionByRange(partitions, *by) if partitions else stored.repartitionByRange(*by)
    ranged = write_scratch(ranged.withColumn(part, F.spark_partition_id()), "ranges")
    totals = sorted((r[part], r["n"]) for r in ranged.groupBy(part).agg(F.sum(w).alias("n")).collect())
    kind = "bigint" if weight is None else "decimal(38,0)"
    starts = [0, *accumulate(n for _, n in totals)][: len(totals)]
    # decimals travel as text, which holds any of them
    bases = df.sparkSession.createDataFrame([(p, str(b)) for (p, _), b in zip(totals, starts)], f"`{part}` int, `{base}` string")
    inside = Window.partitionBy(part).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    running = F.coalesce(F.sum(w).over(inside), F.lit(0)).cast(kind)
    # one row a partition: bounded by the number of shuffle partitions
    placed = ranged.withColumn(name, running).join(F.broadcast(bases), part)
    return placed.withColumn(name, (F.col(name) + F.col(base).cast(kind)).cast(kind)).drop(w, tie, part, base)


def percent_rank(
    df: DataFrame, value_col: str, group_cols: str | Sequence[str] = (), partitions: int | None = None
) -> DataFrame:
    """``df`` with ``pct_rank`` and ``n_ranked``: the share of the other rows of
    its group that have a smaller value (ties share the lowest, as SQL's
    ``percent_rank``), and the number of rows ranked with it.

    The values' histogram, combined before the shuffle, is ranked by ranges;
    the rows then look their value up. One value that a third of all rows
    share is one row of the histogram; the lookup joins it back with either
    side shuffled by itself, so Spark may split that value's rows.

    * null values are not ranked (null ``pct_rank``); a single row has rank 0.0;
    * null groups are a group; an empty table gives no rows.
    """
    from epipanel.functions.columns import as_list
    from epipanel.plans.joins import null_safe

    groups = as_list(group_cols)
    keys = [F.col("`" + g.replace("`", "``") + "`") for g in groups]
    value = F.col("`" + value_col.replace("`", "``") + "`")
    names = [unused_name(df, f"_g{i}") for i in range(len(groups))]
    v = unused_name(df, "_value")
    counted = df.where(value.isNotNull()).groupBy(*[k.alias(n) for k, n in zip(keys, names)], value.alias(v)).agg(
        F.count(F.lit(1)).alias("_n")
    )
    ranked = running_total(counted, [*[F.col(n) for n in names], F.col(v)], F.col("_n"), "_before", partitions)
    ranked = write_scratch(ranked, "ranked")
    # a group starts where its smallest value does, and ends with its largest
    bounds = ranked.groupBy(*names).agg(
        F.min("_before").alias("_first"), F.max(F.col("_before") + F.col("_n")).alias("_end")
    )
    bounds = write_scratch(bounds.toDF(*[f"{n}b" for n in names], "_first", "_end"), "ranked-groups")
    below = (F.col("_before") - F.col("_first")).cast("bigint")
    total = (F.col("_end") - F.col("_first")).cast("bigint")
    shares = ranked.join(bounds, null_safe(names, [f"{n}b" for n in names])).select(
        *names, v, F.coalesce(F.try_divide(below.cast("double"), (total - 1).cast("double")), F.lit(0.0)).alias("pct_rank"), total.alias("n_ranked")
    )
    shares = write_scratch(shares, "shares")
    same = null_safe([*groups, value_col], [*names, v])
    return df.drop("pct_rank", "n_ranked").join(shares, same, "left").drop(*names, v)


def unused_name(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores before it as no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name
