"""Join strategy helpers: broadcast only what is proven small.

A broadcast is copied to every executor, so it is only safe for a side whose
size is bounded. Two kinds of bound are used in the package:

* a *parameter* bound, known on the driver without running anything (an
  allow-list passed as a Python list);
* a *checked* bound: the small side is materialised once into the shared
  checkpoint folder, counted, and broadcast only if the count is within the
  limit. Beyond the limit the plain DataFrame is returned and Spark/AQE picks
  a shuffle join, so large inputs degrade to a slower plan, never to an
  out-of-memory driver or executor.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epipanel.session import ensure_checkpoint_dir

# Limits of checked broadcasts: rows, and bytes of the rows' values. Rows alone
# would say nothing about a table with long texts.
BROADCAST_MAX_ROWS = 500_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
# Bytes counted for each value beside its text: what a row format needs for it.
VALUE_BYTES = 16


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and cut its lineage.

    Reliable checkpoints survive executor loss (unlike local checkpoints or
    caching), so a lost executor never forces recomputing the upstream plan.
    The columns come back under fresh attribute ids: the result is usually
    joined with the plan it was derived from, and sharing ids with it would
    make that join a self-join for the analyser to untangle.
    """
    ensure_checkpoint_dir(df.sparkSession)
    saved = df.checkpoint(eager=True)
    return saved.select(*[F.col("`" + c.replace("`", "``") + "`").alias(c) for c in saved.columns])


def checked_broadcast(
    small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES
) -> DataFrame:
    """Materialise ``small``, count its rows and bytes, and mark it for
    broadcast if both are within the limits."""
    small = materialize(small)
    rows, size = small.agg(F.count(F.lit(1)), F.coalesce(F.sum(row_bytes(small)), F.lit(0))).first()
    return F.broadcast(small) if rows <= max_rows and size <= max_bytes else small


def row_bytes(df: DataFrame) -> Column:
    """About how many bytes a row of ``df`` takes: ``VALUE_BYTES`` a column and
    the bytes of its texts; nested columns by their JSON text."""
    parts = [F.lit(VALUE_BYTES * max(1, len(df.columns)))]
    for field in df.schema.fields:
        c = F.col("`" + field.name.replace("`", "``") + "`")
        kind = field.dataType.typeName()
        if kind in ("string", "binary", "varchar", "char"):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)))
        elif kind in ("array", "map", "struct", "variant"):
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
    return reduce(lambda a, b: a + b, parts)


def null_safe(left: Sequence[str], right: Sequence[str]) -> Column:
    """Column by column equal, nulls being equal; true for no columns."""
    ident = lambda c: F.col("`" + c.replace("`", "``") + "`")
    return reduce(and_, [ident(a).eqNullSafe(ident(b)) for a, b in zip(left, right)], F.lit(True))
