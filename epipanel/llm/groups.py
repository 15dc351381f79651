"""Groups of rows inside ``mapInArrow``, and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epipanel.plans.joins import materialize


def fixed_bytes(column: pa.Array, width: int) -> np.ndarray:
    """A binary column of equally long values as a (rows, width) byte matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(len(column), width)


def grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of each run of equal (integer) keys, as one batch. The input is
    sorted by the keys; a group must fit into memory."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows == 0:
            continue
        columns = [np.asarray(batch.column(k)) for k in keys]
        cuts = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in columns:
            cuts |= c[1:] != c[:-1]
        starts = [0, *(np.flatnonzero(cuts) + 1).tolist(), batch.num_rows]
        if held and any(held[-1].column(k)[-1].as_py() != c[0] for k, c in zip(keys, columns)):
            yield _joined(held)
            held = []
        for a, b in zip(starts[:-2], starts[1:-1]):
            held.append(batch.slice(a, b - a))
            yield _joined(held)
            held = []
        held.append(batch.slice(starts[-2]))
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (columns ``a, b``): root is the
    smallest node that can be reached.

    Alternating large-star and small-star steps: each is a grouped minimum
    (combined before the shuffle) and a join with it. The minima are stored
    before the join, so either side of it has a shuffle of its own and Spark may
    split the rows of a node with very many edges. Rounds end when nothing changes.
    """
    forward = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = materialize(forward)
    state = _state(current)
    while True:
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialize(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m")))
        joined = both.where("b > a").join(least, F.col("a") == F.col("u"))
        large = materialize(joined.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        smallest = materialize(large.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u"))
        kept = large.join(smallest, F.col("a") == F.col("u")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        small = kept.unionAll(smallest.select(F.col("u").alias("a"), F.col("m").alias("b"))).where("a <> b").distinct()
        current = materialize(small)
        before, state = state, _state(current)
        if before == state:
            break
    # now every edge is a star from a node to its root
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _state(edges: DataFrame) -> tuple:
    """Number and hash sum of the edges: equal when a round changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
