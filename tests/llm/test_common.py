"""Helpers of this subpackage."""

import pickle

import pyarrow as pa
import pytest
from pyspark import cloudpickle

from epipanel.llm.common import tidy


def batch(n):
    return pa.RecordBatch.from_arrays([pa.array(range(n))], names=["x"])


def test_tidy_gives_the_same_batches():
    double = lambda batches: (b for x in batches for b in (x, x))
    run = pickle.loads(cloudpickle.dumps(tidy(double)))
    assert [b.num_rows for b in run(iter([batch(1), batch(2)]))] == [1, 1, 2, 2]
    assert list(run(iter([]))) == []


def test_tidy_passes_errors_on_and_may_be_left_early():
    def fails(batches):
        yield next(batches)
        raise ValueError("no")

    run = tidy(fails)(iter([batch(1)]))
    assert next(run).num_rows == 1
    with pytest.raises(ValueError):
        next(run)
    early = tidy(lambda batches: batches)(iter([batch(1), batch(2)]))
    next(early)
    early.close()
