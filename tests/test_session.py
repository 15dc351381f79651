"""Shared-folder rules: use the cluster's checkpoint folder, never replace it."""

from epipanel.session import ensure_checkpoint_dir, shared_scratch_path


def test_configured_checkpoint_dir_is_kept(spark):
    before = spark.sparkContext.getCheckpointDir()
    assert before
    assert ensure_checkpoint_dir(spark) == before
    assert spark.sparkContext.getCheckpointDir() == before


def test_scratch_paths_live_under_the_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark).rstrip("/")
    a, b = shared_scratch_path(spark, "x"), shared_scratch_path(spark, "x")
    assert a.startswith(base + "/x-") and b.startswith(base + "/x-") and a != b


def test_materialize_uses_reliable_checkpoint(spark):
    from epipanel.plans.joins import checked_broadcast, materialize

    df = spark.range(10)
    m = materialize(df)
    assert "LocalCheckpoint" not in m._jdf.queryExecution().toString()
    assert m.count() == 10
    small = checked_broadcast(spark.range(5), max_rows=10)
    assert "ResolvedHint (strategy=broadcast)" in small._jdf.queryExecution().analyzed().toString()
    big = checked_broadcast(spark.range(50), max_rows=10)
    assert "broadcast" not in big._jdf.queryExecution().analyzed().toString()
