"""SparkSession construction and shared-folder lookup.

Every operator in the package is a pure ``DataFrame -> DataFrame`` function;
the session is only needed by sources, checkpoints and the query catalogue.
"""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours needs. AQE re-plans joins and coalesces
# shuffle partitions at runtime; UTC keeps dates identical to the SQL oracle.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # delete reliable checkpoint files once their DataFrame is unreachable,
    # so small materialised tables do not pile up in the shared folder
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


MIB = 1024 * 1024
# Target bytes per task: large enough to amortise task overhead, small
# enough that a sort or hash buffer of one partition fits an executor core's
# share of memory (a few GiB) without heavy spilling.
TARGET_PARTITION_BYTES = 256 * MIB
MAX_SHUFFLE_PARTITIONS = 100_000


def scale_conf(input_bytes: int, target_bytes: int = TARGET_PARTITION_BYTES) -> dict[str, str]:
    """Partition sizing for an input of ``input_bytes`` (e.g. 100 TB).

    * file splits of ``target_bytes`` (``spark.sql.files.maxPartitionBytes``);
    * shuffle partitions so that shuffling the whole input gives about
      ``target_bytes`` per reducer, capped at ``MAX_SHUFFLE_PARTITIONS``
      (mappers x reducers shuffle blocks must stay manageable; at 100 TB the
      cap means ~1 GB per reducer, which sorts and aggregates spill);
    * AQE coalesces the partitions of the many small, pre-aggregated
      shuffles and splits skewed ones.
    """
    partitions = min(MAX_SHUFFLE_PARTITIONS, max(200, -(-int(input_bytes) // target_bytes)))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(16 * MIB),
    }


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of files under ``paths``, globs included (Hadoop-FS
    metadata; no data read)."""
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(hconf)
        matches = fs.globStatus(path)
        if not matches:
            raise FileNotFoundError(p)
        total += sum(fs.getContentSummary(m.getPath()).getLength() for m in matches)
    return total


def size_partitions_for(spark: SparkSession, paths) -> dict[str, str]:
    """Apply :func:`scale_conf` for the inputs at ``paths`` to the running
    session, leaving every setting the submitter set explicitly untouched."""
    explicit = spark.sparkContext.getConf()
    chosen = {k: v for k, v in scale_conf(input_bytes(spark, paths)).items() if not explicit.contains(k)}
    for key, value in chosen.items():
        spark.conf.set(key, value)
    return chosen


def build_session(
    master: str | None = None,
    app_name: str = "epipanel",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """Create (or fetch) a session with the package's base settings.

    ``master`` and ``shuffle_partitions`` are only for local runs and tests;
    on a cluster leave them ``None`` so the submitter's settings win, or pass
    ``input_bytes`` to size partitions with :func:`scale_conf`.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if input_bytes:
        conf.update(scale_conf(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local_master(spark: SparkSession) -> bool:
    """True for ``local[...]`` masters, whose tasks all share this machine's disk."""
    return (spark.sparkContext.master or "").startswith("local") and not spark.sparkContext.master.startswith(
        "local-cluster"
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` must name a folder that the driver
    and every executor share (HDFS, an object store, a network mount); a
    session without it raises. Only a ``local[...]`` session (a unit test)
    gets a fresh scratch folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server owns the checkpoint folder
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir on the Spark Connect server") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not _is_local_master(spark):
            raise RuntimeError(
                f"spark.checkpoint.dir is not set and the master is {sc.master}: name a folder "
                "that the driver and all executors share"
            )
        configured = tempfile.mkdtemp(prefix="epipanel-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch: list[str] = []


def shared_scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder.

    The path is remembered: :func:`clear_scratch` deletes everything handed
    out, and runs by itself when the driver process ends.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_clear_at_exit, spark)
    _scratch.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete every scratch path handed out so far; returns how many existed.

    Call it only when all results that read them have been consumed.
    """
    jvm = spark.sparkContext._jvm
    hconf = spark.sparkContext._jsc.hadoopConfiguration()
    deleted = 0
    while _scratch:
        path = jvm.org.apache.hadoop.fs.Path(_scratch.pop())
        deleted += bool(path.getFileSystem(hconf).delete(path, True))
    return deleted


def _clear_at_exit(spark: SparkSession) -> None:
    try:
        clear_scratch(spark)
    except Exception:  # the session was stopped first: nothing left to ask
        _scratch.clear()


def write_scratch(df, name: str):
    """Write ``df`` once as Parquet under the shared checkpoint folder and
    return the table read back: a lineage cut that survives lost executors
    and lets later steps read only the columns they need."""
    path = shared_scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
