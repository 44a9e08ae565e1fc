"""SparkSession construction and shared-folder helpers.

Cluster settings win: every option here is applied only when the session does
not already carry a value, so a spark-submit / cluster config is never
overridden. ``spark.checkpoint.dir`` is read from the session; a private
``/tmp`` folder is used only when it is unset (local tests).
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults tuned for correctness parity (UTC, ANSI) and for scale (AQE with
# runtime broadcast conversion behind a byte threshold, skew-join splitting,
# partition coalescing).  Broadcasts only happen when Spark has measured the
# side below the threshold; beyond it the join stays sort-merge.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when the operator above (e.g. the case
    # dedup riding the l_orderkey join) then needs its own exchange: partial
    # aggregation shrinks each split first, so no task carries a hot key alone
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(128 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoints are removed once nothing refers to them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


CLUSTER_INITIAL_SHUFFLE_PARTITIONS = 16384


def get_spark(
    app: str = "rxlake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` and ``shuffle_partitions`` are for local runs; on a cluster
    leave them unset and let AQE size shuffles from
    ``advisoryPartitionSizeInBytes``.
    """
    from pyspark import SparkConf

    given = SparkConf()  # spark-submit / spark-defaults values, if any
    builder = SparkSession.builder.appName(app)
    if master and not given.contains("spark.master"):
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    elif not given.contains("spark.sql.shuffle.partitions"):
        # cluster run without an explicit count: start wide (the default 200
        # would give multi-GB reducers at 100 TB); AQE coalesces small
        # shuffles back to ~advisoryPartitionSizeInBytes each
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = str(CLUSTER_INITIAL_SHUFFLE_PARTITIONS)
        # coalesce towards the advisory byte size rather than maximising task count
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    conf.update(extra or {})
    active = SparkSession.getActiveSession()
    for key, value in conf.items():
        if given.contains(key) and key not in (extra or {}):
            continue
        if active is not None:
            try:
                if key in (extra or {}) or active.conf.get(key, None) is None:
                    active.conf.set(key, value)
            except Exception:  # noqa: BLE001 - static conf of a running session
                pass
        else:
            builder = builder.config(key, value)
    spark = active or builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared (HDFS/object store)
    folder; it is used as is, and its absence is an error.  Only for a
    ``local`` master with nothing configured (tests) is a fresh private
    folder under the system temp dir created.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset conf raises on some versions
            configured = None
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if sc.master != "local" and not sc.master.startswith("local["):
        # a machine-local folder is invisible to other executors: refuse
        raise RuntimeError(
            "spark.checkpoint.dir is not set: point it at a shared folder (HDFS / object store) "
            "for checkpoints, materialised small sides and streaming state"
        )
    local = tempfile.mkdtemp(prefix="rxlake-ckpt-")
    sc.setCheckpointDir(local)
    spark.conf.set("spark.checkpoint.dir", local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint dir for written cut points."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop FileSystem that owns ``path``
    (works for local, HDFS and object-store URIs alike)."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop FS has no Python API
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())  # noqa: SLF001
    return bool(fs.exists(hpath))
