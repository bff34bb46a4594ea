"""Session construction and the shared scratch location.

``build_session`` is for scripts and tests. Library operators never build a
session; they take the caller's and, at most, set runtime SQL confs.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Parquet codec of landed copies: about a third smaller than the default.
LANDING_CODEC = "zstd"

# Runtime SQL confs the operators are designed around.
RUNTIME_CONFS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only what the runtime statistics prove small.
    "spark.sql.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(10 * 1024 * 1024),
}


def build_session(
    app_name: str = "claimspark",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    driver_memory: str | None = None,
    enable_hive: bool = False,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE, Arrow and a quiet log.

    Partition counts and memory are set only if given (scripts, tests); a job
    on a cluster takes them from its submit command."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    confs = {
        **RUNTIME_CONFS,
        **({"spark.sql.shuffle.partitions": str(shuffle_partitions)} if shuffle_partitions else {}),
        **({"spark.driver.memory": driver_memory} if driver_memory else {}),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        **(extra or {}),
    }
    for key, value in confs.items():
        builder = builder.config(key, value)
    if enable_hive:
        builder = builder.enableHiveSupport()
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    ensure_checkpoint_dir(spark)
    return spark


def configure(spark: SparkSession, shuffle_partitions: int | None = None) -> SparkSession:
    """Apply the runtime SQL confs to an existing session."""
    for key, value in RUNTIME_CONFS.items():
        spark.conf.set(key, value)
    if shuffle_partitions:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder, and its absence
    is an error: every executor would write to its own disk. A temporary folder
    is made only for a ``local`` master (tests).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="claimspark-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "claimspark", f"{name}-{uuid.uuid4().hex[:12]}")


_SCOPES: list[list[str]] = []


@contextmanager
def landings_released(spark: SparkSession):
    """Delete what ``materialize`` lands inside this scope when it ends. Frames
    that read those landings must have been written or used up by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for path in _SCOPES.pop():
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def materialize(df, name: str = "stage"):
    """Write ``df`` as Parquet under the shared checkpoint folder and read it
    back: cuts the lineage (a lost executor re-reads files instead of
    recomputing joins and windows) and gives later branches pruned scans. The
    schema is given, so that no job has to look it up in the files."""
    path = shared_path(df.sparkSession, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    df.write.mode("overwrite").option("compression", LANDING_CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
