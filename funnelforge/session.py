"""Session construction and shared scratch locations.

Everything here is configuration, not execution: the library never pins a
master, and it only sets a checkpoint directory when the cluster has not
named one (local runs and tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  UTC is required for the
# epoch -> timestamp conversions to be stable (see functions.semantics).
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "funnelforge",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the package defaults.

    ``master`` is only set when given (tests / bench); on a cluster the
    launcher decides.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.ui.enabled", "false")
    for k, v in CORE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    apply_core_conf(spark)
    ensure_checkpoint_dir(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable part of CORE_CONF to an existing session."""
    for k, v in CORE_CONF.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a foreign session: leave as is
            pass


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; we read it
    and never override it.  Only a local master may go without: all its tasks
    see the driver's temp folder.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="funnelforge-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's written intermediate tables.  Results that were
    built on them can't be read afterwards."""
    base = ensure_checkpoint_dir(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(base.rstrip("/"), "ff-scratch"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path inside the shared checkpoint directory.

    Used for written intermediate tables (lineage cuts) and for query
    fixtures that must round-trip through files.  Each call gets a new
    directory, so concurrent or repeated runs never collide.
    """
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base.rstrip("/"), "ff-scratch", f"{name}-{uuid.uuid4().hex[:12]}")
