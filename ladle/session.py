"""Session construction and cluster-facing settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter at scale.  AQE re-plans joins from runtime sizes,
# coalesces small shuffle partitions and splits skewed join partitions.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Checkpoint files of RDDs that are no longer referenced are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "ladle", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count should then be sized to the data
    (roughly input bytes / 128 MB), not to the core count.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint directory the cluster names.

    The cluster's ``spark.checkpoint.dir`` always wins.  Only when it is
    unset in a local-mode session (tests) a scratch directory is created;
    a cluster session without one is an error, because a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = tempfile.mkdtemp(prefix="ladle-ckpt-")
        os.makedirs(configured, exist_ok=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


# A write's shuffle files are removed when it ends, not when the driver happens
# to collect its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize(df, label: str = "table"):
    """Write ``df`` once as Parquet under the shared checkpoint directory and
    read it back: later readers get column pruning and no recomputation,
    and the lineage is cut (a lost executor re-reads files instead of
    re-running joins).  The shuffle files of the write go with its end.
    Returns the re-read DataFrame."""
    import uuid

    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/ladle-tables/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.mode("overwrite").parquet(path)
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.parquet(path)
