"""Session helpers.

The library never creates a session inside an operator; these helpers are for
tests, the bench and command-line use.  On a cluster the session comes from the
caller and carries ``spark.checkpoint.dir`` pointing at shared storage.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rarelab") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("RARELAB_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory, setting a scratch one only
    when none is configured and the master is local (tests); elsewhere a
    folder on one machine would lose rows, so that raises.  A cluster names a shared folder in
    ``spark.checkpoint.dir``; that setting always wins."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote session: the server owns the setting
        return configured or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    path = tempfile.mkdtemp(prefix="rarelab-ckpt-")
    sc.setCheckpointDir(path)
    return path


def expose_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it
    (one machine, or a folder that all see).  On other clusters it is shipped
    with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([root, *known])


def cut_lineage(df):
    """Materialise ``df`` into the session's (shared) checkpoint directory.

    Operators that read their input more than once (a count, a boundary
    sample, then the pass itself) or iterate call this first: the upstream
    plan runs once, later actions read the files, and the logical plan
    shrinks to a scan, so planning stays cheap.  A reliable checkpoint
    survives executor loss; a local one would not."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
