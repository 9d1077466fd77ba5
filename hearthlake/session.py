"""Spark session settings the datasets rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every run needs: day and week boundaries are computed in UTC, bad
# casts / decimal overflows raise unless a function asks for try_cast
# explicitly, and hot keys are split.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # Split a hot key's partition also where an aggregate on the same key
    # follows the join without a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Execution settings: adaptive execution re-plans joins from measured shuffle
# sizes (a side becomes a broadcast only when its runtime size is below the
# threshold, otherwise the sort-merge plan stays), coalesces small shuffle
# partitions and splits skewed ones.
EXECUTION_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Delete checkpoint files once nothing references them (the forecast
    # writes one per step), so the shared folder does not fill up.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "hearthlake",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    On a cluster leave ``master`` unset and size ``shuffle_partitions`` to
    about input-bytes / 128 MB; AQE coalesces from there.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {**REQUIRED_CONF, **EXECUTION_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def let_workers_import(spark: SparkSession) -> None:
    """Put this package's folder on the Python workers' path, for sessions that were started
    without it there (workers see the same folder, or got the package with --py-files). A worker's
    matrix products run on one thread unless the session says otherwise: the cores have tasks."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    try:
        environment = spark.sparkContext.environment
    except Exception:  # no SparkContext in a Spark Connect session
        return
    environment.setdefault("OPENBLAS_NUM_THREADS", "1")
    parts = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in parts:
        environment["PYTHONPATH"] = os.pathsep.join([root, *parts])


def model_dir(spark: SparkSession | None) -> str:
    """Folder where registered queries keep fitted models: in the shared checkpoint folder where the
    session names one. A local session without one, and a caller without a session, get a fixed
    folder of this machine, so that another engine on it finds the stored nodes."""
    configured = spark.conf.get("spark.checkpoint.dir", None) if spark else None
    if configured:
        return f"{configured.rstrip('/')}/models"
    if spark and not spark.conf.get("spark.master", "local").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
    return os.path.join(tempfile.gettempdir(), "hearthlake-models")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for reliable checkpoints.

    Uses the folder the cluster names in ``spark.checkpoint.dir`` (or one set
    earlier with ``setCheckpointDir``). Only a local-mode session without any
    setting gets a fresh temporary folder; a cluster session without the
    setting is an error, since a machine-local folder would not survive the
    loss of an executor.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on the cluster file system)")
        configured = tempfile.mkdtemp(prefix="hearthlake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
