"""Spark session and lineage helpers.

The library never builds its own cluster settings into operators; it only
reads what the session provides.  ``get_session`` is for local runs (tests,
bench, examples); on a cluster the caller's session is used as is.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_CHECKPOINT_FALLBACK: str | None = None


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app_name: str = "routecov", extra_conf: dict[str, str] | None = None) -> SparkSession:
    """Local session with AQE on, UI off and UTC time (oracle comparisons)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in (extra_conf or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", os.environ.get("ROUTECOV_DRIVER_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS/S3/...)
    and is used unchanged.  A machine-local temporary folder is created only
    for a ``local[...]`` master, i.e. tests and single-node runs.
    """
    global _LOCAL_CHECKPOINT_FALLBACK
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - e.g. a remote (Connect) session: server-side config applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster")
    if _LOCAL_CHECKPOINT_FALLBACK is None:
        _LOCAL_CHECKPOINT_FALLBACK = tempfile.mkdtemp(prefix="routecov-ckpt-")
    sc.setCheckpointDir(_LOCAL_CHECKPOINT_FALLBACK)
    return sc.getCheckpointDir()


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did.

    Enough where executors see that folder (local runs, a shared install); on
    other clusters ship the package with ``--py-files``."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder (survives executor
    loss).  With ``eager=False`` the next action on the result computes it and
    Spark writes the checkpoint right after that action."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables, inside the reliable checkpoint
    folder (shared storage on a cluster, never a machine-local temp dir)."""
    import uuid
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/scratch/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own intermediate tables, in any store Spark reads."""
    if f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/" not in path:
        raise ValueError(f"not a scratch folder: {path}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
