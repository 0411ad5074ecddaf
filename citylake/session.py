"""Session construction and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on. Cluster-provided values win: we only fill gaps.
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",          # NTZ <-> timestamp casts are identity
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply library defaults that were not set explicitly by the cluster or user."""
    conf = spark.conf
    for k, v in _DEFAULTS.items():
        if k == "spark.sql.session.timeZone":
            conf.set(k, v)  # the time functions assume a UTC session zone
            continue
        try:
            cur = conf.get(k, None)
        except Exception:  # pragma: no cover - unknown key on old Spark
            cur = None
        if cur is None:
            conf.set(k, v)
    return spark


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "citylake") -> SparkSession:
    """A local session for tests and benchmarks (no UI, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("CITYLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", "32m")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared file system folder and is
    used as is. Only a local session (tests, benchmarks) gets a fresh temporary
    folder; a cluster session without the setting is an error.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        existing = sc.getCheckpointDir()
        if existing:
            return existing
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="citylake-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root
