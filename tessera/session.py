"""Session setup and shared-storage helpers.

The engine never owns the cluster configuration: every helper reads what the
session already has and only fills in a value that is unset (local tests).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Settings the query semantics depend on. Time zone: FROM_UNIXTIME and
# timestamp casts follow the session zone, the oracle runs in UTC.
SEMANTIC_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timeType.enabled": "true",
}

# Settings for scale: runtime re-planning, skew splitting, partition coalescing.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Small-data setting for local runs: keep shuffle outputs of a few hundred
    # KB in several partitions, since several steps explode each row into its
    # prefixes after the shuffle. At cluster scale partitions are far larger
    # and this has no effect.
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256KB",
}


def build_session(master: str = "local[8]", app: str = "tessera",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench. On a cluster, pass your own
    session to the library functions instead; they only read its settings."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "16g")
         .config("spark.sql.warehouse.dir", os.path.join(_local_scratch_root(), "warehouse")))
    for k, v in {**SEMANTIC_CONF, **SCALE_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_semantics(spark)
    return spark


def apply_semantics(spark: SparkSession) -> None:
    """Pin the settings results depend on (safe to call on any session)."""
    for k, v in SEMANTIC_CONF.items():
        spark.conf.set(k, v)


_SCRATCH_ROOT: str | None = None


def _local_scratch_root() -> str:
    global _SCRATCH_ROOT
    if _SCRATCH_ROOT is None:
        _SCRATCH_ROOT = tempfile.mkdtemp(prefix="tessera-")
    return _SCRATCH_ROOT


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system). Only a local master may leave it unset; then a folder of our
    own is set. A cluster without one raises: its executors would each write to
    a disk of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not _is_local(sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = os.path.join(_local_scratch_root(), "checkpoints")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir()


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of ``df`` into the shared checkpoint folder.

    The Dataset is persisted for the duration of the checkpoint, so its plan
    runs once: the eager count fills the cache and the checkpoint files are
    written from it (without the cache the write would recompute the plan).
    The result reads from shared storage, so losing an executor afterwards
    costs nothing. Sizes of the result are unknown to the static planner;
    joins on it are chosen at runtime by adaptive execution from measured
    sizes, which is what the exploding steps downstream need.
    """
    checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()
