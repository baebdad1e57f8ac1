"""Session helpers: a local session for tests/bench and the checkpoint folder."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "cohortmine") -> SparkSession:
    """Session for tests and the bench (local mode, UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session config.

    The cluster names a shared folder in ``spark.checkpoint.dir``; that is always
    used when present. Only a local-mode session without one (tests, the bench)
    gets a fresh scratch folder; a cluster session without one is an error, since
    an executor-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        try:
            configured = spark.conf.get(CHECKPOINT_CONF)
        except Exception:  # not set in the SQL conf either
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set: name a shared folder visible to all executors"
            )
        configured = tempfile.mkdtemp(prefix="cohortmine-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` cached for the block. What the caller has cached already stays as it is."""
    level = df.storageLevel
    own = not (level.useMemory or level.useDisk)
    if own:
        df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        if own:
            df.unpersist()
