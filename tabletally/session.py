"""Session helpers: a local session for tests/bench and the checkpoint folder.

The library never creates a session on its own; callers pass one in. The
checkpoint folder is a shared one, named in ``spark.checkpoint.dir``; the
library never makes one up.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, checkpoint_dir: str | None = None
) -> SparkSession:
    """A local session with the settings the tests and the bench use; the caller names its checkpoint folder."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tabletally")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if checkpoint_dir:
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The reliable checkpoint folder: the SparkContext's current one, else ``spark.checkpoint.dir``.

    An unset folder is an error: a folder made up here could be local to one
    machine and would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - key absent
            configured = None
    if not configured:
        raise ValueError("spark.checkpoint.dir is not set; point it at a folder all executors share")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def kept(df: DataFrame) -> DataFrame:
    """``df`` computed once: checkpointed where the session names a folder, else held by the executors.

    Executors that are lost cost a re-read in the first case and a
    recomputation of their part in the second.
    """
    try:
        ensure_checkpoint_dir(df.sparkSession)
    except ValueError:
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    return df.checkpoint()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path that all executors share: in the checkpoint folder, else in the session's warehouse."""
    try:
        root = ensure_checkpoint_dir(spark)
    except ValueError:
        root = spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"
