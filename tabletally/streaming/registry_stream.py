"""The registry load as an incremental job over inventory snapshots.

The original runs once a day and loads what is new. Here each inventory
snapshot written under a folder is one input file of a file stream; every
micro-batch goes through the same insert-if-absent load. A replayed batch
(after a failure) inserts nothing twice, because the load only adds keys the
registry does not have. ``availableNow`` processes what is there and stops,
which is how a scheduled run uses it.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..plans.registry import load_registry
from ..session import ensure_checkpoint_dir
from ..sources.registry_store import RegistryTarget


def start_registry_stream(
    spark: SparkSession,
    snapshots_path: str,
    target: RegistryTarget,
    checkpoint_location: str | None = None,
    as_of: dt.date | str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start loading inventory snapshots (Parquet, inventory schema) into the registry."""
    if checkpoint_location is None:
        # one offset log per (snapshots, registry) pair: two streams must never share one
        where = target.path or f"{target.source.name}/{target.database}/{target.table}"
        tag = hashlib.sha1(f"{snapshots_path}|{where}".encode()).hexdigest()[:16]
        checkpoint_location = f"{ensure_checkpoint_dir(spark).rstrip('/')}/registry-stream-{tag}"

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        load_registry(batch.sparkSession, batch, target, as_of)

    writer = (
        spark.readStream.schema(schemas.INVENTORY)
        .parquet(snapshots_path)
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
