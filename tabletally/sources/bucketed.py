"""A registry bucketed by its key, joined without shuffling it.

The registry is a Parquet table ``CLUSTERED BY`` the four key columns. Spark
reads its buckets as hash partitions, so the anti join of a batch shuffles the
batch alone: the registry, which only grows, never moves. The bucket layout
lives in the session's catalog; another session attaches it again with the same
path and number of buckets.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import schemas


@dataclass(frozen=True)
class BucketedRegistry:
    """Where the registry lies and in how many buckets (fixed when it is first written)."""

    path: str
    buckets: int = 64

    @property
    def table(self) -> str:
        tag = hashlib.sha1(f"{self.path}|{self.buckets}".encode()).hexdigest()[:16]
        return f"registry_bucketed_{tag}"

    def attach(self, spark: SparkSession) -> DataFrame:
        """The registry as a table of this session; an absent folder is an empty registry."""
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.REGISTRY)
        keys = ", ".join(f"`{k}`" for k in schemas.KEYS)
        place = self.path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}) USING PARQUET "
            f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{place}'"
        )
        return spark.table(self.table)

    def append(self, df: DataFrame) -> None:
        """Append rows of the registry's schema, dealt to their buckets before the write: one file a bucket."""
        self.attach(df.sparkSession)
        rows = df.select(*schemas.REGISTRY_COLUMNS).repartition(self.buckets, *schemas.KEYS)
        writer = rows.write.format("parquet").mode("append").bucketBy(self.buckets, *schemas.KEYS).sortBy(*schemas.KEYS)
        writer.option("path", self.path).saveAsTable(self.table)
        df.sparkSession.catalog.refreshTable(self.table)
