"""Where the registry lives: a Parquet folder, plain or in buckets, or a JDBC table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from . import jdbc
from .bucketed import BucketedRegistry
from .model import Source


@dataclass(frozen=True)
class RegistryTarget:
    """Exactly one of ``path`` (Parquet folder) or ``source``+``table`` (JDBC).

    ``buckets`` keeps the folder in that many buckets of the key (see
    ``bucketed``); it must stay the same for the life of the registry.
    """

    path: str | None = None
    buckets: int | None = None
    source: Source | None = None
    database: str | None = None
    table: str | None = None

    def __post_init__(self) -> None:
        if (self.path is None) == (self.source is None):
            raise ValueError("give either a path or a JDBC source for the registry")
        if self.source is not None and not self.table:
            raise ValueError("a JDBC registry needs a table name")
        if self.buckets is not None and (self.path is None or self.buckets < 1):
            raise ValueError("only a registry in a folder has buckets, at least one")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p)


def read_registry(spark: SparkSession, target: RegistryTarget, sources: list[str] | None = None) -> DataFrame:
    """The registry with its fixed schema; an absent registry reads as empty.

    ``sources`` limits the read to those source names: a filter that Parquet
    answers from its statistics, and one read per source on a server.
    """
    if target.buckets is not None:
        df = BucketedRegistry(target.path, target.buckets).attach(spark)
        return df if sources is None else df.where(df["source_name"].isin(list(sources)))
    if target.path is not None:
        if not path_exists(spark, target.path):
            return spark.createDataFrame([], schemas.REGISTRY)
        df = spark.read.schema(schemas.REGISTRY).parquet(target.path)
        return df if sources is None else df.where(df["source_name"].isin(list(sources)))
    predicates = sources and [f"source_name = {jdbc.sql_literal(s)}" for s in sorted(set(sources))]
    df = jdbc.read_table(spark, target.source, target.database, target.table, predicates=predicates)
    df = df.toDF(*[c.lower() for c in df.columns])
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schemas.REGISTRY])


def append_registry(df: DataFrame, target: RegistryTarget, max_connections: int = 8) -> None:
    """Append rows; a JDBC registry gets at most ``max_connections`` inserting tasks."""
    if target.buckets is not None:
        BucketedRegistry(target.path, target.buckets).append(df)
    elif target.path is not None:
        df.write.mode("append").parquet(target.path)
    else:
        jdbc.write_table(
            df, target.source, target.database, target.table, mode="append", max_connections=max_connections
        )
