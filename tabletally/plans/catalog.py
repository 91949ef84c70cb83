"""Databases and tables of a source, as DataFrames.

JDBC catalog reads stay lazy: each is one small query per database, with
the exclusions in its SQL text; the union runs when the caller acts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.names import distinct_names
from ..sources import jdbc, lake
from ..sources.model import Source
from ..sources.retry import with_retry
from .jdbc_inventory import _database_column, _jdbc_databases, catalog_tables


def list_databases(spark: SparkSession, source: Source) -> DataFrame:
    """``database_name`` of every database (owner, for Oracle) the source lists."""
    if source.is_files:
        names = [(db,) for db, _ in lake.list_lake_databases(spark, source)]
        return spark.createDataFrame(names, "database_name string")
    d = jdbc.dialect(source)
    # reading the schema already calls the server
    names = with_retry(lambda: jdbc.read_query(spark, source, None, d.databases_sql(source)))
    return distinct_names(names, "database_name", jdbc.excluded_databases(source, d.excluded_databases))


def list_tables(spark: SparkSession, source: Source) -> DataFrame:
    """``(database_name, table_name)`` of every table, after the exclusion lists."""
    if source.is_files:
        return lake.tables_frame(spark, None, lake.list_lake_tables(spark, source))
    d = jdbc.dialect(source)
    parts = [
        catalog_tables(spark, source, d, database).select(
            _database_column(d, database).alias("database_name"), F.col("table_name").cast("string")
        )
        for database in _jdbc_databases(spark, source, d)
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], schemas.TABLES)
