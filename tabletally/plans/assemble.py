"""Assembly of inventory rows from one entry per table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.pairs_json import pairs_to_json
from ..sources.lake import metadata_frame
from ..sources.model import Source

TABLE_KEY = ["database_name", "table_name"]


@dataclass
class Inventory:
    rows: DataFrame  # schemas.INVENTORY
    errors: DataFrame  # schemas.ERRORS


def table_schema_json(columns: DataFrame) -> DataFrame:
    """``(database_name, table_name, table_schema)`` from column rows, in ``pos`` order."""
    return pairs_to_json(columns, TABLE_KEY, "column_name", "data_type", "pos", "table_schema")


def inventory_rows(source: Source, entries: DataFrame) -> DataFrame:
    """Inventory rows of entries (``schemas.ENTRIES``, one per listed table)."""
    return entries.select(
        F.lit(source.name).alias("source_name"), F.lit(source.kind).alias("database_type"), *schemas.ENTRIES.names
    )


def build_inventory(
    spark: SparkSession, source: Source, entries: list[tuple[str, str, int, str]]
) -> DataFrame:
    """Inventory rows of driver-held ``(database, table, row count, JSON map)`` entries, as a local relation."""
    return inventory_rows(source, metadata_frame(spark, entries, schemas.ENTRIES))


def errors_frame(spark: SparkSession, source: Source, rows) -> DataFrame:
    return metadata_frame(spark, [(source.name, *row) for row in rows], schemas.ERRORS)
