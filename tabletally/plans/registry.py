"""Registry load: add the tables the registry does not know yet.

The registry is insert-only, as in the original job: a known key is never
updated, even when its row count or column map changed, and ``updated_at``
equals ``created_at`` (quirk Q10). Dates come from ``as_of`` so that runs
are reproducible; ``None`` means the session's current date.

Loads of different sources touch disjoint keys. Two loads of the *same*
source at the same time can both insert a key: Parquet and JDBC appends have
no unique check, so a unique index on the four keys belongs in the target
database when loads may overlap.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import as_of_date
from ..operators.insert_missing import missing_rows, refuse_null_keys, write_if_any
from ..session import kept
from ..sources.registry_store import RegistryTarget, append_registry, read_registry
from ..sources.retry import with_retry


def missing_entries(
    inventory: DataFrame,
    registry: DataFrame,
    as_of: dt.date | str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Inventory rows whose key the registry lacks, with audit dates.

    ``unique`` says that the inventory has one row per key, as every inventory
    built here has; rows of other origin are reduced to one per key first.
    """
    day = as_of_date(as_of)
    rows = inventory.select(*schemas.INVENTORY_COLUMNS)
    return missing_rows(rows, registry, schemas.KEYS, unique=unique).select(
        *schemas.KEYS,
        F.col("row_count").cast("bigint").alias("row_count"),
        F.col("table_schema").cast("string").alias("table_schema"),
        day.alias("created_at"),
        day.cast("date").alias("updated_at"),
    )


def registry_after_load(
    inventory: DataFrame, registry: DataFrame, as_of: dt.date | str | None = None, unique: bool = False
) -> DataFrame:
    """What the registry holds after a load: old rows unchanged plus the missing ones."""
    return registry.select(*schemas.REGISTRY_COLUMNS).unionByName(
        missing_entries(inventory, registry, as_of, unique)
    )


def load_registry(
    spark: SparkSession,
    inventory: DataFrame,
    target: RegistryTarget,
    as_of: dt.date | str | None = None,
    attempts: int = 3,
    delay_s: float = 5.0,
    unique: bool = False,
    sources: list[str] | None = None,
) -> int:
    """Append the missing entries to the registry; return how many.

    A second run with the same inventory adds nothing. ``sources`` (the names of
    the sources the inventory is of) limits the read of the registry to them.
    Inventory rows with a
    null key are refused before anything is written (they could never be
    matched again). Errors are raised, not printed.

    A failed attempt is retried as a whole (read, anti join, append): each
    attempt re-reads the registry, so rows a failed append did commit are
    not appended twice. Retrying only the write could duplicate them.
    """

    if target.buckets is not None:
        # a source's name and kind are constants, which the optimizer would take out of the join's keys;
        # the buckets only serve a join on all of them. One row per table is kept.
        inventory = kept(inventory.select(*schemas.INVENTORY_COLUMNS))
    refuse_null_keys(inventory, schemas.KEYS)

    def once() -> int:
        registry = read_registry(spark, target, sources)
        return write_if_any(missing_entries(inventory, registry, as_of, unique), lambda df: append_registry(df, target))

    return with_retry(once, attempts=attempts, delay_s=delay_s)
