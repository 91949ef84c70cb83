"""Registry sync: inventory only the tables the registry does not know yet.

The registry is insert-only, so counts and column maps of known tables are
never used. ``sync_registry`` therefore compares the *listing* (catalog
metadata, cheap) with the registry keys first, and counts rows and reads
footers only for the tables that are new. On an unchanged lake the run
lists folders, reads the registry keys and scans nothing else. The result is
the same as ``load_registry(inventory_all(...))``.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .. import schemas
from ..functions.errors import error_text
from ..operators.insert_missing import known_keys
from ..sources import lake
from ..sources.model import Source
from ..sources.registry_store import RegistryTarget, read_registry
from ..sources.retry import with_retry
from .inventory import Inventory, inventory_all, jdbc_table_keys
from .registry import load_registry

KEYS_SCHEMA = T.StructType(schemas.INVENTORY.fields[: len(schemas.KEYS)])


@dataclass
class SyncReport:
    listed: int  # tables found in the sources
    inventoried: int  # tables counted and described (not yet registered)
    inserted: int  # rows appended to the registry
    errors: DataFrame  # schemas.ERRORS


def _listed_rows(
    spark: SparkSession, sources: list[Source], robust: bool = False, parallel_sources: int = 4
) -> tuple[list[tuple[str, str, str, str]], list[tuple]]:
    """Keys of every listed table, and (with ``robust``) error rows of sources that failed."""

    def one(s: Source):
        try:
            if s.is_files:
                return [(s.name, s.kind, t.database, t.name) for t in lake.list_lake_tables(spark, s)], []
            return [(s.name, s.kind, db, t) for db, t in jdbc_table_keys(spark, s)], []
        except Exception as exc:  # noqa: BLE001 - with robust, one source must not stop the rest
            if not robust:
                raise
            return [], [(s.name, None, None, "listing", error_text(exc))]

    if not sources:
        return [], []
    rows, errors = [], []
    with ThreadPoolExecutor(max_workers=max(1, min(parallel_sources, len(sources)))) as pool:
        for r, e in pool.map(one, sources):
            rows += r
            errors += e
    return rows, errors


def listed_keys(spark: SparkSession, sources: list[Source]) -> DataFrame:
    """The four registry keys of every table the sources list (no counting)."""
    return lake.metadata_frame(spark, _listed_rows(spark, sources)[0], KEYS_SCHEMA)


def sync_registry(
    spark: SparkSession,
    sources: list[Source],
    target: RegistryTarget,
    as_of: dt.date | str | None = None,
    robust: bool = True,
    attempts: int = 3,
    delay_s: float = 5.0,
) -> SyncReport:
    """List every source, keep the keys the registry lacks, inventory and append those."""
    rows, listing_errors = _listed_rows(spark, sources, robust)
    listing_errors_df = lake.metadata_frame(spark, listing_errors, schemas.ERRORS)
    listed = lake.metadata_frame(spark, rows, KEYS_SCHEMA)
    names = sorted({s.name for s in sources})
    # the listing is a local relation of known size: the registry is narrowed to it map-side
    def unknown() -> list[tuple]:
        known = known_keys(read_registry(spark, target, names), schemas.KEYS, listed)
        return [tuple(r) for r in listed.join(known, schemas.KEYS, "left_anti").collect()]  # at most the listing

    new = with_retry(unknown, attempts=attempts, delay_s=delay_s)
    if not new:
        return SyncReport(len(rows), 0, 0, listing_errors_df)
    todo: dict[str, set[tuple[str, str]]] = {}
    for name, _, database, table in new:
        todo.setdefault(name, set()).add((database, table))
    inv = inventory_all(spark, [s for s in sources if s.name in todo], robust=robust, only=todo)
    errors = inv.errors.unionByName(_unaccounted(spark, new, inv))
    inserted = load_registry(
        spark, inv.rows, target, as_of, attempts=attempts, delay_s=delay_s, unique=True, sources=names
    )
    return SyncReport(len(rows), len(new), inserted, listing_errors_df.unionByName(errors))


def _unaccounted(spark: SparkSession, new: list[tuple], inv: Inventory) -> DataFrame:
    """Error rows for tables that are neither in the inventory nor among its errors.

    There should be none; a table must never be lost without a word. An error
    of a whole source or database accounts for all its tables.
    """
    found = {tuple(r) for r in inv.rows.select(*schemas.KEYS).collect()}  # one row per new table
    failed = {(r["source_name"], r["database_name"], r["table_name"]) for r in inv.errors.collect()}

    def reported(name: str, database: str, table: str) -> bool:
        return any(f in failed for f in ((name, None, None), (name, database, None), (name, database, table)))

    lost = [
        (name, database, table, "inventory", "listed, but neither inventoried nor reported")
        for name, kind, database, table in new
        if (name, kind, database, table) not in found and not reported(name, database, table)
    ]
    return lake.metadata_frame(spark, lost, schemas.ERRORS)
