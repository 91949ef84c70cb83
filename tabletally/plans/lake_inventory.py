"""Inventory of file lakes: one listing and one footer pass per folder.

Parquet tables are counted and described by ``lake_footers``: one job for all
tables, its result a row per table that stays with the executors and is joined
with the listing as a DataFrame. What that pass cannot settle (ORC tables,
files that Arrow cannot read, nested types that differ between files) goes
through Spark's own readers: a count scan over all such tables and a schema
resolution per table.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import literal_path
from ..functions.errors import error_text
from ..functions.types import type_text
from ..operators.counts import ABSENT, count_by_halves, count_lake_rows
from ..session import kept
from ..sources import lake
from ..sources.footers import lake_footers
from ..sources.model import Source
from .assemble import TABLE_KEY, Inventory, errors_frame, inventory_rows, table_schema_json


#: Tables whose column rows are held at once by the pass that needs a job per table.
TABLES_AT_ONCE = 256


@dataclass
class _LakeFacts:
    """What one pass over a lake root yields, before sources split it."""

    tables: list[lake.LakeTable]
    entries: DataFrame  # schemas.ENTRIES, one row per table that could be read
    failed: list[tuple[str, str, str, str]]  # database, table, stage, message


def schema_maps(
    spark: SparkSession, source: Source, tables: list[lake.LakeTable]
) -> tuple[dict[tuple[str, str], str], list[tuple[str, str, str, str]]]:
    """The JSON column map of every table by Spark's own schema resolution, and error rows.

    Column rows of ``TABLES_AT_ONCE`` tables are folded to one JSON row per
    table before the next tables are read, so the driver holds one row per
    table, never the columns of a whole lake.
    """
    maps, errors = {}, []
    for start in range(0, len(tables), TABLES_AT_ONCE):
        rows, failed = lake.column_rows(spark, source, tables[start : start + TABLES_AT_ONCE])
        errors += failed
        folded = table_schema_json(lake.metadata_frame(spark, rows, schemas.COLUMNS))
        maps |= {(r["database_name"], r["table_name"]): r["table_schema"] for r in folded.collect()}
    return maps, errors


def _by_spark(
    spark: SparkSession, root: Source, tables: list[lake.LakeTable], robust: bool
) -> tuple[list[tuple[str, str, int, str]], list[tuple[str, str, str, str]]]:
    """Entries and error rows of tables through Spark's own readers."""
    maps, errors = schema_maps(spark, root, tables)
    _raise_first(root, errors, robust)
    # A table whose footers could not be read is known bad: keep it out of
    # the shared scan rather than let it fail the scan for everyone.
    unreadable = {(db, t) for db, t, _, _ in errors}
    readable = [t for t in tables if (t.database, t.name) not in unreadable]
    if robust:
        rows, count_errors = count_by_halves(spark, readable, None, root.kind)
        errors += count_errors
    else:
        rows = count_lake_rows(spark, readable, None, root.kind).collect()
    return [(db, t, n, maps.get((db, t), "{}")) for db, t, n in rows], errors


def _raise_first(root: Source, errors: list[tuple[str, str, str, str]], robust: bool) -> None:
    if errors and not robust:
        database, table, stage, message = errors[0]
        raise RuntimeError(f"{root.name}: {database}.{table} ({stage}): {message}")


def _with_folder_columns(spark: SparkSession, t: lake.LakeTable, table_schema: str) -> str:
    """The JSON map with the columns of ``key=value`` folders, whose types Spark infers from a listing.

    As in Spark's own schema, such a column replaces a data column of its name
    and comes last otherwise.
    """
    columns = json.loads(table_schema)
    places = {c.lower(): c for c in columns}
    found = spark.read.schema(ABSENT).parquet(literal_path(t.path)).schema
    for f in found.fields[len(ABSENT) :]:
        columns[places.get(f.name.lower(), f.name)] = type_text(f.dataType)
    return json.dumps(columns, ensure_ascii=False, separators=(",", ":"))


def _lake_facts(spark: SparkSession, root: Source, keep, robust: bool) -> _LakeFacts:
    """List, read footers and count a lake root once, for the tables ``keep`` accepts.

    Without ``robust`` the first failure is raised; with it failing tables are
    reported and the others stay. A table with a column whose files' types have
    no common one is reported, too: an insert-only registry would keep a
    column map without that type for good.
    """
    unfiltered = replace(root, include_tables=None, exclude_tables=(), exclude_databases=None)
    tables = [t for t in lake.list_lake_tables(spark, unfiltered) if keep(t)]
    if root.kind != "parquet" or not tables:
        entries, errors = _by_spark(spark, root, tables, robust)
        return _LakeFacts(tables, lake.metadata_frame(spark, entries, schemas.ENTRIES), errors)
    nested = F.exists("conflicts", lambda c: c.rlike(r": .*(array|map|struct)<"))
    unusual = (F.col("unread") > 0) | F.col("partitioned") | (F.size("conflicts") > 0)
    try:
        facts = kept(lake_footers(spark, tables))
        rows = facts.where(unusual).withColumn("nested", nested).collect()  # at most one per table
    except AnalysisException:  # a folder went between listing and reading
        if not robust:
            raise
        entries, errors = _by_spark(spark, root, tables, robust)
        return _LakeFacts(tables, lake.metadata_frame(spark, entries, schemas.ENTRIES), errors)
    by_key = {(t.database, t.name): t for t in tables}
    left, entries, errors = [], [], []
    for r in rows:
        t = by_key[r["database_name"], r["table_name"]]
        if r["unread"] or r["nested"]:
            left.append(t)
            continue
        if r["conflicts"]:
            message = "files' types have no common one: " + "; ".join(r["conflicts"])
            errors.append((t.database, t.name, "schema", message))
            continue
        schema = _with_folder_columns(spark, t, r["table_schema"]) if r["partitioned"] else r["table_schema"]
        entries.append((t.database, t.name, r["row_count"], schema))
    _raise_first(root, errors, robust)
    if left:
        more, failed = _by_spark(spark, root, left, robust)
        entries, errors = entries + more, errors + failed
    usual = facts.where(~unusual).select(*schemas.ENTRIES.names)
    if not rows:
        return _LakeFacts(tables, usual, errors)
    return _LakeFacts(tables, usual.unionByName(lake.metadata_frame(spark, entries, schemas.ENTRIES)), errors)


def keeps(source: Source, t: lake.LakeTable, only: set[tuple[str, str]] | None = None) -> bool:
    """Whether ``source`` wants a table listed for it or for another source on the same root.

    A flat lake's namespace is the source's own, whichever source listed it.
    """
    database = source.database if source.layout == "flat" else t.database
    return source.keeps_lake_table(database, t.name) and (only is None or (database, t.name) in only)


def _lake_rows(
    spark: SparkSession, source: Source, facts: _LakeFacts, only: set[tuple[str, str]] | None = None
) -> Inventory:
    mine = [(t.database, t.name) for t in facts.tables if keeps(source, t, only)]
    entries = facts.entries
    if len(mine) < len(facts.tables):
        # the listing is a local relation of known size: the planner picks the join
        entries = entries.join(lake.metadata_frame(spark, mine, schemas.TABLES), TABLE_KEY, "left_semi")
    # A flat lake has one namespace, named by the source; with database
    # folders the namespace is the folder's.
    flat = source.layout == "flat"
    if flat:
        entries = entries.withColumn("database_name", F.lit(source.database))
    keys = set(mine)
    errors = [
        (source.database if flat else d, t, st, m) for d, t, st, m in facts.failed if (d, t) in keys
    ]
    return Inventory(inventory_rows(source, entries), errors_frame(spark, source, errors))


def lake_inventory(spark: SparkSession, source: Source, robust: bool = False) -> Inventory:
    """Inventory of a file lake.

    Without ``robust`` a table that cannot be read raises. With it failing
    tables are reported in ``errors`` and left out of ``rows`` instead of
    failing the whole source (quirk Q2).
    """
    return _lake_rows(spark, source, _lake_facts(spark, source, lambda t: keeps(source, t), robust))
