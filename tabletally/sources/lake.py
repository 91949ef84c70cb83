"""A directory of tables ("lake") as a catalog.

Listing the lake is a metadata call on the driver, one or two levels deep,
like ``SHOW DATABASES`` and ``SHOW TABLES``: its size is the number of
tables, not the data. Column types
come from each table's footers through Spark's own schema resolution, run for
several tables at once from a small thread pool.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..functions.columns import literal_path
from ..functions.errors import error_text
from ..functions.types import type_text
from .model import Source


@dataclass(frozen=True)
class LakeTable:
    database: str  # namespace: the source's, or the database folder's name
    name: str  # table name as the user sees it (decoded, suffix removed)
    path: str  # fully qualified path of the table's file or directory
    root: str  # that path's URI-encoded path part, as file paths show it


def _listing(spark: SparkSession, path: str):
    """``(name, raw path, qualified path, status)`` of the visible children of ``path``.

    Each attribute read is a round trip to the JVM, so only a few are made
    per entry: the name is decoded from the raw (URI-encoded) path, as
    Hadoop's ``getName`` would.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = []
    for status in fs.listStatus(p):
        child = status.getPath()
        raw = child.toUri().getRawPath()
        name = unquote(raw.rsplit("/", 1)[-1])
        if not name.startswith(("_", ".")):
            out.append((name, raw, child.toString(), status))
    return out


def list_lake_databases(spark: SparkSession, source: Source) -> list[tuple[str, str]]:
    """``(database, folder path)`` of a lake; one pair for a flat lake."""
    if source.layout == "flat":
        return [(source.database, source.path)]
    excluded = source.exclude_databases or ()
    found = []
    for name, _, path, status in _listing(spark, source.path):
        if not status.isDirectory():
            continue
        name = name[:-3] if name.endswith(".db") and len(name) > 3 else name
        if name not in excluded:
            found.append((name, path))
    return sorted(found)


def list_lake_tables(spark: SparkSession, source: Source) -> list[LakeTable]:
    """Tables of a file lake: child directories and ``*.<format>`` files.

    The ``.<format>`` suffix is not part of the table name, for files and
    folders alike. Names starting with ``_`` or ``.`` are skipped, as Spark
    skips them when it lists data files. The include/exclude lists of the
    source apply. One listing call per database folder.
    """
    suffix = "." + source.kind
    found = []
    for database, folder in list_lake_databases(spark, source):
        for entry_name, raw, path, status in _listing(spark, folder):
            if entry_name.endswith(suffix) and len(entry_name) > len(suffix):
                table = entry_name[: -len(suffix)]  # a file, or a folder written as "t.parquet"
            elif status.isDirectory():
                table = entry_name
            else:
                continue
            if source.keeps_lake_table(database, table):
                found.append(LakeTable(database, table, path, raw))
    return sorted(found, key=lambda t: (t.database, t.name))


def metadata_frame(spark: SparkSession, rows: list, schema: T.StructType) -> DataFrame:
    """A DataFrame of driver-held catalog rows.

    Made from an Arrow table, which Spark keeps as a local relation: the planner
    knows its size and no Python worker touches the rows.
    """
    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows, strict=True)) or [[] for _ in arrow]
    arrays = [pa.array(values, f.type) for values, f in zip(columns, arrow, strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=arrow), schema)


def tables_frame(spark: SparkSession, database: str | None, tables: list[LakeTable]) -> DataFrame:
    """``(database_name, table_name)``; ``database`` replaces the tables' own when given."""
    return metadata_frame(spark, [(database or t.database, t.name) for t in tables], schemas.TABLES)


def column_rows(
    spark: SparkSession, source: Source, tables: list[LakeTable], threads: int = 16
) -> tuple[list[tuple[str, str, int, str, str]], list[tuple[str, str, str, str]]]:
    """Column rows ``(database, table, pos, column, type)`` of the given tables.

    Returns the rows and the tables whose schema could not be read as
    ``(database, table, stage, message)``. A table's columns are those of all
    its files: Spark merges the footers in one job per table (in parallel over
    the files); ``threads`` tables run at once. Files whose types cannot be
    merged make the table an error row. Callers pass a bounded number of tables
    at a time (see ``lake_inventory.schema_maps``).
    """

    def one(t: LakeTable):
        try:
            schema = spark.read.format(source.kind).option("mergeSchema", "true").load(literal_path(t.path)).schema
        except AnalysisException as exc:
            if exc.getCondition() == "UNABLE_TO_INFER_SCHEMA":
                return t, T.StructType([]), None  # no data files yet: an empty table
            return t, None, error_text(exc)
        except Exception as exc:  # noqa: BLE001 - reported as an error row
            return t, None, error_text(exc)
        return t, schema, None

    rows, errors = [], []
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(tables)))) as pool:
        for t, schema, err in pool.map(one, tables):
            if err is not None:
                errors.append((t.database, t.name, "schema", err))
                continue
            for pos, f in enumerate(schema.fields, start=1):
                rows.append((t.database, t.name, pos, f.name, type_text(f.dataType)))
    return rows, errors
