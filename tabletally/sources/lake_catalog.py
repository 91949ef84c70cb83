"""Lake listings made by tasks: folders as rows, and the catalog as a data source.

``list_levels`` lists a tree of folders level by level; the folders of a level
are rows that tasks list in parallel, so a lake of many databases is not walked
by the driver. ``LakeCatalog`` is a Python data source of ``(database_name,
table_name, path)`` with one partition per database folder; filters on the two
names reach the listing, so only the wanted folders are opened.

Both need a store that Arrow can open; elsewhere the callers use the driver's
listing (``lake.list_lake_tables``), which gives the same tables.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull

from .. import schemas
from ..session import kept
from . import lake
from .model import Source
from .stores import can_open, children, qualified_uri

cloudpickle.register_pickle_by_value(sys.modules["tabletally"])

ENTRY = "parent string, name string, uri string, is_folder boolean"
CATALOG = "database_name string, table_name string, path string"
FOLDERS_IN_TASK = 16


def _list_folders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folder URIs -> a row per visible child."""
    for batch in batches:
        for uri in batch.column(0).to_pylist():
            found = children(uri)
            if found:
                name, child, is_folder = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([uri] * len(found)), pa.array(name), pa.array(child), pa.array(is_folder, pa.bool_())],
                    names=["parent", "name", "uri", "is_folder"],
                )


def list_levels(spark: SparkSession, root: str, levels: int) -> DataFrame:
    """The entries ``levels`` below the folder ``root``: ``parent, name, uri, is_folder``; one job per level."""
    here = spark.createDataFrame([(qualified_uri(spark, root),)], "uri string")
    entries = here
    for level in range(levels):
        if level:
            here = entries.where("is_folder").select("uri")
            n = here.count()
            here = here.repartition(max(1, -(-n // FOLDERS_IN_TASK)))
        entries = kept(here.select("uri").mapInArrow(_list_folders, ENTRY))
    return entries


def table_name_of(entry: str, is_folder: bool, suffix: str) -> str | None:
    """The table an entry of a database folder is, if it is one."""
    if entry.endswith(suffix) and len(entry) > len(suffix):
        return entry[: -len(suffix)]
    return entry if is_folder else None


def list_tables(spark: SparkSession, source: Source) -> DataFrame:
    """``(database_name, table_name)`` of a lake, listed by tasks; equals ``plans.catalog.list_tables``."""
    if not can_open(qualified_uri(spark, source.path)):
        return lake.tables_frame(spark, None, lake.list_lake_tables(spark, source))
    flat = source.layout == "flat"
    entries = list_levels(spark, source.path, 1 if flat else 2)
    suffix = "." + source.kind
    has_suffix = F.col("name").endswith(suffix) & (F.length("name") > len(suffix))
    name = F.when(has_suffix, F.expr(f"left(name, length(name) - {len(suffix)})")).when(F.col("is_folder"), F.col("name"))
    if flat:
        database = F.lit(source.database)
    else:
        folder = F.url_decode(F.replace(F.substring_index("parent", "/", -1), F.lit("+"), F.lit("%2B")))
        database = F.when(folder.endswith(".db") & (F.length(folder) > 3), F.regexp_replace(folder, r"\.db$", "")).otherwise(folder)
    rows = entries.select(database.alias("database_name"), name.alias("table_name")).where("table_name IS NOT NULL")
    if source.include_tables is not None:
        rows = rows.where(F.col("table_name").isin(list(source.include_tables)))
    if source.exclude_tables:
        rows = rows.where(~F.col("table_name").isin(list(source.exclude_tables)))
    if source.exclude_databases and not flat:
        rows = rows.where(~F.col("database_name").isin(list(source.exclude_databases)))
    return rows


class LakeCatalog(DataSource):
    """``spark.read.format("lake_catalog").options(path=uri, kind="parquet", layout=..., database=...)``"""

    @classmethod
    def name(cls) -> str:
        return "lake_catalog"

    def schema(self) -> str:
        return CATALOG

    def reader(self, schema) -> CatalogReader:
        # Spark refuses a reader that takes filters where the session does not push them
        pushes = self.options.get("pushdown") == "true"
        return (FilteredReader if pushes else CatalogReader)(dict(self.options))


class Folder(InputPartition):
    def __init__(self, database: str, uri: str):
        super().__init__((database, uri))


class CatalogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.uri, self.suffix = options["path"], "." + options.get("kind", "parquet")
        self.flat, self.database = options.get("layout", "flat") == "flat", options.get("database", "main")
        self.wanted: dict[str, set[str]] = {}  # column -> the names a filter leaves

    def partitions(self) -> list[Folder]:
        if self.flat:
            folders = [(self.database, self.uri)]
        else:
            folders = [(n[:-3] if n.endswith(".db") and len(n) > 3 else n, uri) for n, uri, is_folder in children(self.uri) if is_folder]
        wanted = self.wanted.get("database_name")
        # no partition at all is not allowed: an empty folder name reads nothing
        return [Folder(d, uri) for d, uri in folders if wanted is None or d in wanted] or [Folder("", "")]

    def read(self, partition: Folder) -> Iterator[tuple[str, str, str]]:
        database, uri = partition.value
        if not uri:
            return
        wanted = self.wanted.get("table_name")
        for name, child, is_folder in children(uri):
            table = table_name_of(name, is_folder, self.suffix)
            if table is not None and (wanted is None or table in wanted):
                yield database, table, child


class FilteredReader(CatalogReader):
    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Takes equality and membership of the two names; Spark applies the others."""
        for f in filters:
            column = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if isinstance(f, IsNotNull) and f.attribute in (("database_name",), ("table_name",)):
                continue  # names are never null
            if column in ("database_name", "table_name"):
                names = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.wanted[column] = self.wanted.get(column, names) & names
            else:
                yield f


def catalog(spark: SparkSession, source: Source) -> DataFrame:
    """The lake's catalog as a data source: ``database_name, table_name, path``, before the source's name lists.

    With ``spark.sql.python.filterPushdown.enabled`` filters reach the listing;
    without it Spark applies them to the rows.
    """
    uri = qualified_uri(spark, source.path)
    if not can_open(uri):
        tables = lake.list_lake_tables(spark, Source(source.name, source.kind, path=source.path, database=source.database, layout=source.layout))
        rows = [(t.root, t.database, t.name) for t in tables]
        return lake.metadata_frame(spark, rows, schemas.ROOTS).select("database_name", "table_name", F.col("root").alias("path"))
    spark.dataSource.register(LakeCatalog)
    pushes = spark.conf.get("spark.sql.python.filterPushdown.enabled", "false")
    options = {"path": uri, "kind": source.kind, "layout": source.layout, "database": source.database, "pushdown": pushes}
    return spark.read.format("lake_catalog").options(**options).load()
