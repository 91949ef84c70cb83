"""Inventory of JDBC servers: catalog queries per database, one count query per group of tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.errors import error_text
from ..operators.names import catalog_names
from ..sources import jdbc
from ..sources.model import Source
from ..sources.retry import with_retry
from .assemble import Inventory, build_inventory, errors_frame, table_schema_json


def _database_column(d: jdbc.Dialect, database: str):
    """``database_name`` from a catalog row's ``schema_name``, as ``qualified_database``."""
    schema = F.col("schema_name")
    if d.kind == "oracle":
        return schema.cast("string")
    return (
        F.when(schema.isNull() | (schema == F.lit(d.default_schema)), F.lit(database))
        .otherwise(F.concat(F.lit(database + "."), schema))
    )


def _jdbc_databases(spark: SparkSession, source: Source, d: jdbc.Dialect) -> list[str]:
    if d.kind == "oracle":
        return [d.default_database]
    listed = with_retry(
        lambda: jdbc.read_query(spark, source, None, d.databases_sql(source)).collect()
    )
    return [r["database_name"] for r in listed]


def catalog_tables(
    spark: SparkSession, source: Source, d: jdbc.Dialect, database: str
) -> DataFrame:
    """``(schema_name, table_name)`` of one database after the exclusion lists."""
    rows = jdbc.read_query(spark, source, database, d.tables_sql(source))
    dropped = (*d.excluded_tables, *source.exclude_tables)
    return catalog_names(rows, "table_name", exclude=dropped, include=source.include_tables)


def _jdbc_tables(
    spark: SparkSession,
    source: Source,
    d: jdbc.Dialect,
    database: str,
    only: set[tuple[str, str]] | None = None,
) -> list[tuple[str, str]]:
    """``(schema, table)`` pairs of one database, collected."""
    rows = with_retry(lambda: catalog_tables(spark, source, d, database).collect())
    return [
        (r["schema_name"], r["table_name"])
        for r in rows
        if only is None or (jdbc.qualified_database(d, database, r["schema_name"]), r["table_name"]) in only
    ]


def jdbc_table_keys(spark: SparkSession, source: Source, threads: int = 8) -> list[tuple[str, str]]:
    """``(database_name, table_name)`` of every table, from catalog queries only."""
    d = jdbc.dialect(source)

    def tables_of(database: str):
        return [
            (jdbc.qualified_database(d, database, s), t)
            for s, t in _jdbc_tables(spark, source, d, database)
        ]

    databases = _jdbc_databases(spark, source, d)
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(databases)))) as pool:
        return [k for keys in pool.map(tables_of, databases) for k in keys]


def _jdbc_counts(
    spark: SparkSession,
    source: Source,
    d: jdbc.Dialect,
    work: list[tuple[str, list[tuple[str, str]]]],
    robust: bool,
    tables_per_query: int,
    max_connections: int,
) -> tuple[dict[tuple[str, str], int], list[tuple[str, str, str, str]]]:
    """Row counts by (database name, table) and error rows, for ``(database, (schema, table) pairs)``.

    Each group of ``tables_per_query`` tables is one query, retried as a whole;
    ``max_connections`` run at once. A group that still fails is halved until
    the failing tables stand alone; without ``robust`` the failure is raised.
    """

    def count(database: str, group: list[tuple[str, str]]) -> tuple[dict, list]:
        try:
            numbers = with_retry(lambda: jdbc.count_tables(spark, source, database, group))
            return {
                (jdbc.qualified_database(d, database, s), t): n for (s, t), n in zip(group, numbers, strict=True)
            }, []
        except Exception as exc:  # noqa: BLE001 - halved, then reported as an error row
            if not robust:
                raise
            if len(group) == 1:
                schema, table = group[0]
                return {}, [(jdbc.qualified_database(d, database, schema), table, "count", error_text(exc))]
        halves = [count(database, group[: len(group) // 2]), count(database, group[len(group) // 2 :])]
        return halves[0][0] | halves[1][0], halves[0][1] + halves[1][1]

    groups = [
        (database, pairs[i : i + tables_per_query])
        for database, pairs in work
        for i in range(0, len(pairs), tables_per_query)
    ]
    counts, errors = {}, []
    with ThreadPoolExecutor(max_workers=max(1, min(max_connections, len(groups)))) as pool:
        for found, failed in pool.map(lambda g: count(*g), groups):
            counts |= found
            errors += failed
    return counts, errors


def jdbc_inventory(
    spark: SparkSession,
    source: Source,
    robust: bool = False,
    threads: int = 8,
    only: set[tuple[str, str]] | None = None,
    tables_per_query: int = 50,
    max_connections: int = 8,
) -> Inventory:
    """Inventory of a JDBC server: per database one table query, one column
    query for all tables, and row counts as one query per group of tables.

    Every read is retried around its action. With ``robust`` a database or
    table that fails goes to ``errors`` and the others stay; without it the
    failure is raised. ``only`` limits the work to the given ``(database_name,
    table_name)`` keys. ``max_connections`` bounds the counts running on the
    server at once.
    """
    d = jdbc.dialect(source)
    databases = _jdbc_databases(spark, source, d)

    def maps(database: str) -> dict[tuple[str, str], str]:
        columns = jdbc.read_query(spark, source, database, d.columns_sql(source)).select(
            _database_column(d, database).alias("database_name"),
            F.col("table_name").cast("string"),
            F.col("pos").cast("int"),
            F.col("column_name").cast("string"),
            F.col("data_type").cast("string"),
        )
        return {(r["database_name"], r["table_name"]): r["table_schema"] for r in table_schema_json(columns).collect()}

    def catalog(database: str):
        try:
            pairs = _jdbc_tables(spark, source, d, database, only)
            return database, pairs, with_retry(lambda: maps(database)) if pairs else {}, None
        except Exception as exc:  # noqa: BLE001 - with robust, one database must not stop the rest
            if not robust:
                raise
            return database, [], {}, error_text(exc)

    work, schemas_of, errors = [], {}, []
    with ThreadPoolExecutor(max_workers=max(1, min(threads, len(databases)))) as pool:
        for database, pairs, found, err in pool.map(catalog, databases):
            if err is not None:
                errors.append((database, None, "tables", err))
            schemas_of |= found
            work.append((database, pairs))

    counts, count_errors = _jdbc_counts(spark, source, d, work, robust, tables_per_query, max_connections)
    keys = [(jdbc.qualified_database(d, database, s), t) for database, pairs in work for s, t in pairs]
    entries = [(*k, counts[k], schemas_of.get(k, "{}")) for k in keys if k in counts]
    return Inventory(build_inventory(spark, source, entries), errors_frame(spark, source, errors + count_errors))
