"""JDBC sources: addresses, catalog SQL per dialect, reads and writes.

Catalog reads (databases, tables, columns) are small and use the ``query``
option. Columns come from *one* query per database for all of its tables,
with their ordinal position, instead of one query per table. Row counts are
one ``UNION ALL`` text per group of tables, so a group costs one round trip.
Table data is read with
``partitionColumn``/``lowerBound``/``upperBound``/``numPartitions``.

Nothing here can be exercised without a database server; the tests check the
generated options and SQL text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .model import JDBC_KINDS, Source

# ---------------------------------------------------------------------------
# Fixed values, equal to the original job's for the same inventory.
#   PostgreSQL databases left out:  postgres, template0, template1
#   PostgreSQL table schema:        public (views are listed too)
#   SQL Server databases left out:  master, tempdb, model, msdb
#   SQL Server table type:          BASE TABLE
#   SQL Server TLS defaults:        encrypt=true, trustServerCertificate=true
#   Oracle owners listed:           SYSTEM
#   Oracle tables left out:         DUAL, USER_TABLES, ALL_TABLES, DBA_TABLES
#   Oracle service name:            FREEPDB1
#   Driver classes:                 org.postgresql.Driver,
#                                   com.microsoft.sqlserver.jdbc.SQLServerDriver,
#                                   oracle.jdbc.OracleDriver
#   PostgreSQL write option:        stringtype=unspecified
# ---------------------------------------------------------------------------
POSTGRES_EXCLUDED_DATABASES = ("postgres", "template0", "template1")
POSTGRES_SCHEMA = "public"
MSSQL_EXCLUDED_DATABASES = ("master", "tempdb", "model", "msdb")
MSSQL_TABLE_TYPE = "BASE TABLE"
MSSQL_TLS = {"encrypt": "true", "trustServerCertificate": "true"}
ORACLE_OWNERS = ("SYSTEM",)
ORACLE_EXCLUDED_TABLES = ("DUAL", "USER_TABLES", "ALL_TABLES", "DBA_TABLES")
ORACLE_SERVICE = "FREEPDB1"
DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "mssql": "com.microsoft.sqlserver.jdbc.SQLServerDriver",
    "oracle": "oracle.jdbc.OracleDriver",
}


def sql_literal(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def sql_list(values: Iterable[str]) -> str:
    return "(" + ", ".join(sql_literal(v) for v in values) + ")"


@dataclass(frozen=True)
class Dialect:
    kind: str
    default_database: str
    excluded_databases: tuple[str, ...]
    excluded_tables: tuple[str, ...]
    url: Callable[[Source, str], str]
    quote: Callable[[str], str]
    databases_sql: Callable[[Source], str]
    tables_sql: Callable[[Source], str]
    columns_sql: Callable[[Source], str]
    count_sql: Callable[[str, str], str]
    # Server schema that is part of the database name only when it differs.
    default_schema: str | None = None
    write_options: tuple[tuple[str, str], ...] = ()


def _dq(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _bracket(name: str) -> str:
    return "[" + name.replace("]", "]]") + "]"


def excluded_databases(source: Source, own: tuple[str, ...]) -> tuple[str, ...]:
    """The server's own databases and those the caller leaves out as well."""
    return (*own, *(source.exclude_databases or ()))


def _mssql_url(source: Source, database: str) -> str:
    tls = ";".join(f"{k}={source.options.get(k, default)}" for k, default in MSSQL_TLS.items())
    return f"jdbc:sqlserver://{source.host}:{source.port};databaseName={database};{tls}"


POSTGRES = Dialect(
    kind="postgresql",
    default_database="",
    excluded_databases=POSTGRES_EXCLUDED_DATABASES,
    excluded_tables=(),
    url=lambda s, db: f"jdbc:postgresql://{s.host}:{s.port}/{db}",
    quote=_dq,
    databases_sql=lambda s: (
        "SELECT datname AS database_name FROM pg_database"
        f" WHERE datname NOT IN {sql_list(excluded_databases(s, POSTGRES_EXCLUDED_DATABASES))}"
    ),
    tables_sql=lambda s: (
        "SELECT table_schema AS schema_name, table_name FROM information_schema.tables"
        f" WHERE table_schema = {sql_literal(POSTGRES_SCHEMA)}"
    ),
    columns_sql=lambda s: (
        "SELECT table_schema AS schema_name, table_name, ordinal_position AS pos,"
        " column_name, data_type FROM information_schema.columns"
        f" WHERE table_schema = {sql_literal(POSTGRES_SCHEMA)}"
    ),
    count_sql=lambda schema, table: (
        f"SELECT COUNT(*) AS row_count FROM {_dq(schema)}.{_dq(table)}"
    ),
    default_schema=POSTGRES_SCHEMA,
    write_options=(("stringtype", "unspecified"),),
)

MSSQL = Dialect(
    kind="mssql",
    default_database="master",
    excluded_databases=MSSQL_EXCLUDED_DATABASES,
    excluded_tables=(),
    url=_mssql_url,
    quote=_bracket,
    databases_sql=lambda s: (
        "SELECT name AS database_name FROM sys.databases"
        f" WHERE name NOT IN {sql_list(excluded_databases(s, MSSQL_EXCLUDED_DATABASES))}"
    ),
    tables_sql=lambda s: (
        "SELECT TABLE_SCHEMA AS schema_name, TABLE_NAME AS table_name"
        f" FROM INFORMATION_SCHEMA.TABLES WHERE TABLE_TYPE = {sql_literal(MSSQL_TABLE_TYPE)}"
    ),
    columns_sql=lambda s: (
        "SELECT c.TABLE_SCHEMA AS schema_name, c.TABLE_NAME AS table_name,"
        " c.ORDINAL_POSITION AS pos, c.COLUMN_NAME AS column_name, c.DATA_TYPE AS data_type"
        " FROM INFORMATION_SCHEMA.COLUMNS c JOIN INFORMATION_SCHEMA.TABLES t"
        " ON t.TABLE_CATALOG = c.TABLE_CATALOG AND t.TABLE_SCHEMA = c.TABLE_SCHEMA"
        " AND t.TABLE_NAME = c.TABLE_NAME"
        f" WHERE t.TABLE_TYPE = {sql_literal(MSSQL_TABLE_TYPE)}"
    ),
    # COUNT(*) is a 32-bit INT on SQL Server; COUNT_BIG does not overflow.
    count_sql=lambda schema, table: (
        f"SELECT COUNT_BIG(*) AS row_count FROM {_bracket(schema)}.{_bracket(table)}"
    ),
    default_schema="dbo",
)

ORACLE = Dialect(
    kind="oracle",
    default_database=ORACLE_SERVICE,
    excluded_databases=(),
    excluded_tables=ORACLE_EXCLUDED_TABLES,
    url=lambda s, db: (
        f"jdbc:oracle:thin:@{s.host}:{s.port}/{s.options.get('service', ORACLE_SERVICE)}"
    ),
    quote=_dq,
    # Owners play the part of databases; the list is an argument.
    databases_sql=lambda s: (
        "SELECT DISTINCT OWNER AS database_name FROM ALL_TABLES"
        f" WHERE OWNER IN {sql_list(_owners(s))}"
    ),
    tables_sql=lambda s: (
        "SELECT OWNER AS schema_name, TABLE_NAME AS table_name FROM ALL_TABLES"
        f" WHERE OWNER IN {sql_list(_owners(s))}"
    ),
    columns_sql=lambda s: (
        "SELECT OWNER AS schema_name, TABLE_NAME AS table_name, COLUMN_ID AS pos,"
        " COLUMN_NAME AS column_name, DATA_TYPE AS data_type FROM ALL_TAB_COLUMNS"
        f" WHERE OWNER IN {sql_list(_owners(s))}"
    ),
    count_sql=lambda schema, table: (
        f"SELECT COUNT(*) AS row_count FROM {_dq(schema)}.{_dq(table)}"
    ),
)


def _owners(source: Source) -> tuple[str, ...]:
    owners = source.options.get("owners")
    return tuple(owners.split(",")) if owners else ORACLE_OWNERS


DIALECTS = {"postgresql": POSTGRES, "mssql": MSSQL, "oracle": ORACLE}


def dialect(source: Source) -> Dialect:
    if source.kind not in JDBC_KINDS:
        raise ValueError(f"Unsupported source type: {source.kind}")
    return DIALECTS[source.kind]


def jdbc_options(source: Source, database: str | None = None) -> dict[str, str]:
    """Reader/writer options for one database of a source."""
    d = dialect(source)
    db = d.default_database if database is None else database
    opts = {"url": d.url(source, db), "driver": DRIVERS[source.kind]}
    if source.user is not None:
        opts["user"] = source.user
    if source.password is not None:
        opts["password"] = source.password
    for k, v in source.options.items():
        if k not in ("owners", "service", *MSSQL_TLS):
            opts[k] = str(v)
    return opts


def read_query(spark: SparkSession, source: Source, database: str | None, query: str) -> DataFrame:
    """A small catalog read (S1); column names are lower-cased by position."""
    df = spark.read.format("jdbc").options(**jdbc_options(source, database)).option(
        "query", query
    ).load()
    return df.toDF(*[c.lower() for c in df.columns])


def read_table(
    spark: SparkSession,
    source: Source,
    database: str | None,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int = 10_000,
    predicates: list[str] | None = None,
) -> DataFrame:
    """Table data, split into ``num_partitions`` range reads when a column is given,
    or into one read per predicate (which must not overlap)."""
    if predicates:
        options = jdbc_options(source, database) | {"fetchsize": str(fetch_size)}
        return spark.read.jdbc(options.pop("url"), table, predicates=predicates, properties=options)
    reader = (
        spark.read.format("jdbc")
        .options(**jdbc_options(source, database))
        .option("dbtable", table)
        .option("fetchsize", str(fetch_size))
    )
    if partition_column is not None:
        reader = (
            reader.option("partitionColumn", partition_column)
            .option("lowerBound", str(lower_bound))
            .option("upperBound", str(upper_bound))
            .option("numPartitions", str(num_partitions or 1))
        )
    return reader.load()


def write_table(
    df: DataFrame,
    source: Source,
    database: str | None,
    table: str,
    mode: str = "append",
    max_connections: int | None = None,
) -> None:
    """Append (W1/W2). ``max_connections`` bounds the concurrent inserts."""
    d = dialect(source)
    writer = df.write.format("jdbc").options(**jdbc_options(source, database)).option(
        "dbtable", table
    )
    for k, v in d.write_options:
        writer = writer.option(k, v)
    if max_connections is not None:
        writer = writer.option("numPartitions", str(max_connections))
    writer.mode(mode).save()


def qualified_database(d: Dialect, database: str, schema: str | None) -> str:
    """Namespace stored in ``database_name``: the schema joins it when not default."""
    if d.kind == "oracle":
        return schema or database  # owners are the namespaces
    if schema is None or schema == d.default_schema:
        return database
    return f"{database}.{schema}"


def count_union_sql(d: Dialect, tables: list[tuple[str, str]]) -> str:
    """One query that counts all ``(schema, table)``: rows (item, row_count), items from 0."""
    return " UNION ALL ".join(
        f"SELECT {i} AS item, q.row_count FROM ({d.count_sql(schema, table)}) q" for i, (schema, table) in enumerate(tables)
    )


def count_tables(
    spark: SparkSession, source: Source, database: str, tables: list[tuple[str, str]]
) -> list[int]:
    """Row counts of a group of tables of one database, in one query."""
    counts = read_query(spark, source, database, count_union_sql(dialect(source), tables)).select(
        F.col("item").cast("int"), F.col("row_count").cast("bigint")
    )
    found = {r["item"]: r["row_count"] for r in counts.collect()}
    return [found[i] for i in range(len(tables))]
