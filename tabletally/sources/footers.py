"""Row counts and columns of many Parquet tables from their files' footers.

One job for all tables: Spark lists the files as rows (``binaryFile`` without
its content: names and sizes, listed in parallel where there are many folders),
tasks read the footers of their files in Arrow batches, and one aggregate folds
them to a row per table. No column data is read and no job is started per table.

A file that Arrow cannot open or whose types it cannot name as Spark would (a
store it does not know, a corrupt file, a rare type) marks its table as not
read; the caller resolves such tables through Spark's own reader.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .. import schemas
from ..functions.columns import leading_components, literal_path, uri_raw_path
from ..functions.types import type_text
from ..operators.pairs_json import entries_to_json
from ..operators.type_merge import in_conflict, merged_type, type_facts
from .lake import LakeTable, metadata_frame
from .stores import open_store

# functions for tasks are sent by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules["tabletally"])

COLUMN = T.StructType(
    [
        T.StructField("pos", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
    ]
)
FOOTERS = T.StructType(
    [
        T.StructField("file_path", T.StringType(), False),
        T.StructField("n", T.LongType(), True),
        T.StructField("columns", T.ArrayType(COLUMN, False), True),
        T.StructField("error", T.StringType(), True),
    ]
)
#: Footers a task reads at once; each is a few requests to the store, mostly waiting.
READS_AT_ONCE = 8
#: Where Spark keeps the schema it wrote, in a footer's key/value pairs (fixed value).
SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"

_SIMPLE = {
    pa.bool_(): "boolean", pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint",
    pa.uint8(): "smallint", pa.uint16(): "int", pa.uint32(): "bigint", pa.uint64(): "decimal(20,0)",
    pa.float32(): "float", pa.float64(): "double", pa.string(): "string", pa.large_string(): "string",
    pa.binary(): "binary", pa.large_binary(): "binary", pa.date32(): "date",
}


def arrow_type_text(kind: pa.DataType) -> str:
    """The short name of the type Spark reads a Parquet column of this Arrow type as."""
    if kind in _SIMPLE:
        return _SIMPLE[kind]
    if pa.types.is_decimal128(kind):
        return f"decimal({kind.precision},{kind.scale})"
    if pa.types.is_timestamp(kind):
        return "timestamp" if kind.tz else "timestamp_ntz"
    if pa.types.is_fixed_size_binary(kind):
        return "binary"
    if pa.types.is_dictionary(kind):
        return arrow_type_text(kind.value_type)
    if pa.types.is_list(kind) or pa.types.is_large_list(kind) or pa.types.is_fixed_size_list(kind):
        return f"array<{arrow_type_text(kind.value_type)}>"
    if pa.types.is_map(kind):
        return f"map<{arrow_type_text(kind.key_type)},{arrow_type_text(kind.item_type)}>"
    if pa.types.is_struct(kind):
        return "struct<" + ",".join(f"{f.name}:{arrow_type_text(f.type)}" for f in kind) + ">"
    raise ValueError(f"no Spark name for {kind}")


def footer_columns(metadata) -> list[tuple[int, str, str]]:
    """``(pos, name, type text)`` of a footer: the schema Spark wrote into it, else the file's own."""
    written = (metadata.metadata or {}).get(SPARK_SCHEMA)
    if written:
        fields = [(f.name, type_text(f.dataType)) for f in T.StructType.fromJson(json.loads(written)).fields]
    else:
        if any(metadata.schema.column(i).physical_type == "INT96" for i in range(len(metadata.schema))):
            raise ValueError("INT96 without Spark's schema")  # a time stamp whose zone only Spark's settings tell
        fields = [(f.name, arrow_type_text(f.type)) for f in metadata.schema.to_arrow_schema()]
    return [(i, name, kind) for i, (name, kind) in enumerate(fields, start=1)]


def footer_of(uri: str):
    """The footer of the Parquet file at an encoded URI, on any store Arrow knows."""
    from pyarrow import parquet as pq

    store, path = open_store(uri)
    with store.open_input_file(path) as f:
        return pq.read_metadata(f)


def read_footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Encoded file URIs -> rows of ``FOOTERS``."""

    def read(uri: str) -> tuple:
        try:
            metadata = footer_of(uri)
            return uri, metadata.num_rows, footer_columns(metadata), None
        except Exception as exc:  # noqa: BLE001 - the table goes to Spark's own reader
            return uri, None, None, f"{type(exc).__name__}: {exc}"

    schema = to_arrow_schema(FOOTERS)
    with ThreadPoolExecutor(max_workers=READS_AT_ONCE) as pool:
        for batch in batches:
            rows = list(pool.map(read, batch.column(0).to_pylist()))
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            columns[2:3] = [[None if c is None else [dict(zip(COLUMN.names, x, strict=True)) for x in c] for c in columns[2]]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )


def lake_files(spark: SparkSession, tables: list[LakeTable]) -> DataFrame:
    """``(file_path, length, modified)`` of the data files of the tables; the path is URI-encoded."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([literal_path(t.path) for t in tables])
    )
    visible = ~F.col("_metadata.file_name").startswith("_")
    return files.where(visible).select(F.col("_metadata.file_path").alias("file_path"), "length", F.col("modificationTime").alias("modified"))


def file_footers(spark: SparkSession, tables: list[LakeTable]) -> DataFrame:
    """One row per data file of the tables: ``FOOTERS``."""
    return lake_files(spark, tables).select("file_path").mapInArrow(read_footers, FOOTERS)


def lake_footers(spark: SparkSession, tables: list[LakeTable], database: str | None = None) -> DataFrame:
    """One row per listed table, in one job for all of them.

    ``database_name, table_name, n_files, row_count, table_schema`` and, for
    what one aggregate cannot settle: ``unread`` (files whose footer could not
    be used), ``error`` (the first such file's), ``partitioned`` (some file lies
    in a ``key=value`` folder) and ``conflicts`` (columns whose files' types have
    no common one, as ``name: type, type``). A table without files has zero rows
    and the map ``{}``.

    ``table_schema`` lists the columns of all files in the order in which the
    files, sorted by path, first show them; a column's type is the least one
    that holds all its files' types (see ``type_merge``), null after a conflict.
    """
    if not tables:
        return spark.createDataFrame([], _FACTS)
    by_depth: dict[int, list[LakeTable]] = {}
    for t in tables:
        by_depth.setdefault(t.root.count("/"), []).append(t)
    parts = [_footers_at_depth(spark, group, depth, database) for depth, group in by_depth.items()]
    return reduce(DataFrame.unionByName, parts)


def _footers_at_depth(spark: SparkSession, tables: list[LakeTable], depth: int, database: str | None) -> DataFrame:
    # a file belongs to the table whose root its path begins with
    whole = uri_raw_path(F.col("file_path"))
    root = leading_components(whole, depth)
    footers = file_footers(spark, tables).withColumn("root", root).withColumn("below", F.substr(whole, F.length(root) + 1))
    # a first entry without a name carries the file itself, so that one pass counts files and columns
    whole_file = F.struct(F.lit(0).alias("pos"), F.lit(None).cast("string").alias("column_name"), F.lit(None).cast("string").alias("data_type"))
    entries = footers.select(
        "root", "file_path", "below", "n", "error",
        F.explode(F.concat(F.array(whole_file), F.coalesce("columns", F.array().cast(T.ArrayType(COLUMN))))).alias("c"),
    ).select("root", "file_path", "below", "n", "error", "c.*")
    is_file = F.col("column_name").isNull()
    in_folder = F.col("below").rlike("^/[^/=]+=[^/]*/")
    # names that differ in case only are one column, as for Spark
    per_column = entries.groupBy("root", F.lower("column_name").alias("_column")).agg(
        F.min(F.struct("file_path", "pos")).alias("first"),
        F.min_by("column_name", F.struct("file_path", "pos")).alias("column_name"),
        *type_facts(F.col("data_type")),
        F.count(F.when(is_file, F.lit(1))).alias("n_files"),
        F.sum(F.when(is_file, F.col("n"))).alias("n"),
        F.count(F.when(is_file, F.col("error"))).alias("unread"),
        F.min(F.when(is_file, F.struct("file_path", "error"))).alias("first_error"),
        F.max(is_file & in_folder).alias("partitioned"),
    )
    merged = per_column.withColumn("data_type", merged_type()).withColumn(
        "conflict", F.when(in_conflict(), F.concat_ws(": ", "column_name", "types"))
    )
    # the names take part as rows without a column, so that tables without files are there and no join is needed
    names = metadata_frame(spark, [(t.root, database or t.database, t.name) for t in tables], schemas.ROOTS)
    named = F.col("column_name").isNotNull()
    per_root = merged.unionByName(names, allowMissingColumns=True).groupBy("root").agg(
        F.max("database_name").alias("database_name"),
        F.max("table_name").alias("table_name"),
        F.sum("n_files").alias("n_files"),
        F.sum("n").alias("row_count"),
        F.sum("unread").alias("unread"),
        F.max("first_error.error").alias("error"),
        F.max("partitioned").alias("partitioned"),
        F.array_sort(F.collect_list(F.when(named, F.col("conflict")))).alias("conflicts"),
        entries_to_json("first", "column_name", "data_type").alias("table_schema"),
    )
    zero = F.lit(0).cast("bigint")
    return per_root.where("table_name IS NOT NULL").select(
        "database_name", "table_name",
        F.coalesce("n_files", zero).alias("n_files"), F.coalesce("row_count", zero).alias("row_count"), "table_schema",
        F.coalesce("unread", zero).alias("unread"), "error",
        F.coalesce("partitioned", F.lit(False)).alias("partitioned"), "conflicts",
    )


_FACTS = (
    "database_name string, table_name string, n_files long, row_count long, table_schema string, unread long, "
    "error string, partitioned boolean, conflicts array<string>"
)
