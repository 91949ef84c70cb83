"""Row counts of many tables.

File lakes are counted in one distributed scan over all tables. The scan
asks for no data column (``ReadSchema: struct<>``), so Parquet/ORC answer
from footers and row-group headers. Rows are counted per source file with a
partial (map-side) aggregate, so only one row per file and task is
shuffled; each file's count is then added to the table whose root path
(its leading path components) holds it. Tables with no rows produce no group:
the table list takes part in that sum with zeros.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.columns import leading_components, literal_path, uri_raw_path
from ..functions.errors import error_text
from ..sources.lake import LakeTable, metadata_frame

# A column no table has: with it as the read schema nothing is inferred on
# the driver, and selecting only file metadata prunes every data column.
ABSENT = T.StructType([T.StructField("__tabletally_absent__", T.IntegerType(), True)])


def _reader(spark: SparkSession, fmt: str):
    # Files are listed under each table root without partition discovery:
    # partition columns do not change a count, and table roots with and
    # without ``k=v`` folders must be readable together.
    return spark.read.format(fmt).schema(ABSENT).option("recursiveFileLookup", "true")


def count_lake_rows(
    spark: SparkSession, tables: list[LakeTable], database: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """``(database_name, table_name, row_count)`` for every listed table.

    ``database`` replaces the tables' own namespace when given. Tables are
    mapped by the leading components of their files' paths, so one scan
    covers the tables at one folder depth; tables at several depths (from
    several roots) get one scan per depth, united.
    """
    if not tables:
        return spark.createDataFrame([], schemas.COUNTS)
    by_depth: dict[int, list[LakeTable]] = {}
    for t in tables:
        by_depth.setdefault(t.root.count("/"), []).append(t)
    parts = [_count_at_depth(spark, group, depth, database, fmt) for depth, group in by_depth.items()]
    return reduce(DataFrame.unionByName, parts)


def _count_at_depth(
    spark: SparkSession, tables: list[LakeTable], depth: int, database: str | None, fmt: str
) -> DataFrame:
    scan = _reader(spark, fmt).load([literal_path(t.path) for t in tables])
    # Count per file first: the file path is a plain string key, hashed per
    # row; the path-to-table mapping (a regex) then runs once per file, not
    # once per row.
    per_file = scan.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(
        F.count(F.lit(1)).alias("n")
    )
    root = leading_components(uri_raw_path(F.col("file_path")), depth)
    names = metadata_frame(spark, [(t.root, database or t.database, t.name) for t in tables], schemas.ROOTS)
    # The names take part as rows that count 0: one aggregate brings names and
    # files together, and tables without rows are there, too. No join.
    counted = per_file.select(root.alias("root"), "n").unionByName(
        names.withColumn("n", F.lit(0).cast("bigint")), allowMissingColumns=True
    )
    return (
        counted.groupBy("root")
        .agg(F.max("database_name").alias("database_name"), F.max("table_name").alias("table_name"), F.sum("n").alias("row_count"))
        .where("table_name IS NOT NULL")
        .select("database_name", "table_name", F.coalesce("row_count", F.lit(0).cast("bigint")).alias("row_count"))
    )


def count_by_halves(
    spark: SparkSession,
    tables: list[LakeTable],
    database: str | None = None,
    fmt: str = "parquet",
) -> tuple[list[tuple[str, str, int]], list[tuple[str, str, str, str]]]:
    """Counts of all tables that can be counted, and an error row for each that cannot.

    The one-scan count runs; if it fails (a corrupt file, say), the tables are
    halved and each half is counted by one scan again. One bad table among n
    costs about 2 log2(n) scans instead of n jobs, and hides none of the others.
    """
    rows: list[tuple[str, str, int]] = []
    errors: list[tuple[str, str, str, str]] = []
    todo = [tables] if tables else []
    while todo:
        part = todo.pop()
        try:
            rows += [tuple(r) for r in count_lake_rows(spark, part, database, fmt).collect()]  # one per table
        except Exception as exc:  # noqa: BLE001 - halved, then reported as an error row
            if len(part) == 1:
                errors.append((database or part[0].database, part[0].name, "count", error_text(exc)))
            else:
                todo += [part[: len(part) // 2], part[len(part) // 2 :]]
    return rows, errors
