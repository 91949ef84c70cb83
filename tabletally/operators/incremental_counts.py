"""Row counts that read only files not counted before (C7, incremental).

The state is a table of counted files: encoded path, length, modification time
and row count. A run lists the files, joins them with the state on all three,
and reads the footers of the files it does not find there, in the same pass.
Files that are gone drop out because only listed files count; a file that was
rewritten has another length or time and is read again. An unchanged lake costs
a listing and one join, and opens no data file.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.columns import leading_components, literal_path, uri_raw_path
from ..session import kept
from ..sources.footers import READS_AT_ONCE, footer_of, lake_files
from ..sources.lake import LakeTable, metadata_frame
from .counts import ABSENT

FILE = ["file_path", "length", "modified"]
STATE = "file_path string, length long, modified timestamp, n long"


def _count_unknown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (file, known n or null) -> (file, n, fresh); n stays null where Arrow cannot read the file."""

    def count(uri: str) -> int | None:
        try:
            return footer_of(uri).num_rows
        except Exception:  # noqa: BLE001 - counted by Spark's reader
            return None

    with ThreadPoolExecutor(max_workers=READS_AT_ONCE) as pool:
        for batch in batches:
            uris, known = batch.column(0).to_pylist(), batch.column(3).to_pylist()
            n = list(pool.map(lambda x: count(x[0]) if x[1] is None else x[1], zip(uris, known, strict=True)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(n, pa.int64()), pa.array([k is None for k in known], pa.bool_())],
                names=[*FILE, "n", "fresh"],
            )


def count_files(
    spark: SparkSession, tables: list[LakeTable], state: DataFrame | None = None, fmt: str = "parquet"
) -> DataFrame:
    """``file_path, length, modified, n, fresh`` of every data file; ``fresh`` files were not in ``state``.

    A state row that occurs twice (two runs that overlapped) counts once. Files
    that Arrow cannot open are counted by Spark's reader, in one scan over them.
    A file that neither can read raises.
    """
    if not tables:
        return spark.createDataFrame([], STATE + ", fresh boolean")
    files = lake_files(spark, tables)
    if state is None:
        known = files.withColumn("n", F.lit(None).cast("long"))
    else:
        known = files.join(state.groupBy(*FILE).agg(F.max("n").alias("n")), FILE, "left").select(*FILE, "n")
    counted = kept(known.mapInArrow(_count_unknown, STATE + ", fresh boolean"))
    unread = [unquote(r["file_path"]) for r in counted.where("n IS NULL").select("file_path").collect()]
    if not unread:
        return counted
    scanned = (
        spark.read.format(fmt).schema(ABSENT).load([literal_path(p) for p in unread])
        .groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("scanned"))
    )
    # a file without rows has no group
    n = F.coalesce("n", "scanned", F.lit(0)).alias("n")
    return kept(counted.join(scanned, "file_path", "left").select(*FILE, n, "fresh"))


def counts_of_files(spark: SparkSession, tables: list[LakeTable], files: DataFrame, database: str | None = None) -> DataFrame:
    """``database_name, table_name, row_count, n_files, n_fresh`` of every listed table from its files' rows."""
    names = metadata_frame(spark, [(t.root, database or t.database, t.name) for t in tables], schemas.ROOTS)
    raw = uri_raw_path(F.col("file_path"))
    depths = sorted({t.root.count("/") for t in tables})
    # a file lies under the roots of every depth above it; those that are no table find no name
    rooted = files.withColumn("root", F.explode(F.array(*[leading_components(raw, d) for d in depths])) if depths else raw)
    per_root = rooted.groupBy("root").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("files"), F.count_if("fresh").alias("fresh")
    )
    zero = F.lit(0).cast("bigint")
    return names.join(per_root, "root", "left").select(
        "database_name", "table_name", F.coalesce("n", zero).alias("row_count"),
        F.coalesce("files", zero).alias("n_files"), F.coalesce("fresh", zero).alias("n_fresh"),
    )


def refresh_counts(
    spark: SparkSession, tables: list[LakeTable], state_path: str, database: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Counts of all listed tables; reads files that are new since the last call and adds them to the state.

    The state folder only grows by appends (Spark's commit protocol), so a run
    that fails leaves it as it was or with the whole run's files.
    """
    from ..sources.registry_store import path_exists

    state = spark.read.schema(STATE).parquet(state_path) if path_exists(spark, state_path) else None
    files = count_files(spark, tables, state, fmt)
    fresh = files.where("fresh").select(*FILE, "n")
    if not fresh.isEmpty():
        fresh.hint("rebalance").write.mode("append").parquet(state_path)
    return counts_of_files(spark, tables, files, database)
