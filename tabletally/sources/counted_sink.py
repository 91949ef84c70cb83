"""A Parquet sink whose tasks report their rows when they commit.

``append_counted`` evaluates the rows once: tasks write their part to a staging
folder and hand file and row count over with their commit message; the commit
moves the files of the messages it was given into the table and leaves one small
record of the append. What a failed or repeated attempt wrote is in no message
and goes with the staging folder, so every row is there once and the count is
that of the rows that are there.

The sink is a Python data source (``spark.dataSource``), for stores that Arrow
can open. Elsewhere ``append_counted`` counts the rows before Spark's own writer
appends them (``write_if_any``).
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from typing import TYPE_CHECKING

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..operators.insert_missing import missing_rows, refuse_null_keys, write_if_any
from .registry_store import path_exists
from .stores import can_open, open_store, qualified_uri

if TYPE_CHECKING:
    import pyarrow as pa

cloudpickle.register_pickle_by_value(sys.modules["tabletally"])

#: Folder of the records of appends; readers skip names that begin with an underscore.
RECORDS = "_appends"


@dataclass
class Written(WriterCommitMessage):
    file: str  # in the staging folder; empty for a task without rows
    rows: int


class CountedParquet(DataSource):
    """``df.write.format("counted_parquet").option("path", uri).option("append", id).mode("append")``"""

    @classmethod
    def name(cls) -> str:
        return "counted_parquet"

    def writer(self, schema: StructType, overwrite: bool) -> CountedWriter:
        if overwrite:
            raise ValueError("counted_parquet only appends")
        return CountedWriter(self.options["path"], self.options["append"], schema)


class CountedWriter(DataSourceArrowWriter):
    def __init__(self, uri: str, append: str, schema: StructType):
        self.uri, self.append, self.schema = uri, append, schema

    def _place(self, *parts: str):
        store, path = open_store(self.uri)
        return store, "/".join([path.rstrip("/"), *parts])

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One file per attempt; an attempt without rows writes none."""
        from pyarrow import parquet as pq

        store, staging = self._place(f"_staging-{self.append}")
        schema, writer, rows = to_arrow_schema(self.schema), None, 0
        name = f"part-{uuid.uuid4().hex}.parquet"
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if writer is None:
                    store.create_dir(staging, recursive=True)
                    writer = pq.ParquetWriter(store.open_output_stream(f"{staging}/{name}"), schema, compression="snappy")
                writer.write_batch(batch.cast(schema))
                rows += batch.num_rows
        finally:
            if writer is not None:
                writer.close()
        return Written(name if rows else "", rows)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None and m.file]
        store, staging = self._place(f"_staging-{self.append}")
        for m in done:
            store.move(f"{staging}/{m.file}", self._place(m.file)[1])
        store.create_dir(self._place(RECORDS)[1], recursive=True)
        record = {"rows": sum(m.rows for m in done), "files": [m.file for m in done]}
        with store.open_output_stream(self._place(RECORDS, f"{self.append}.json")[1]) as f:
            f.write(json.dumps(record).encode())
        self._clear()

    def abort(self, messages: list[Written | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        from pyarrow import fs

        store, staging = self._place(f"_staging-{self.append}")
        if store.get_file_info(staging).type == fs.FileType.Directory:
            store.delete_dir(staging)


def append_counted(df: DataFrame, path: str) -> int:
    """Append the rows of ``df`` to the Parquet folder ``path``; return how many there are.

    Evaluates ``df`` once. An append without rows leaves an empty folder as it is.
    """
    spark = df.sparkSession
    uri = qualified_uri(spark, path)
    parent = uri.rstrip("/").rsplit("/", 1)[0]
    if not (can_open(uri) or can_open(parent)):
        return write_if_any(df, lambda rows: rows.write.mode("append").parquet(path))
    spark.dataSource.register(CountedParquet)
    append = uuid.uuid4().hex
    # files by bytes, as for Spark's own writer
    df.hint("rebalance").write.format("counted_parquet").option("path", uri).option("append", append).mode("append").save()
    record = spark.read.text(f"{path.rstrip('/')}/{RECORDS}/{append}.json").first()
    return json.loads(record["value"])["rows"]


def insert_missing_counted(batch: DataFrame, path: str, keys: list[str], order: list | None = None) -> int:
    """Append the rows of ``batch`` whose key the folder ``path`` lacks; return how many. Null keys are refused."""
    refuse_null_keys(batch, keys)
    spark = batch.sparkSession
    target = spark.read.schema(batch.schema).parquet(path) if path_exists(spark, path) else batch.limit(0)
    return append_counted(missing_rows(batch, target, keys, order), path)
