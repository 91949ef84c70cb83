"""Helpers shared by the operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

#: A word, as every contract of this package means it.
WORD = r"[^\x20\x09-\x0D]+"


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder of the session; a temporary one only where none is named, as in tests on one machine."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return sc.getCheckpointDir()


def reliable(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder of ``spark.checkpoint.dir``.

    A lost executor costs a re-read, not a re-run.
    """
    checkpoint_folder(df.sparkSession)
    return df.checkpoint()


def crc_of_id(doc_id: Column) -> Column:
    """crc32 of an id written as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))


def learns(doc_id: Column) -> Column:
    """True for the rows whose labels may be learnt from."""
    return crc_of_id(doc_id) % 5 != 0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """A helper column's name that no column of ``df`` has (names match without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_text_columns(
    df: DataFrame,
    text: str,
    outputs: StructType,
    make: Callable[[], Callable[[list[str]], list]],
    keep: list[str] | None = None,
    rows: int = 256,
    beside: str | None = None,
) -> DataFrame:
    """``df`` with columns computed from its texts in Arrow batches, without a shuffle.

    ``make()`` runs once per task and returns the function that maps a list of
    texts (null as empty) to one list or Arrow array per output field. ``rows``
    bounds how many texts are worked on at once. The columns ``keep`` (all if
    None) are passed on; one that has an output's name is replaced. A column
    ``beside`` is handed to the function as a second argument, an Arrow array.
    """
    new = {f.name.lower() for f in outputs}
    wanted = {c.lower() for c in (df.columns if keep is None else keep)}
    kept = [f for f in df.schema if f.name.lower() in wanted - new]
    texts = free_name(df, "_text")
    schema = StructType([*kept, *outputs])
    arrow_schema = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                part = batch.slice(start, rows)
                given = [part.column(len(kept) + 1)] if beside else []
                results = work([t or "" for t in part.column(len(kept)).to_pylist()], *given)
                columns = [c.cast(f.type) for c, f in zip(part.columns[: len(kept)], arrow_schema, strict=False)]
                for field, values in zip(list(arrow_schema)[len(columns):], results, strict=True):
                    columns.append(values if isinstance(values, pa.Array) else pa.array(values, field.type))
                yield pa.RecordBatch.from_arrays(columns, schema=arrow_schema)

    given = [F.col(f"`{beside}`")] if beside else []
    return df.select(*[F.col(f"`{f.name}`") for f in kept], F.col(text).alias(texts), *given).mapInArrow(run, schema)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the session's shared checkpoint folder."""
    return f"{checkpoint_folder(spark)}/{name}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Removes a folder of intermediate data that no later step reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
