from __future__ import annotations

import os

import pyarrow as pa
import pytest
from pyspark.sql.types import LongType, StringType, StructType

from tabletally.sources import counted_sink
from tabletally.sources.counted_sink import CountedWriter, append_counted, insert_missing_counted

DDL = "k long, s string, t timestamp_ntz, a array<int>"


def test_appends_and_counts(spark, tmp_path):
    path = str(tmp_path / "my table")
    df = spark.range(10).selectExpr("id AS k", "CAST(id AS string) AS s", "TIMESTAMP_NTZ '2024-01-01 00:00:00' AS t", "array(1, 2) AS a")
    assert insert_missing_counted(df.where("k < 4"), path, ["k"]) == 4
    assert insert_missing_counted(df, path, ["k"]) == 6
    assert insert_missing_counted(df, path, ["k"]) == 0
    got = spark.read.parquet(path)
    assert got.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))
    assert not [f for f in os.listdir(path) if f.startswith("_staging")]


def test_null_keys_are_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        insert_missing_counted(spark.createDataFrame([(None, "x", None, None)], DDL), str(tmp_path / "t"), ["k"])


def test_what_a_repeated_attempt_wrote_is_not_there(spark, tmp_path):
    """Two attempts of a task write; only the message of one reaches the commit."""
    schema = StructType().add("k", LongType()).add("s", StringType())
    writer = CountedWriter(f"file:{tmp_path}/t", "one", schema)
    batch = pa.RecordBatch.from_pydict({"k": [1, 2], "s": ["a", None]})
    writer.write(iter([batch]))
    kept, empty = writer.write(iter([batch, batch])), writer.write(iter([]))
    assert (kept.rows, empty.rows, empty.file) == (4, 0, "")
    writer.commit([kept, None, empty])
    got = spark.read.parquet(f"{tmp_path}/t").collect()
    assert len(got) == 4 and sorted(os.listdir(tmp_path / "t")) == sorted(["_appends", kept.file])


def test_an_aborted_append_leaves_nothing(tmp_path):
    writer = CountedWriter(f"file:{tmp_path}/t", "two", StructType().add("k", LongType()))
    writer.write(iter([pa.RecordBatch.from_pydict({"k": [1]})]))
    writer.abort([None])
    assert os.listdir(tmp_path / "t") == []


def test_a_failing_task_fails_the_append(spark, tmp_path):
    def fail(batches):
        yield from batches
        raise RuntimeError("broken input")

    df = spark.range(5).mapInArrow(fail, "id long")
    with pytest.raises(Exception, match="broken input"):
        append_counted(df, str(tmp_path / "t"))
    assert not [f for f in os.listdir(tmp_path / "t") if f.endswith(".parquet")] if os.path.exists(tmp_path / "t") else True


def test_rows_are_evaluated_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    assert append_counted(spark.range(100).mapInArrow(count, "id long"), str(tmp_path / "t")) == 100
    assert seen.value == 100


def test_a_store_that_arrow_does_not_know(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(counted_sink, "can_open", lambda uri: False)
    assert append_counted(spark.range(7), str(tmp_path / "t")) == 7
    assert append_counted(spark.range(0), str(tmp_path / "t")) == 0
    assert spark.read.parquet(str(tmp_path / "t")).count() == 7
