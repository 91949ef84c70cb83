"""The footer pass against Spark's own readers, and the type merge against a plain fold."""

from __future__ import annotations

import json
import os
import re
import sys

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import SF_SMALL, write_table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabletally.operators.type_merge import merge_types
from tabletally.plans.inventory import lake_inventory
from tabletally.plans.lake_inventory import _by_spark
from tabletally.plans.queries import lake_source
from tabletally.sources import footers, lake
from tabletally.sources.model import Source


def _facts(spark, root):
    return {r["table_name"]: r for r in footers.lake_footers(spark, lake.list_lake_tables(spark, Source("l", "parquet", path=root))).collect()}


def test_equals_sparks_own_readers(spark):
    src = lake_source(SF_SMALL)
    tables = lake.list_lake_tables(spark, src)
    expected, errors = _by_spark(spark, src, tables, robust=False)
    got = footers.lake_footers(spark, tables).collect()
    assert errors == []
    assert sorted((r["database_name"], r["table_name"], r["row_count"], r["table_schema"]) for r in got) == sorted(expected)


def test_one_job_describes_many_tables(spark, tmp_path):
    root = str(tmp_path / "lake")
    for i in range(40):
        os.makedirs(f"{root}/t{i}")
        pq.write_table(pa.table({f"c{i}": list(range(i)), "x": ["a"] * i}), f"{root}/t{i}/part-0.parquet")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("footers", "footers")
    try:
        inv = lake_inventory(spark, Source("l", "parquet", path=root))
        rows = {r["table_name"]: r for r in inv.rows.collect()}
        jobs = len(tracker.getJobIdsForGroup("footers"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {t: r["row_count"] for t, r in rows.items()} == {f"t{i}": i for i in range(40)}
    assert json.loads(rows["t7"]["table_schema"]) == {"c7": "bigint", "x": "string"}
    assert jobs < 20  # stages of one query and the listing, not a job per table


def test_types_as_spark_names_them(spark, tmp_path):
    """Files that Spark did not write: the schema is the file's own."""
    root = str(tmp_path / "lake")
    os.makedirs(f"{root}/t")
    table = pa.table({
        "i8": pa.array([1], pa.int8()), "u8": pa.array([1], pa.uint8()), "u16": pa.array([1], pa.uint16()),
        "u32": pa.array([1], pa.uint32()), "u64": pa.array([1], pa.uint64()), "f": pa.array([1.0], pa.float32()),
        "s": pa.array(["a"]), "ls": pa.array(["a"], pa.large_string()), "b": pa.array([b"x"]),
        "fb": pa.array([b"abcd"], pa.binary(4)), "d": pa.array([1], pa.date32()), "ts": pa.array([1], pa.timestamp("us")),
        "tz": pa.array([1], pa.timestamp("us", "UTC")), "dec": pa.array([1], pa.decimal128(12, 3)),
        "dict": pa.array(["a"]).dictionary_encode(), "l": pa.array([[1]], pa.list_(pa.int32())),
        "m": pa.array([[("a", 1)]], pa.map_(pa.string(), pa.int64())),
        "st": pa.array([{"a": 1, "B": [{"c": 1.0}]}]),
    })
    pq.write_table(table, f"{root}/t/part-0.parquet")
    fact = _facts(spark, root)["t"]
    expected = {f.name: f.dataType.simpleString() for f in spark.read.parquet(f"{root}/t").schema.fields}
    assert (fact["unread"], json.loads(fact["table_schema"])) == (0, expected)


def test_rare_types_go_through_sparks_reader(spark, tmp_path):
    root = str(tmp_path / "lake")
    os.makedirs(f"{root}/t")
    pq.write_table(pa.table({"ts": pa.array([1], pa.timestamp("ns"))}), f"{root}/t/a.parquet", use_deprecated_int96_timestamps=True)
    assert _facts(spark, root)["t"]["unread"] == 1
    inv = lake_inventory(spark, Source("l", "parquet", path=root))
    kind = spark.read.parquet(f"{root}/t").schema["ts"].dataType.simpleString()
    assert [(r["row_count"], r["table_schema"]) for r in inv.rows.collect()] == [(1, f'{{"ts":"{kind}"}}')]


def test_partition_folders_hidden_files_and_order(spark, tmp_path):
    root = str(tmp_path / "lake")
    spark.createDataFrame([(1, "x", 2024, "a b"), (2, "y", 2025, "ü")], "id long, v string, year int, Place string").write.partitionBy("year", "Place").parquet(f"{root}/t")
    spark.createDataFrame([(1, "x")], "b long, a string").write.parquet(f"{root}/u")
    with open(f"{root}/u/_metadata", "w") as f:
        f.write("no footer")
    inv = lake_inventory(spark, Source("l", "parquet", path=root))
    got = {r["table_name"]: (r["row_count"], list(json.loads(r["table_schema"]).items())) for r in inv.rows.collect()}
    assert got["t"] == (2, [(f.name, f.dataType.simpleString()) for f in spark.read.parquet(f"{root}/t").schema.fields])
    assert got["u"] == (1, [("b", "bigint"), ("a", "string")])


def test_a_table_folder_named_like_a_partition(spark, tmp_path):
    root = str(tmp_path / "lake")
    spark.range(6).selectExpr("id", "id % 2 AS t").write.partitionBy("t").parquet(root)
    facts = _facts(spark, root)
    assert {t: (r["row_count"], r["table_schema"], r["partitioned"]) for t, r in facts.items()} == {
        "t=0": (3, '{"id":"bigint"}', False), "t=1": (3, '{"id":"bigint"}', False)
    }


def test_files_of_different_types(spark, tmp_path):
    root = str(tmp_path / "lake")
    for name, kinds in {"wide": ("int", "long"), "clash": ("long", "string"), "nested": ("struct<x:int>", "struct<x:int,y:string>")}.items():
        for i, kind in enumerate(kinds):
            spark.sql(f"SELECT CAST(NULL AS {kind}) AS a, {i} AS ID").write.mode("append").parquet(f"{root}/{name}")
    inv = lake_inventory(spark, Source("l", "parquet", path=root), robust=True)
    got = {r["table_name"]: json.loads(r["table_schema"]) for r in inv.rows.collect()}
    assert got == {"wide": {"a": "bigint", "ID": "int"}, "nested": {"a": "struct<x:int,y:string>", "ID": "int"}}
    assert [(e["table_name"], e["stage"], "a: bigint, string" in e["message"]) for e in inv.errors.collect()] == [("clash", "schema", True)]
    with pytest.raises(RuntimeError, match="clash"):
        lake_inventory(spark, Source("l", "parquet", path=root))


def test_tasks_need_no_copy_of_the_package(spark, tmp_path):
    """The function that tasks run is pickled by value."""
    from pyspark import cloudpickle

    text = cloudpickle.dumps(footers.read_footers)
    script = tmp_path / "load.py"
    (tmp_path / "f.pkl").write_bytes(text)
    script.write_text(f"import pickle; f = pickle.load(open({str(tmp_path / 'f.pkl')!r}, 'rb')); print(list(f(iter([]))))")
    import subprocess

    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], capture_output=True, text=True, cwd=tmp_path, env=env)
    assert done.stdout.strip() == "[]", done.stderr


def least_common(types):
    """The lattice by pairs, to compare the aggregate with."""
    order = ["tinyint", "smallint", "int", "bigint"]
    digits = dict(zip(order, (3, 5, 10, 20), strict=True))
    kinds = sorted(set(types))
    decimals = [tuple(map(int, re.findall(r"-?\d+", t))) for t in kinds if t.startswith("decimal")]
    if len(kinds) == 1:
        return kinds[0]
    if all(t in order for t in kinds):
        return max(kinds, key=order.index)
    if all(t in order[:3] or t in ("float", "double") for t in kinds):
        return "double"
    if decimals and all(t in order or t.startswith("decimal") for t in kinds):
        scale = max(s for _, s in decimals)
        whole = max([p - s for p, s in decimals] + [digits[t] for t in kinds if t in digits])
        return f"decimal({whole + scale},{scale})" if whole + scale <= 38 else None
    if set(kinds) <= {"date", "timestamp_ntz"}:
        return "timestamp_ntz"
    return None


TYPES = ["tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp_ntz", "timestamp", "string",
         "array<int>", "array<bigint>", "decimal(10,2)", "decimal(38,30)", "decimal(20,0)", "decimal(5,5)"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(TYPES), min_size=1, max_size=4), min_size=1, max_size=40))
def test_type_merge_equals_a_fold_by_pairs(spark, columns):
    rows = [(i, t) for i, types in enumerate(columns) for t in types]
    got = {r["k"]: r for r in merge_types(spark.createDataFrame(rows, "k int, data_type string").repartition(3), ["k"]).collect()}
    for i, types in enumerate(columns):
        expected = least_common(types)
        assert (got[i]["data_type"], got[i]["n"]) == (expected, len(types))
        assert got[i]["conflict"] == (None if expected else ", ".join(sorted(set(types))))


def test_null_types_take_no_part(spark):
    got = merge_types(spark.createDataFrame([(1, None), (1, "int"), (2, None)], "k int, data_type string"), ["k"]).collect()
    assert sorted(map(tuple, got)) == [(1, "int", 2, None), (2, None, 1, None)]


def test_no_tables(spark):
    assert footers.lake_footers(spark, []).count() == 0


def test_tables_at_several_depths(spark, tmp_path):
    a = write_table(spark, str(tmp_path), "a", [(1,)], "x int")
    b = write_table(spark, str(tmp_path / "deep" / "er"), "b", [(1,), (2,)], "y long")
    tables = [lake.LakeTable("d", "a", f"file:{a}", a), lake.LakeTable("e", "b", f"file:{b}", b)]
    got = sorted(tuple(r)[:5] for r in footers.lake_footers(spark, tables).collect())
    assert [(g[0], g[1], g[3], g[4]) for g in got] == [("d", "a", 1, '{"x":"int"}'), ("e", "b", 2, '{"y":"bigint"}')]
