from __future__ import annotations

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabletally.operators.insert_missing import insert_missing, latest_per_key, missing_rows

DDL = "k long, v double, s string"


def test_latest_per_key_picks_highest_order(spark):
    df = spark.createDataFrame([(1, 1.0, "a"), (1, 3.0, "b"), (1, 2.0, "c"), (2, 5.0, "d")], DDL)
    got = sorted(tuple(r) for r in latest_per_key(df, ["k"], ["v"]).collect())
    assert got == [(1, 3.0, "b"), (2, 5.0, "d")]


def test_ties_are_broken_by_the_row(spark):
    rows = [(1, 1.0, "a"), (1, 1.0, "c"), (1, 1.0, "b")]
    for _ in range(3):
        df = spark.createDataFrame(rows, DDL).repartition(3)
        assert [tuple(r) for r in latest_per_key(df, ["k"], ["v"]).collect()] == [(1, 1.0, "c")]


def test_hot_key_third_of_rows(spark):
    n = 30000
    rows = [(0 if i % 3 == 0 else i, float(i), f"s{i}") for i in range(n)]
    df = spark.createDataFrame(rows, DDL).repartition(8)
    target = spark.createDataFrame([(i, 0.0, "") for i in range(1, 100)], DDL)
    got = {r["k"]: (r["v"], r["s"]) for r in missing_rows(df, target, ["k"], ["v"]).collect()}
    hot = max(i for i in range(n) if i % 3 == 0)
    assert got[0] == (float(hot), f"s{hot}")
    assert len(got) == 1 + sum(1 for i in range(n) if i % 3 and i >= 100)


def test_null_keys_never_inserted(spark):
    batch = spark.createDataFrame([(None, 1.0, "x"), (1, 1.0, "y")], DDL)
    target = spark.createDataFrame([], DDL)
    assert [r["k"] for r in missing_rows(batch, target, ["k"]).collect()] == [1]
    with pytest.raises(ValueError):
        insert_missing(batch, target, lambda df: None, ["k"])


def test_insert_twice_adds_nothing(spark, tmp_path):
    path = str(tmp_path / "target")
    spark.createDataFrame([(1, 0.0, "old")], DDL).write.parquet(path)
    batch = spark.createDataFrame([(1, 9.0, "new"), (2, 1.0, "a"), (2, 2.0, "b"), (3, 1.0, "c")], DDL)

    def run():
        target = spark.read.parquet(path)
        return insert_missing(batch, target, lambda df: df.write.mode("append").parquet(path), ["k"], ["v"])

    assert run() == 2
    assert run() == 0
    got = sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert got == [(1, 0.0, "old"), (2, 2.0, "b"), (3, 1.0, "c")]


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(st.integers(0, 30), st.integers(0, 5)), max_size=40),
    st.lists(st.integers(0, 30), max_size=30),
)
def test_properties_against_brute_force(spark, batch_rows, target_keys):
    batch = spark.createDataFrame([(k, float(v), str(v)) for k, v in batch_rows], DDL)
    target = spark.createDataFrame([(k, 0.0, "") for k in target_keys], DDL)
    got = sorted(tuple(r) for r in missing_rows(batch, target, ["k"], ["v"]).collect())
    best: dict[int, tuple] = {}
    for k, v in batch_rows:
        row = (k, float(v), str(v))
        if k not in best or row > best[k]:
            best[k] = row
    expected = sorted(r for k, r in best.items() if k not in set(target_keys))
    assert got == expected
    # missing ∪ known = batch keys, and missing ∩ known = ∅
    keys = {r[0] for r in got}
    assert keys | (set(target_keys) & {k for k, _ in batch_rows}) == {k for k, _ in batch_rows}
    assert not keys & set(target_keys)


def test_null_keys_left_out_when_not_rejected(spark, tmp_path):
    path = str(tmp_path / "t")
    batch = spark.createDataFrame([(None, 1.0, "x"), (None, 2.0, "y"), (1, 1.0, "a"), (2, 1.0, "b")], DDL)
    target = spark.createDataFrame([(2, 0.0, "")], DDL)
    n = insert_missing(batch, target, lambda df: df.write.parquet(path), ["k"], reject_null_keys=False)
    assert n == 1
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [(1, 1.0, "a")]


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 20)), st.integers(0, 3)), max_size=30),
    st.lists(st.one_of(st.none(), st.integers(0, 20)), max_size=30),
)
def test_a_unique_batch_needs_no_reduction(spark, batch_rows, target_keys):
    rows = {k: (k, float(v), str(v)) for k, v in batch_rows}
    batch = spark.createDataFrame([*rows.values()], DDL)
    target = spark.createDataFrame([(k, 0.0, "") for k in target_keys], DDL)
    plain = missing_rows(batch, target, ["k"], ["v"], keep_null_keys=True)
    unique = missing_rows(batch, target, ["k"], keep_null_keys=True, unique=True)
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, unique.collect()))


def test_the_count_does_not_depend_on_how_the_sink_runs(spark, tmp_path):
    """A sink that asks for the rows as an RDD first, as JDBC does, gets and reports the same rows."""
    from tabletally.operators.insert_missing import insert_missing

    batch = spark.createDataFrame([(i, float(i), "x") for i in range(20)], DDL)
    target = spark.createDataFrame([(i, 0.0, "") for i in range(5)], DDL)
    written = []

    def rdd_sink(df):
        df.rdd.getNumPartitions()
        written.extend(df.rdd.map(tuple).collect())

    assert insert_missing(batch, target, rdd_sink, ["k"]) == 15 == len(written)
    path = str(tmp_path / "out")
    assert insert_missing(batch, target, lambda df: df.write.parquet(path), ["k"]) == 15
    assert spark.read.parquet(path).count() == 15
    assert insert_missing(batch, batch, rdd_sink, ["k"]) == 0


def test_python_tasks_run_after_a_write(spark, tmp_path):
    """A write leaves nothing behind that later plans would carry to their tasks."""
    from tabletally.operators.insert_missing import insert_missing

    batch = spark.createDataFrame([(1, 1.0, "x")], DDL)
    assert insert_missing(batch, batch.limit(0), lambda df: df.write.parquet(str(tmp_path / "o")), ["k"]) == 1
    assert spark.range(3).mapInArrow(lambda it: it, "id long").count() == 3
