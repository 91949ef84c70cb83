from __future__ import annotations

import re

import duckdb
import pytest

from tabletally.llm import mixing

SF = "/root/testdata/sf0.001"


def test_query_equals_duckdb(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    rel = con.execute(mixing.OP9_SQL)
    names = [c[0] for c in rel.description]
    expected = sorted((dict(zip(names, r, strict=True)) for r in rel.fetchall()), key=lambda r: r["doc_id"])
    df = mixing.op9_mixing(spark, SF)
    assert [r.asDict() for r in df.orderBy("doc_id").collect()] == expected
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def levels(sizes: dict) -> dict:
    """Targets by plain water filling."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    target, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > 3 * sizes[s]}
        if not full:
            return target | {s: weight[s] * level for s in open_}
        for s in full:
            target[s] = 3.0 * sizes[s]
        left -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [{"a": 50, "b": 50, "c": 50}, {"a": 1, "b": 2, "c": 1000, None: 3}, {"x": 0, "y": 10}, {"z": 40, "": 7}])
def test_targets_and_taken(spark, sizes):
    rows, n = [], 0
    for source, size in sizes.items():
        for _ in range(max(size, 1)):
            rows.append((n, "w" if size else None, source))
            n += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df, rows_per_bucket=16).select("row.*", "size", "source_size", "target", "taken", "copies", "positions").collect()
    want = levels(sizes)
    assert len(got) == len(rows)
    for source, size in sizes.items():
        mine = [r for r in got if r.source == source]
        assert {(r.source_size, round(r.target, 9)) for r in mine} == {(size, round(want[source], 9))}
        assert abs(sum(r.taken for r in mine) - want[source]) <= 1
        for r in mine:
            assert r.taken == r.copies * r.size <= 3 * r.size
            assert len(r.positions) == (r.copies if want[source] else 0)
            assert all(0 <= p <= 1 for p in r.positions) and r.positions == sorted(r.positions)


def test_a_rerun_and_other_bucket_counts_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    key = lambda df: sorted((r.row.doc_id, r.taken, r.positions) for r in df.collect())
    a = key(mixing.mix(docs, carry=["doc_id"], rows_per_bucket=5))
    assert a == key(mixing.mix(docs.repartition(7), carry=["doc_id"], rows_per_bucket=1000))


def test_schedules_fall_and_rise(spark):
    docs = spark.range(3000).selectExpr("id AS doc_id", "'a b c' AS text", "IF(id % 2 = 0, 'even', 'odd') AS source")
    mixed = mixing.mix(docs, weights=(1,), slopes=(1.0, -1.0))
    early = {r.source: r.n for r in mixed.selectExpr("row.source AS source", "explode(positions) AS p").where("p < 0.25").groupBy("source").agg({"p": "count"}).withColumnRenamed("count(p)", "n").collect()}
    # integral of 1 + s (1/2 - t) up to a quarter
    assert abs(early["even"] / 1500 - (0.25 + 0.09375)) < 0.01 and abs(early["odd"] / 1500 - (0.25 - 0.09375)) < 0.01


def test_training_order_and_odd_tables(spark):
    rows = [(1, None, None, "x"), (1, None, None, "x"), (None, "a b", "s", "x"), (2, "", "s", "x"), (3, "w " * 50_000, "t", "x"), (3, "w " * 50_000, "t", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, target string")
    ordered = mixing.training_order(mixing.mix(df))
    assert ordered.columns == df.columns
    mixed = mixing.mix(df).collect()
    assert len(mixed) == 6 and ordered.count() == sum(len(r.positions) for r in mixed)
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.where("text IS NULL")).agg({"taken": "sum"}).first()[0] == 0
