"""Listings made by tasks and the catalog data source against the driver's listing."""

from __future__ import annotations

import os

import pytest
from conftest import write_table

from tabletally.plans.catalog import list_tables
from tabletally.sources import lake_catalog
from tabletally.sources.model import Source


@pytest.fixture
def source(spark, tmp_path):
    root = str(tmp_path / "ware house")
    for db, table in (("sales.db", "orders"), ("sales.db", "ü t%20+x"), ("hr", "people.parquet"), ("hr", "orders"), ("tmp", "scratch"), ("_hidden", "y")):
        write_table(spark, os.path.join(root, db), table, [(1,)], "id long", files=1)
    os.makedirs(f"{root}/empty_db")
    os.makedirs(f"{root}/hr/no_files_yet")
    write_table(spark, str(tmp_path / "one"), "f", [(1,)], "id long", files=1)
    part = next(f for f in os.listdir(tmp_path / "one" / "f") if f.endswith(".parquet"))
    os.rename(tmp_path / "one" / "f" / part, f"{root}/hr/single.parquet")
    open(f"{root}/hr/notes.txt", "w").close()
    return Source("wh", "parquet", path=root, layout="database/table", exclude_databases=("tmp",), exclude_tables=("people",))


def rows(df):
    return sorted(tuple(r)[:2] for r in df.collect())


def test_tasks_list_what_the_driver_lists(spark, source):
    expected = rows(list_tables(spark, source))
    assert ("sales", "ü t%20+x") in expected and ("hr", "no_files_yet") in expected and ("hr", "single") in expected
    assert rows(lake_catalog.list_tables(spark, source)) == expected
    flat = Source("f", "parquet", path=os.path.join(source.path, "hr"), database="x", include_tables=("orders", "single"))
    assert rows(lake_catalog.list_tables(spark, flat)) == rows(list_tables(spark, flat)) == [("x", "orders"), ("x", "single")]


def test_three_levels(spark, tmp_path):
    expected = []
    for a in "ab":
        for b in ("x y", "z"):
            for c in ("1", "2"):
                os.makedirs(tmp_path / "lake" / a / b / c)
                expected.append(f"{a}/{b}/{c}".replace(" ", "%20"))
    got = lake_catalog.list_levels(spark, str(tmp_path / "lake"), 3).collect()
    assert sorted("/".join(r["uri"].split("/")[-3:]) for r in got) == expected


def test_catalog_rows_and_pushed_filters(spark, source):
    everything = [("hr", "no_files_yet"), ("hr", "orders"), ("hr", "people"), ("hr", "single"), ("sales", "orders"), ("sales", "ü t%20+x"), ("tmp", "scratch")]
    assert rows(lake_catalog.catalog(spark, source)) == everything
    name = "spark.sql.python.filterPushdown.enabled"
    spark.conf.set(name, "true")
    try:
        df = lake_catalog.catalog(spark, source)
        assert rows(df) == everything
        assert rows(df.where("database_name = 'sales' AND table_name IN ('orders', 'x')")) == [("sales", "orders")]
        assert rows(df.where("database_name = 'hr' AND database_name = 'sales'")) == []
        assert rows(df.where("table_name LIKE 'o%'")) == [("hr", "orders"), ("sales", "orders")]
        one = df.where("database_name = 'sales'")
        assert one.rdd.getNumPartitions() == 1 < df.rdd.getNumPartitions()
        plan = one._jdf.queryExecution().executedPlan().toString()
        assert "Filter" not in plan.split("BatchScan")[0]  # Spark has nothing left to filter
    finally:
        spark.conf.unset(name)


def test_readers_take_what_they_can():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    reader = lake_catalog.FilteredReader({"path": "/nowhere", "layout": "database/table"})
    other = [GreaterThan(("table_name",), "a"), EqualTo(("path",), "x")]
    assert list(reader.pushFilters([EqualTo(("database_name",), "a"), In(("database_name",), ("a", "b")), *other])) == other
    assert reader.wanted == {"database_name": {"a"}}


def test_a_store_that_arrow_does_not_know(spark, source, monkeypatch):
    monkeypatch.setattr(lake_catalog, "can_open", lambda uri: False)
    assert rows(lake_catalog.list_tables(spark, source)) == rows(list_tables(spark, source))
    assert len(rows(lake_catalog.catalog(spark, source))) == 7
