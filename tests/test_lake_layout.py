"""A lake with one folder per database: root/<database>[.db]/<table>."""

from __future__ import annotations

import os

import pytest
from conftest import write_table

from tabletally.operators.counts import count_lake_rows
from tabletally.plans.catalog import list_databases, list_tables
from tabletally.plans.inventory import lake_inventory
from tabletally.plans.sync import sync_registry
from tabletally.sources import lake
from tabletally.sources.model import Source
from tabletally.sources.registry_store import RegistryTarget


@pytest.fixture
def warehouse(spark, tmp_path):
    root = str(tmp_path / "warehouse")
    write_table(spark, os.path.join(root, "sales.db"), "orders", [(i,) for i in range(3)], "id long")
    write_table(spark, os.path.join(root, "sales.db"), "items", [(1, "a"), (2, "b")], "id long, name string")
    write_table(spark, os.path.join(root, "hr"), "people", [(1,)], "id long")
    write_table(spark, os.path.join(root, "hr"), "orders", [(i, "x") for i in range(4)], "id long, note string")
    write_table(spark, os.path.join(root, "tmp"), "scratch", [(1,)], "id long")
    write_table(spark, os.path.join(root, "_hidden"), "y", [(1,)], "id long")
    return Source("wh", "parquet", path=root, layout="database/table", exclude_databases=("tmp",))


def test_databases_and_tables(spark, warehouse):
    assert [r[0] for r in list_databases(spark, warehouse).collect()] == ["hr", "sales"]
    got = sorted(tuple(r) for r in list_tables(spark, warehouse).collect())
    assert got == [("hr", "orders"), ("hr", "people"), ("sales", "items"), ("sales", "orders")]


def test_same_table_name_in_two_databases_counted_apart_in_one_scan(spark, warehouse):
    tables = lake.list_lake_tables(spark, warehouse)
    counts = {(r[0], r[1]): r[2] for r in count_lake_rows(spark, tables).collect()}
    assert counts == {("hr", "orders"): 4, ("hr", "people"): 1, ("sales", "items"): 2, ("sales", "orders"): 3}


def test_inventory_and_errors_keep_the_database(spark, warehouse):
    os.makedirs(os.path.join(warehouse.path, "hr", "broken"))
    with open(os.path.join(warehouse.path, "hr", "broken", "part-0.parquet"), "wb") as f:
        f.write(b"not parquet")
    inv = lake_inventory(spark, warehouse, robust=True)
    rows = {(r["database_name"], r["table_name"]): (r["row_count"], r["table_schema"]) for r in inv.rows.collect()}
    assert rows[("hr", "orders")] == (4, '{"id":"bigint","note":"string"}')
    assert rows[("sales", "orders")] == (3, '{"id":"bigint"}')
    assert len(rows) == 4
    assert [(e["database_name"], e["table_name"]) for e in inv.errors.collect()] == [("hr", "broken")]


def test_sync_picks_up_a_new_table_in_one_database(spark, warehouse, tmp_path):
    target = RegistryTarget(path=str(tmp_path / "registry"))
    assert sync_registry(spark, [warehouse], target, as_of="2024-01-01").inserted == 4
    write_table(spark, os.path.join(warehouse.path, "sales.db"), "returns", [(1,), (2,)], "id long")
    report = sync_registry(spark, [warehouse], target, as_of="2024-01-02")
    assert (report.listed, report.inventoried, report.inserted) == (5, 1, 1)


def test_unknown_layout():
    with pytest.raises(ValueError):
        Source("x", "parquet", path="/x", layout="nested")


def test_only_narrows_to_exact_keys(spark, warehouse):
    from tabletally.plans.inventory import inventory_all

    inv = inventory_all(spark, [warehouse], only={"wh": {("hr", "orders")}})
    assert [(r["database_name"], r["table_name"], r["row_count"]) for r in inv.rows.collect()] == [("hr", "orders", 4)]
