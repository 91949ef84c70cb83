from __future__ import annotations

import pytest
from test_plans import _plan, big_data_planning

from tabletally import schemas
from tabletally.plans.registry import missing_entries, registry_after_load
from tabletally.sources.bucketed import BucketedRegistry

ROWS = [("lake", "parquet", "main", f"t{i}", i, "{}") for i in range(50)]


@pytest.fixture
def registry(spark, tmp_path):
    out = BucketedRegistry(str(tmp_path / "reg'istry"), buckets=4)
    known = registry_after_load(spark.createDataFrame(ROWS[:30], schemas.INVENTORY), spark.createDataFrame([], schemas.REGISTRY), "2024-01-01")
    out.append(known)
    yield out
    spark.sql(f"DROP TABLE IF EXISTS {out.table}")


def test_missing_rows_and_second_append(spark, registry):
    batch = spark.createDataFrame(ROWS, schemas.INVENTORY)
    missing = missing_entries(batch, registry.attach(spark), "2024-02-01", unique=True)
    assert sorted(r["row_count"] for r in missing.collect()) == list(range(30, 50))
    registry.append(missing)
    assert registry.attach(spark).count() == 50
    assert missing_entries(batch, registry.attach(spark), "2024-02-02", unique=True).count() == 0


def test_the_registry_is_not_shuffled(spark, registry):
    batch = spark.createDataFrame(ROWS, schemas.INVENTORY)
    with big_data_planning(spark):
        plan = _plan(missing_entries(batch, registry.attach(spark), "2024-02-01", unique=True))
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if "FileScan parquet" in line]
    assert scans and all("Bucketed: true" in lines[i] for i in scans)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for i in scans:
        above, at = [], depth(lines[i])
        for line in reversed(lines[:i]):
            if depth(line) < at:
                above.append(line)
                at = depth(line)
        assert not any("Exchange" in line for line in above), plan


def test_the_registered_query_does_not_shuffle_the_registry(spark):
    """Its inventory has constant key columns, which must not leave the join's keys."""
    from conftest import SF_SMALL

    from tabletally.plans.queries import registry_missing_bucketed

    with big_data_planning(spark):
        lines = _plan(registry_missing_bucketed(spark, SF_SMALL)).splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    scan = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    assert "Bucketed: true" in lines[scan]
    at = depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < at:
            assert "Exchange" not in line
            at = depth(line)


def test_attached_again_by_path(spark, registry):
    spark.sql(f"DROP TABLE {registry.table}")  # as a new session would find it: files without a table
    assert BucketedRegistry(registry.path, buckets=4).attach(spark).count() == 30


def test_an_absent_registry_is_empty(spark, tmp_path):
    registry = BucketedRegistry(str(tmp_path / "absent"), buckets=2)
    try:
        assert missing_entries(spark.createDataFrame(ROWS, schemas.INVENTORY), registry.attach(spark), "2024-01-01").count() == 50
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {registry.table}")


def test_load_and_sync_into_a_bucketed_registry(spark, tmp_path):
    from conftest import write_table

    from tabletally.plans.registry import load_registry
    from tabletally.plans.sync import sync_registry
    from tabletally.sources.model import Source
    from tabletally.sources.registry_store import RegistryTarget, read_registry

    target = RegistryTarget(path=str(tmp_path / "r"), buckets=4)
    assert load_registry(spark, spark.createDataFrame(ROWS[:20], schemas.INVENTORY), target, "2024-01-01") == 20
    assert load_registry(spark, spark.createDataFrame(ROWS, schemas.INVENTORY), target, "2024-01-02", sources=["lake"]) == 30
    assert load_registry(spark, spark.createDataFrame(ROWS, schemas.INVENTORY), target, "2024-01-03") == 0
    root = str(tmp_path / "wh")
    write_table(spark, root, "t", [(1,)], "id long")
    src = Source("wh", "parquet", path=root)
    assert [sync_registry(spark, [src], target, as_of="2024-01-04").inserted for _ in range(2)] == [1, 0]
    assert read_registry(spark, target).count() == 51 and read_registry(spark, target, ["wh"]).count() == 1
    with pytest.raises(ValueError):
        RegistryTarget(path="x", buckets=0)
