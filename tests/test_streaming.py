from __future__ import annotations

from tabletally import schemas
from tabletally.sources.registry_store import RegistryTarget, read_registry
from tabletally.streaming.registry_stream import start_registry_stream


def test_snapshots_load_each_key_once(spark, tmp_path):
    snaps = str(tmp_path / "snapshots")
    target = RegistryTarget(path=str(tmp_path / "registry"))
    day1 = [("s", "parquet", "main", "a", 1, "{}"), ("s", "parquet", "main", "b", 2, "{}")]
    day2 = [("s", "parquet", "main", "b", 3, "{}"), ("s", "parquet", "main", "c", 4, "{}")]
    spark.createDataFrame(day1, schemas.INVENTORY).write.mode("append").parquet(snaps)
    q = start_registry_stream(spark, snaps, target, str(tmp_path / "ckpt"), as_of="2024-01-01")
    q.awaitTermination(120)
    spark.createDataFrame(day2, schemas.INVENTORY).write.mode("append").parquet(snaps)
    q = start_registry_stream(spark, snaps, target, str(tmp_path / "ckpt"), as_of="2024-01-02")
    q.awaitTermination(120)
    reg = {r["table_name"]: r for r in read_registry(spark, target).collect()}
    assert sorted(reg) == ["a", "b", "c"]
    assert reg["b"]["row_count"] == 2  # insert-only: first sighting kept
    assert str(reg["c"]["created_at"]) == "2024-01-02"


def test_default_checkpoints_differ_per_registry(spark, tmp_path):
    snaps = str(tmp_path / "snaps")
    spark.createDataFrame([("s", "parquet", "main", "a", 1, "{}")], schemas.INVENTORY).write.parquet(snaps)
    q1 = start_registry_stream(spark, snaps, RegistryTarget(path=str(tmp_path / "r1")), as_of="2024-01-01")
    q1.awaitTermination(120)
    q2 = start_registry_stream(spark, snaps, RegistryTarget(path=str(tmp_path / "r2")), as_of="2024-01-01")
    q2.awaitTermination(120)
    # the second stream has its own offsets, so it loads the same snapshot into its own registry
    assert read_registry(spark, RegistryTarget(path=str(tmp_path / "r2"))).count() == 1
