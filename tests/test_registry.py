from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabletally import schemas
from tabletally.plans.registry import load_registry, missing_entries, registry_after_load
from tabletally.sources.registry_store import RegistryTarget, read_registry


def _inv(spark, rows):
    return spark.createDataFrame(rows, schemas.INVENTORY)


ROWS = [
    ("pg1", "postgresql", "sales", "orders", 10, '{"id":"integer"}'),
    ("pg1", "postgresql", "sales", "customers", 0, '{"id":"integer","name":"text"}'),
    ("ms1", "mssql", "hr", "People", 3, '{"ID":"int"}'),
]


def test_first_load_inserts_all_second_adds_nothing(spark, tmp_path):
    target = RegistryTarget(path=str(tmp_path / "registry"))
    inv = _inv(spark, ROWS)
    assert load_registry(spark, inv, target, "2024-03-01") == 3
    assert load_registry(spark, inv, target, "2024-03-02") == 0
    reg = read_registry(spark, target)
    assert reg.count() == 3
    assert {r["created_at"] for r in reg.collect()} == {dt.date(2024, 3, 1)}
    assert all(r["created_at"] == r["updated_at"] for r in reg.collect())


def test_known_key_with_other_count_is_not_missing(spark, tmp_path):
    target = RegistryTarget(path=str(tmp_path / "registry"))
    load_registry(spark, _inv(spark, ROWS[:1]), target, "2024-01-01")
    changed = [("pg1", "postgresql", "sales", "orders", 99, '{"id":"bigint"}')] + ROWS[1:]
    assert load_registry(spark, _inv(spark, changed), target, "2024-02-01") == 2
    orders = [r for r in read_registry(spark, target).collect() if r["table_name"] == "orders"]
    assert len(orders) == 1 and orders[0]["row_count"] == 10  # insert-only registry


def test_absent_registry_reads_empty(spark, tmp_path):
    reg = read_registry(spark, RegistryTarget(path=str(tmp_path / "nothing")))
    assert reg.count() == 0 and reg.schema == schemas.REGISTRY
    missing = missing_entries(_inv(spark, ROWS), reg, "2024-01-01")
    assert missing.count() == 3 and missing.columns == schemas.REGISTRY_COLUMNS


def test_matching_is_case_sensitive_and_duplicates_collapse(spark):
    reg = registry_after_load(_inv(spark, ROWS), spark.createDataFrame([], schemas.REGISTRY), "2024-01-01")
    batch = _inv(spark, [("pg1", "postgresql", "sales", "ORDERS", 1, "{}")] * 2)
    assert missing_entries(batch, reg, "2024-01-02").count() == 1


def test_null_key_is_refused(spark, tmp_path):
    bad = spark.createDataFrame(
        [("pg1", "postgresql", None, "t", 1, "{}")],
        "source_name string, database_type string, database_name string, table_name string, row_count long, table_schema string",
    )
    with pytest.raises(ValueError):
        load_registry(spark, bad, RegistryTarget(path=str(tmp_path / "r")), "2024-01-01")


def test_target_needs_exactly_one_place():
    with pytest.raises(ValueError):
        RegistryTarget()


names = st.sampled_from(["a", "b", "c", "d"])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(names, names), max_size=12), st.lists(st.tuples(names, names), max_size=12))
def test_registry_properties(spark, known, incoming):
    reg_rows = [("s", "parquet", d, t, 1, "{}", dt.date(2020, 1, 1), dt.date(2020, 1, 1)) for d, t in set(known)]
    reg = spark.createDataFrame(reg_rows, schemas.REGISTRY)
    inv = _inv(spark, [("s", "parquet", d, t, 5, "{}") for d, t in incoming])
    after = registry_after_load(inv, reg, "2024-01-01")
    keys = [(r["database_name"], r["table_name"]) for r in after.collect()]
    # each incoming key exactly once, old rows unchanged, rerun empty
    assert len(keys) == len(set(keys))
    assert set(keys) == set(known) | set(incoming)
    old = {(r[2], r[3]): r for r in reg_rows}
    for r in after.collect():
        if (r["database_name"], r["table_name"]) in old:
            assert r["created_at"] == dt.date(2020, 1, 1)
    assert missing_entries(inv, after, "2024-01-02").count() == 0


def test_failed_append_is_retried_without_duplicates(spark, tmp_path, monkeypatch):
    """The first append commits and then fails; the retried load adds nothing twice."""
    import tabletally.plans.registry as R

    target = RegistryTarget(path=str(tmp_path / "registry"))
    real_append = R.append_registry
    calls = {"n": 0}

    def flaky_append(df, t):
        calls["n"] += 1
        real_append(df, t)
        if calls["n"] == 1:
            raise RuntimeError("lost the driver's ack after the commit")

    monkeypatch.setattr(R, "append_registry", flaky_append)
    assert R.load_registry(spark, _inv(spark, ROWS), target, "2024-01-01", delay_s=0) == 0
    assert read_registry(spark, target).count() == len(ROWS)


def test_small_append_writes_one_file(spark, tmp_path):
    import glob

    target = RegistryTarget(path=str(tmp_path / "registry"))
    load_registry(spark, _inv(spark, ROWS), target, "2024-01-01")
    assert len(glob.glob(str(tmp_path / "registry" / "*.parquet"))) == 1
