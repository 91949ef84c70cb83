from __future__ import annotations

import json
import os

import pytest
from conftest import SF_SMALL, write_table

from tabletally import schemas
from tabletally.functions.errors import error_text
from tabletally.plans.inventory import inventory_all, lake_inventory, source_inventory
from tabletally.plans.queries import LAKE_TABLES, lake_source
from tabletally.sources.model import Source


def _by_table(df):
    return {r["table_name"]: r for r in df.collect()}


def test_lake_inventory_matches_spark_metadata(spark):
    inv = lake_inventory(spark, lake_source(SF_SMALL))
    assert inv.rows.columns == schemas.INVENTORY_COLUMNS
    rows = _by_table(inv.rows)
    assert sorted(rows) == sorted(LAKE_TABLES)
    for t in LAKE_TABLES:
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        r = rows[t]
        assert (r["source_name"], r["database_type"], r["database_name"]) == ("lake", "parquet", "main")
        assert r["row_count"] == df.count()
        got = json.loads(r["table_schema"])
        assert list(got) == df.columns  # ordinal order
        assert got == {f.name: f.dataType.simpleString() for f in df.schema.fields}
    assert inv.errors.count() == 0


def test_edge_cases_of_a_lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_table(spark, root, "zero", [], "a int, b string")
    write_table(spark, root, "My Table", [(1, "x"), (2, "y")], "ID long, `Name With Space` string")
    write_table(spark, root, "skip_me", [(1,)], "a int")
    os.makedirs(os.path.join(root, "no_files_yet"))
    src = Source("lake2", "parquet", path=root, database="db", exclude_tables=("skip_me",))
    inv = lake_inventory(spark, src, robust=True)
    rows = _by_table(inv.rows)
    assert sorted(rows) == ["My Table", "no_files_yet", "zero"]
    assert inv.errors.count() == 0
    assert rows["zero"]["row_count"] == 0
    assert (rows["no_files_yet"]["row_count"], rows["no_files_yet"]["table_schema"]) == (0, "{}")
    assert rows["My Table"]["table_schema"] == '{"ID":"bigint","Name With Space":"string"}'


def test_unreadable_table_goes_to_errors(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_table(spark, root, "good", [(1,), (2,), (3,)], "a int")
    os.makedirs(os.path.join(root, "broken"))
    with open(os.path.join(root, "broken", "part-0.parquet"), "wb") as f:
        f.write(b"PAR1 not really")
    inv = lake_inventory(spark, Source("l", "parquet", path=root), robust=True)
    assert {r["table_name"]: r["row_count"] for r in inv.rows.collect()} == {"good": 3}
    errs = inv.errors.collect()
    assert {e["table_name"] for e in errs} == {"broken"}
    assert all(e["source_name"] == "l" for e in errs)


def test_no_tables_at_all(spark, tmp_path):
    root = str(tmp_path / "none")
    os.makedirs(root)
    inv = lake_inventory(spark, Source("l", "parquet", path=root))
    assert inv.rows.count() == 0 and inv.rows.columns == schemas.INVENTORY_COLUMNS


def test_several_sources_in_one_plan(spark):
    sources = [
        lake_source(SF_SMALL, name="a", database="a", include_tables=("region", "nation")),
        lake_source(SF_SMALL, name="b", database="b", include_tables=("orders",)),
    ]
    inv = inventory_all(spark, sources)
    got = sorted((r["source_name"], r["database_name"], r["table_name"], r["row_count"]) for r in inv.rows.collect())
    assert got == [("a", "a", "nation", 25), ("a", "a", "region", 5), ("b", "b", "orders", 1500)]
    assert inventory_all(spark, []).rows.count() == 0


def test_unknown_source_kind():
    with pytest.raises(ValueError, match="Unsupported source type"):
        Source("x", "mongodb", host="h")


def test_dispatch_on_files(spark):
    inv = source_inventory(spark, lake_source(SF_SMALL, include_tables=("region",)))
    assert [r["row_count"] for r in inv.rows.collect()] == [5]


def test_orc_lake(spark, tmp_path):
    root = str(tmp_path / "orc_lake")
    for t in ("region", "nation", "orders"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").write.orc(os.path.join(root, t))
    inv = lake_inventory(spark, Source("o", "orc", path=root), robust=True)
    got = {r["table_name"]: (r["row_count"], list(json.loads(r["table_schema"]))) for r in inv.rows.collect()}
    for t in ("region", "nation", "orders"):
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        assert got[t] == (df.count(), df.columns)


def test_a_missing_source_does_not_stop_the_others(spark, tmp_path):
    sources = [
        Source("gone", "parquet", path=str(tmp_path / "no_such_folder")),
        lake_source(SF_SMALL, name="ok", include_tables=("region",)),
    ]
    inv = inventory_all(spark, sources, robust=True)
    assert [(r["source_name"], r["table_name"]) for r in inv.rows.collect()] == [("ok", "region")]
    errs = inv.errors.collect()
    assert [(e["source_name"], e["stage"]) for e in errs] == [("gone", "source")]
    with pytest.raises(Exception):
        inventory_all(spark, sources, robust=False).rows.collect()


def test_columns_of_all_files_of_a_table(spark, tmp_path):
    root = str(tmp_path / "lake")
    for kind in ("parquet", "orc"):
        path = os.path.join(root, kind, "t")
        spark.createDataFrame([(1,)], "id long").write.format(kind).save(path)
        spark.createDataFrame([(2, "x")], "id long, added string").write.format(kind).mode("append").save(path)
        inv = lake_inventory(spark, Source("l", kind, path=os.path.join(root, kind)))
        assert json.loads(inv.rows.first()["table_schema"]) == {"id": "bigint", "added": "string"}


def test_without_robust_an_unreadable_table_raises(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_table(spark, root, "good", [(1,)], "a int")
    os.makedirs(os.path.join(root, "broken"))
    with open(os.path.join(root, "broken", "part-0.parquet"), "wb") as f:
        f.write(b"PAR1 not really")
    with pytest.raises(RuntimeError, match="broken"):
        lake_inventory(spark, Source("l", "parquet", path=root))


def test_an_error_without_a_message_is_reported_by_its_type():
    assert error_text(KeyError()) == "KeyError"
    assert error_text(ValueError("first\nthe cause")) == "first\nthe cause"
