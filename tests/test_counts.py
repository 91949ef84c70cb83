from __future__ import annotations

import os

from conftest import SF_SMALL, write_table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tabletally.operators.counts import count_by_halves, count_lake_rows
from tabletally.plans.queries import LAKE_TABLES, lake_source
from tabletally.sources import lake
from tabletally.sources.model import Source


def _counts(df):
    return {r["table_name"]: r["row_count"] for r in df.collect()}


def test_one_scan_equals_per_table_counts(spark):
    src = lake_source(SF_SMALL)
    tables = lake.list_lake_tables(spark, src)
    assert sorted(t.name for t in tables) == sorted(LAKE_TABLES)
    one_scan = _counts(count_lake_rows(spark, tables, "main"))
    expected = {t: spark.read.parquet(f"{SF_SMALL}/{t}.parquet").count() for t in LAKE_TABLES}
    assert one_scan == expected


def test_scan_reads_no_column_data(spark):
    src = lake_source(SF_SMALL)
    df = count_lake_rows(spark, lake.list_lake_tables(spark, src), "main")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in plan
    for col in ("l_orderkey", "o_orderkey", "text", "embedding"):
        assert col not in plan


def test_odd_names_empty_tables_and_folders(spark, tmp_path):
    root = str(tmp_path / "lake")
    names = {
        "plain": 5, "my table": 3, "quo'te": 2, "plus+x": 4, "pct%20y": 6, "Ünï": 1, "Upper": 7, "select": 2,
        # glob and URI characters: a reader must take these paths literally
        "q?x": 1, "qax": 3, "br[1]": 2, "br1": 4, "brace{1}": 1, "a#b": 2, "k=v": 3, "semi;colon": 1, "日本": 2,
    }
    for n, k in names.items():
        write_table(spark, root, n, [(i, f"v{i}") for i in range(k)], "id long, v string", files=3)
    write_table(spark, root, "empty_tbl", [], "id long")
    os.makedirs(os.path.join(root, "no_files"))
    os.makedirs(os.path.join(root, "_hidden"))
    with open(os.path.join(root, "notes.txt"), "w") as f:
        f.write("not a table")
    src = Source("lake", "parquet", path=root)
    tables = lake.list_lake_tables(spark, src)
    got = _counts(count_lake_rows(spark, tables, "main"))
    assert got == {**names, "empty_tbl": 0, "no_files": 0}


def test_partitioned_table_folder(spark, tmp_path):
    root = str(tmp_path / "lake")
    df = spark.range(100).selectExpr("id", "id % 4 AS part")
    df.write.partitionBy("part").parquet(os.path.join(root, "events_by_part"))
    spark.range(10).write.parquet(os.path.join(root, "flat.parquet"))
    got = _counts(count_lake_rows(spark, lake.list_lake_tables(spark, Source("l", "parquet", path=root)), "main"))
    assert got == {"events_by_part": 100, "flat": 10}


def test_fallback_reports_corrupt_table(spark, tmp_path):
    root = str(tmp_path / "lake")
    write_table(spark, root, "good", [(1,), (2,)], "id long")
    os.makedirs(os.path.join(root, "bad"))
    with open(os.path.join(root, "bad", "part-00000.parquet"), "wb") as f:
        f.write(b"this is not parquet at all")
    tables = lake.list_lake_tables(spark, Source("l", "parquet", path=root))
    counts, errors = count_by_halves(spark, tables, "main")
    assert counts == [("main", "good", 2)]
    assert [(e[0], e[1], e[2]) for e in errors] == [("main", "bad", "count")]
    assert len(errors[0][3].splitlines()) > 1  # the whole message, with the cause in its later lines


def test_no_tables_gives_typed_empty_frame(spark, tmp_path):
    root = str(tmp_path / "empty_lake")
    os.makedirs(root)
    df = count_lake_rows(spark, lake.list_lake_tables(spark, Source("l", "parquet", path=root)), "main")
    assert df.count() == 0 and df.columns == ["database_name", "table_name", "row_count"]


_NAME_CHARS = "abcXYZ09 _-+%#?[]{}'=éü日"


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.dictionaries(
        st.text(alphabet=_NAME_CHARS, min_size=1, max_size=8).filter(
            lambda n: not n.startswith(("_", ".")) and n.strip() == n
        ),
        st.tuples(st.integers(0, 40), st.integers(1, 3)),
        min_size=1,
        max_size=6,
    )
)
def test_random_lakes_against_known_counts(spark, tmp_path_factory, spec):
    root = str(tmp_path_factory.mktemp("rand") / "lake")
    for name, (rows, files) in spec.items():
        write_table(spark, root, name, [(i,) for i in range(rows)], "id long", files=files)
    tables = lake.list_lake_tables(spark, Source("r", "parquet", path=root))
    assert _counts(count_lake_rows(spark, tables, "main")) == {n: r for n, (r, _) in spec.items()}


def test_tables_from_two_roots_at_different_depths(spark, tmp_path):
    flat = str(tmp_path / "flat")
    deep = str(tmp_path / "a" / "b" / "deep")
    write_table(spark, flat, "t1", [(1,), (2,)], "id long")
    write_table(spark, deep, "t2", [(1,)], "id long")
    tables = lake.list_lake_tables(spark, Source("f", "parquet", path=flat)) + lake.list_lake_tables(
        spark, Source("d", "parquet", path=deep, database="other")
    )
    got = {(r[0], r[1]): r[2] for r in count_lake_rows(spark, tables).collect()}
    assert got == {("main", "t1"): 2, ("other", "t2"): 1}
