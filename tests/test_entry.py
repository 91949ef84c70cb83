from __future__ import annotations

import math

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from tabletally.plans.queries import LAKE_TABLES, QUERIES


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == len(LAKE_TABLES) - 2
    assert df.columns == [
        "source_name", "database_type", "database_name", "table_name",
        "row_count", "table_schema", "created_at", "updated_at",
    ]


def test_every_query_has_sql():
    assert set(QUERIES) <= set(E.oracle_sql()) <= set(E.queries())


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def norm(v):
        if isinstance(v, float):
            return round(v, 6) if not math.isnan(v) else None
        return v.isoformat() if hasattr(v, "isoformat") else v

    return [cols[i] for i in order], sorted((tuple(norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in LAKE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_duckdb(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rel = duck.execute(E.oracle_sql()[name])
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(
        [c[0] for c in rel.description], rel.fetchall()
    )
