"""JDBC inventory logic against a fake catalog: no server, no port.

``jdbc.read_query`` is the one place that talks to a server; here it answers
from in-memory tables, so databases, schemas, exclusions, the count union and
the fallback run as they would against a real server.
"""

from __future__ import annotations

import json
from decimal import Decimal

import pytest

from tabletally.plans.inventory import jdbc_inventory, jdbc_table_keys
from tabletally.sources import jdbc
from tabletally.sources.model import Source

PG = {
    # database -> {(schema, table): (row_count, [(pos, column, type)])}
    "sales": {
        ("public", "orders"): (10, [(2, "amount", "numeric"), (1, "id", "integer")]),
        ("public", "customers"): (0, [(1, "id", "integer"), (2, "name", "text"), (3, "name", None)]),
        ("public", "v_orders"): (10, [(1, "id", "integer")]),  # a view: listed, as on PostgreSQL
    },
    "empty_db": {},
    "hr": {("public", "people"): (3, [(1, "Id", "bigint")])},
}


def _fake(spark, server, fail_counts=()):
    def read_query(spark_, source, database, query):
        d = jdbc.dialect(source)
        if query == d.databases_sql(source):
            names = [db for db in server if db not in d.excluded_databases]
            return spark.createDataFrame([(n,) for n in names], "database_name string")
        if query == d.tables_sql(source):
            rows = [(s, t) for (s, t) in server[database]]
            return spark.createDataFrame(rows, "schema_name string, table_name string")
        if query == d.columns_sql(source):
            rows = [
                (s, t, pos, c, typ)
                for (s, t), (_, cols) in server[database].items()
                for pos, c, typ in cols
            ]
            return spark.createDataFrame(
                rows, "schema_name string, table_name string, pos int, column_name string, data_type string"
            )
        rows = []
        for (s, t), (n, _) in server[database].items():
            if d.count_sql(s, t) in query:
                if t in fail_counts:
                    return spark.range(1).selectExpr("raise_error('permission denied') AS item", "1 AS row_count")
                item = next(i for i, part in enumerate(query.split(" UNION ALL ")) if d.count_sql(s, t) in part)
                rows.append((item, Decimal(n)))
        if rows:
            return spark.createDataFrame(rows, "item int, row_count decimal(38,0)")
        raise AssertionError(f"unexpected query {query!r}")

    return read_query


@pytest.fixture(autouse=True)
def no_waiting(monkeypatch):
    from tabletally.sources import retry

    monkeypatch.setattr(retry.with_retry, "__defaults__", (3, 0.0, *retry.with_retry.__defaults__[2:]))


@pytest.fixture
def pg(spark, monkeypatch):
    monkeypatch.setattr(jdbc, "read_query", _fake(spark, PG))
    return Source("pg1", "postgresql", host="h", port=5432, user="u", password="p")


def test_postgres_inventory_lists_every_table(spark, pg):
    inv = jdbc_inventory(spark, pg)
    got = {(r["database_name"], r["table_name"]): r for r in inv.rows.collect()}
    assert sorted(got) == [("hr", "people"), ("sales", "customers"), ("sales", "orders"), ("sales", "v_orders")]
    assert got[("sales", "orders")]["row_count"] == 10
    assert got[("sales", "orders")]["table_schema"] == '{"id":"integer","amount":"numeric"}'
    # duplicate column: first place, last type; null type written as null
    assert got[("sales", "customers")]["table_schema"] == '{"id":"integer","name":null}'
    assert {r["source_name"] for r in inv.rows.collect()} == {"pg1"}
    assert {r["database_type"] for r in inv.rows.collect()} == {"postgresql"}
    assert inv.errors.count() == 0


def test_table_keys_from_catalog_only(spark, pg):
    assert sorted(jdbc_table_keys(spark, pg)) == [
        ("hr", "people"), ("sales", "customers"), ("sales", "orders"), ("sales", "v_orders"),
    ]


def test_only_narrows_the_work(spark, pg):
    inv = jdbc_inventory(spark, pg, only={("sales", "orders")})
    assert [(r["table_name"], r["row_count"]) for r in inv.rows.collect()] == [("orders", 10)]


def test_failing_count_goes_to_errors(spark, monkeypatch):
    monkeypatch.setattr(jdbc, "read_query", _fake(spark, PG, fail_counts=("customers",)))
    src = Source("pg1", "postgresql", host="h", port=5432)
    inv = jdbc_inventory(spark, src, robust=True)
    assert sorted(r["table_name"] for r in inv.rows.collect()) == ["orders", "people", "v_orders"]
    errs = inv.errors.collect()
    assert [(e["database_name"], e["table_name"], e["stage"]) for e in errs] == [("sales", "customers", "count")]


def test_mssql_schema_joins_database_name_and_excluded_databases(spark, monkeypatch):
    server = {
        "master": {("dbo", "spt"): (1, [(1, "a", "int")])},
        "hr": {
            ("dbo", "People"): (3, [(1, "ID", "int")]),
            ("audit", "People"): (5, [(1, "ID", "int"), (2, "At", "datetime2")]),
        },
    }
    monkeypatch.setattr(jdbc, "read_query", _fake(spark, server))
    inv = jdbc_inventory(spark, Source("ms", "mssql", host="h", port=1433))
    got = sorted((r["database_name"], r["table_name"], r["row_count"]) for r in inv.rows.collect())
    assert got == [("hr", "People", 3), ("hr.audit", "People", 5)]  # same-named tables kept apart


def test_oracle_owner_and_excluded_tables(spark, monkeypatch):
    server = {
        "FREEPDB1": {
            ("SYSTEM", "DUAL"): (1, [(1, "DUMMY", "VARCHAR2")]),
            ("SYSTEM", "HELP"): (900, [(1, "TOPIC", "VARCHAR2"), (2, "SEQ", "NUMBER")]),
        }
    }
    monkeypatch.setattr(jdbc, "read_query", _fake(spark, server))
    inv = jdbc_inventory(spark, Source("ora", "oracle", host="h", port=1521))
    rows = inv.rows.collect()
    assert [(r["database_name"], r["table_name"], r["row_count"]) for r in rows] == [("SYSTEM", "HELP", 900)]
    assert json.loads(rows[0]["table_schema"]) == {"TOPIC": "VARCHAR2", "SEQ": "NUMBER"}


def test_counts_in_small_batches_give_the_same_inventory(spark, pg):
    whole = sorted(tuple(r) for r in jdbc_inventory(spark, pg).rows.collect())
    batched = jdbc_inventory(spark, pg, tables_per_query=2, max_connections=1)
    assert sorted(tuple(r) for r in batched.rows.collect()) == whole


def test_a_failing_table_costs_only_itself_in_its_batch(spark, monkeypatch):
    monkeypatch.setattr(jdbc, "read_query", _fake(spark, PG, fail_counts=("orders",)))
    src = Source("pg1", "postgresql", host="h", port=5432)
    inv = jdbc_inventory(spark, src, robust=True, tables_per_query=4, max_connections=2)
    assert sorted(r["table_name"] for r in inv.rows.collect()) == ["customers", "people", "v_orders"]
    assert [e["table_name"] for e in inv.errors.collect()] == ["orders"]


def test_catalog_frames(spark, pg):
    from tabletally.plans.catalog import list_databases, list_tables

    assert sorted(r[0] for r in list_databases(spark, pg).collect()) == ["empty_db", "hr", "sales"]
    got = sorted(tuple(r) for r in list_tables(spark, pg).collect())
    assert got == [("hr", "people"), ("sales", "customers"), ("sales", "orders"), ("sales", "v_orders")]
    narrowed = Source("pg1", "postgresql", host="h", port=5432, exclude_tables=("v_orders",))
    assert ("sales", "v_orders") not in {tuple(r) for r in list_tables(spark, narrowed).collect()}


def test_sync_counts_only_new_tables_on_the_server(spark, monkeypatch, tmp_path):
    from tabletally.plans.sync import sync_registry
    from tabletally.sources.registry_store import RegistryTarget

    sent = []
    fake = _fake(spark, PG)

    def recording(spark_, source, database, query):
        sent.append(query)
        return fake(spark_, source, database, query)

    monkeypatch.setattr(jdbc, "read_query", recording)
    src = Source("pg1", "postgresql", host="h", port=5432)
    target = RegistryTarget(path=str(tmp_path / "registry"))
    first = sync_registry(spark, [src], target, as_of="2024-01-01")
    assert (first.listed, first.inventoried, first.inserted) == (4, 4, 4)
    assert sum(q.count("COUNT(") for q in sent) == 4
    assert sum("COUNT(" in q for q in sent) == 2  # one text per database
    sent.clear()
    again = sync_registry(spark, [src], target, as_of="2024-01-02")
    assert (again.listed, again.inventoried, again.inserted) == (4, 0, 0)
    assert not any("COUNT(" in q for q in sent)  # only catalog queries on an unchanged server


def test_several_servers_and_a_lake_in_one_inventory(spark, pg):
    from conftest import SF_SMALL

    from tabletally.plans.inventory import inventory_all
    from tabletally.plans.queries import lake_source

    other = Source("pg2", "postgresql", host="h2", port=5432)
    lake = lake_source(SF_SMALL, include_tables=("region",))
    inv = inventory_all(spark, [pg, other, lake], robust=True)
    got = sorted((r["source_name"], r["table_name"]) for r in inv.rows.collect())
    assert got.count(("pg1", "orders")) == 1 and got.count(("pg2", "orders")) == 1
    assert ("lake", "region") in got and len(got) == 9


@pytest.mark.parametrize("tables", [1, 201])
def test_one_path_for_any_number_of_tables(spark, monkeypatch, tables):
    server = {"db": {("public", f"t{i}"): (i, [(1, "id", "integer")]) for i in range(tables)}}
    sent = []
    fake = _fake(spark, server)
    monkeypatch.setattr(jdbc, "read_query", lambda *a: sent.append(a[-1]) or fake(*a))
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)  # none is needed
    inv = jdbc_inventory(spark, Source("pg", "postgresql", host="h", port=1))
    assert {(r["table_name"], r["row_count"]) for r in inv.rows.collect()} == {(f"t{i}", i) for i in range(tables)}
    assert sum("COUNT(" in q for q in sent) == -(-tables // 50)


def test_counts_and_columns_are_retried_around_the_action(spark, monkeypatch):
    fails = {"COUNT(": 2, "ordinal_position": 1}
    fake = _fake(spark, PG)

    def flaky(spark_, source, database, query):
        for mark in fails:
            if mark in query and fails[mark]:
                fails[mark] -= 1
                return spark.range(1).selectExpr("raise_error('gone') AS item").selectExpr(
                    "item", "1 AS row_count", "item AS schema_name", "item AS table_name", "item AS pos",
                    "item AS column_name", "item AS data_type")
        return fake(spark_, source, database, query)

    monkeypatch.setattr(jdbc, "read_query", flaky)
    inv = jdbc_inventory(spark, Source("pg", "postgresql", host="h", port=1))
    assert inv.rows.count() == 4 and inv.errors.count() == 0 and not any(fails.values())


def test_without_robust_a_failure_is_raised(spark, monkeypatch):
    monkeypatch.setattr(jdbc, "read_query", _fake(spark, PG, fail_counts=("orders",)))
    with pytest.raises(Exception, match="permission denied"):
        jdbc_inventory(spark, Source("pg1", "postgresql", host="h", port=5432))
