"""JDBC dialects, checked as text: no database server may be started here."""

from __future__ import annotations

import pytest

from tabletally.sources import jdbc
from tabletally.sources.model import Source
from tabletally.sources.retry import with_retry


def _src(kind, **kw):
    return Source("s", kind, host="db.example", port=5432, user="u", password="secret", **kw)


def test_urls_per_dialect():
    assert jdbc.jdbc_options(_src("postgresql"), "sales")["url"] == "jdbc:postgresql://db.example:5432/sales"
    ms = jdbc.jdbc_options(_src("mssql"), "hr")["url"]
    assert ms == "jdbc:sqlserver://db.example:5432;databaseName=hr;encrypt=true;trustServerCertificate=true"
    strict = jdbc.jdbc_options(_src("mssql", options={"trustServerCertificate": "false"}), "hr")
    assert strict["url"].endswith("encrypt=true;trustServerCertificate=false") and "trustServerCertificate" not in strict
    assert jdbc.jdbc_options(_src("mssql"))["url"].count("databaseName=master") == 1
    assert jdbc.jdbc_options(_src("oracle"), "ignored")["url"] == "jdbc:oracle:thin:@db.example:5432/FREEPDB1"
    assert jdbc.jdbc_options(_src("oracle", options={"service": "PDB2"}))["url"].endswith("/PDB2")


def test_options_carry_driver_and_credentials_but_repr_hides_password():
    opts = jdbc.jdbc_options(_src("postgresql", options={"fetchsize": "500"}), "x")
    assert opts["driver"] == "org.postgresql.Driver" and opts["user"] == "u" and opts["password"] == "secret"
    assert opts["fetchsize"] == "500"
    assert "secret" not in repr(_src("postgresql"))


def test_catalog_sql_keeps_the_exclusions():
    pg = jdbc.POSTGRES.databases_sql(_src("postgresql"))
    for name in ("postgres", "template0", "template1"):
        assert f"'{name}'" in pg
    ms = jdbc.MSSQL.databases_sql(_src("mssql"))
    for name in ("master", "tempdb", "model", "msdb"):
        assert f"'{name}'" in ms
    assert "'BASE TABLE'" in jdbc.MSSQL.tables_sql(_src("mssql"))
    assert "table_schema = 'public'" in jdbc.POSTGRES.tables_sql(_src("postgresql"))
    assert "OWNER IN ('SYSTEM')" in jdbc.ORACLE.tables_sql(_src("oracle"))
    assert "OWNER IN ('A', 'B')" in jdbc.ORACLE.columns_sql(_src("oracle", options={"owners": "A,B"}))
    assert set(jdbc.ORACLE.excluded_tables) == {"DUAL", "USER_TABLES", "ALL_TABLES", "DBA_TABLES"}
    custom = jdbc.POSTGRES.databases_sql(_src("postgresql", exclude_databases=("x'y",)))
    assert "NOT IN ('postgres', 'template0', 'template1', 'x''y')" in custom  # added to the server's own


def test_column_queries_cover_all_tables_with_positions():
    for d, kind in ((jdbc.POSTGRES, "postgresql"), (jdbc.MSSQL, "mssql"), (jdbc.ORACLE, "oracle")):
        sql = d.columns_sql(_src(kind))
        for alias in ("schema_name", "table_name", "pos", "column_name", "data_type"):
            assert alias in sql
        assert "= '{" not in sql  # not per table


def test_count_sql_quotes_names():
    assert jdbc.POSTGRES.count_sql("public", 'we"ird') == 'SELECT COUNT(*) AS row_count FROM "public"."we""ird"'
    assert jdbc.MSSQL.count_sql("dbo", "a]b") == "SELECT COUNT_BIG(*) AS row_count FROM [dbo].[a]]b]"
    assert jdbc.ORACLE.count_sql("SYSTEM", "T1") == 'SELECT COUNT(*) AS row_count FROM "SYSTEM"."T1"'


def test_counts_of_a_group_are_one_text():
    sql = jdbc.count_union_sql(jdbc.MSSQL, [("dbo", "a"), ("dbo", "b]")])
    assert sql == (
        "SELECT 0 AS item, q.row_count FROM (SELECT COUNT_BIG(*) AS row_count FROM [dbo].[a]) q"
        " UNION ALL SELECT 1 AS item, q.row_count FROM (SELECT COUNT_BIG(*) AS row_count FROM [dbo].[b]]]) q"
    )


def test_predicates_give_one_read_each():
    calls = []
    reader = type("R", (), {"jdbc": lambda self, url, table, **kw: calls.append((url, table, kw)) or "loaded"})()
    fake_spark = type("S", (), {"read": reader})()
    assert jdbc.read_table(fake_spark, _src("postgresql"), "audit", "public.t", predicates=["a = 1", "a = 2"]) == "loaded"
    url, table, kw = calls[0]
    assert url.endswith("/audit") and table == "public.t" and kw["predicates"] == ["a = 1", "a = 2"]
    assert kw["properties"]["user"] == "u"


def test_database_names_keep_non_default_schema():
    assert jdbc.qualified_database(jdbc.MSSQL, "hr", "dbo") == "hr"
    assert jdbc.qualified_database(jdbc.MSSQL, "hr", "audit") == "hr.audit"
    assert jdbc.qualified_database(jdbc.POSTGRES, "sales", "public") == "sales"
    assert jdbc.qualified_database(jdbc.ORACLE, "FREEPDB1", "SYSTEM") == "SYSTEM"


def test_postgres_writer_lets_the_server_cast_text():
    assert ("stringtype", "unspecified") in jdbc.POSTGRES.write_options


def test_unsupported_kind():
    with pytest.raises(ValueError):
        jdbc.dialect(Source("f", "parquet", path="/x"))


def test_retry_counts_per_call_and_raises_last_error():
    waits = []
    calls = {"n": 0}

    def flaky():
        calls["n"] += 1
        if calls["n"] < 3:
            raise RuntimeError(f"fail {calls['n']}")
        return "ok"

    assert with_retry(flaky, attempts=3, delay_s=5, sleep=waits.append) == "ok"
    assert waits == [5, 5]
    calls["n"] = 0  # a new call has its own counter

    def always():
        raise RuntimeError("down")

    with pytest.raises(RuntimeError, match="down"):
        with_retry(always, attempts=3, delay_s=0, sleep=waits.append)
    assert with_retry(lambda: 1, attempts=1) == 1


class _Recorder:
    """Stands in for a DataFrameReader/Writer: records every option set."""

    def __init__(self):
        self.opts, self.fmt, self.saved_mode = {}, None, None

    def format(self, f):
        self.fmt = f
        return self

    def options(self, **kw):
        self.opts.update(kw)
        return self

    def option(self, k, v):
        self.opts[k] = v
        return self

    def mode(self, m):
        self.saved_mode = m
        return self

    def load(self):
        return "loaded"

    def save(self):
        return None


def test_partitioned_table_read_options():
    rec = _Recorder()
    fake_spark = type("S", (), {"read": rec})()
    src = _src("postgresql")
    out = jdbc.read_table(fake_spark, src, "sales", "public.orders", "id", 1, 1_000_000, 16, fetch_size=5000)
    assert out == "loaded" and rec.fmt == "jdbc"
    assert rec.opts["url"] == "jdbc:postgresql://db.example:5432/sales"
    assert rec.opts["dbtable"] == "public.orders"
    assert (rec.opts["partitionColumn"], rec.opts["lowerBound"], rec.opts["upperBound"]) == ("id", "1", "1000000")
    assert (rec.opts["numPartitions"], rec.opts["fetchsize"]) == ("16", "5000")


def test_append_options_per_dialect():
    for kind, has_stringtype in (("postgresql", True), ("mssql", False)):
        rec = _Recorder()
        fake_df = type("D", (), {"write": rec})()
        jdbc.write_table(fake_df, _src(kind), "audit", "public.tracker", max_connections=4)
        assert rec.fmt == "jdbc" and rec.saved_mode == "append"
        assert rec.opts["dbtable"] == "public.tracker" and rec.opts["numPartitions"] == "4"
        assert (rec.opts.get("stringtype") == "unspecified") == has_stringtype


def test_bad_input_is_not_retried():
    waits = []

    def refuse():
        raise ValueError("null key")

    with pytest.raises(ValueError):
        with_retry(refuse, attempts=3, delay_s=5, sleep=waits.append)
    assert waits == []
