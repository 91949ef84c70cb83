from __future__ import annotations

import json

import pytest
from conftest import SF_SMALL

from tabletally.job import build_source, build_target, main, parse_args
from tabletally.sources.registry_store import read_registry


def test_arguments_of_the_original_job(monkeypatch):
    monkeypatch.setenv("PG_PW", "s3cret")
    args = parse_args([
        "--source_name", "pg1", "--source_type", "postgresql",
        "--source_params", json.dumps({"host": "h", "port": 5432, "user": "u", "password_env": "PG_PW"}),
        "--destination_type", "postgresql",
        "--destination_params", json.dumps({"host": "d", "port": 5432, "user": "u", "password": "p",
                                            "database": "audit", "table_name": "public.tracker"}),
        "--jars", "a.jar,b.jar",
    ])
    src = build_source(args.source_name, args.source_type, args.source_params)
    assert (src.kind, src.host, src.user, src.password) == ("postgresql", "h", "u", "s3cret")
    target = build_target(args.destination_type, args.destination_params)
    assert (target.database, target.table, target.source.host) == ("audit", "public.tracker", "d")


def test_runs_end_to_end_on_a_lake(spark, tmp_path, capsys):
    argv = [
        "--source_name", "lake", "--source_type", "parquet",
        "--source_params", json.dumps({"path": SF_SMALL}),
        "--destination_type", "parquet",
        "--destination_params", json.dumps({"path": str(tmp_path / "registry")}),
        "--as_of", "2024-01-01",
    ]
    assert main(argv, spark) == 0
    first = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert first["listed"] == first["inserted"] == 14 and first["errors"] == 0
    assert main(argv, spark) == 0
    again = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert (again["inventoried"], again["inserted"]) == (0, 0)
    assert read_registry(spark, build_target("parquet", {"path": str(tmp_path / "registry")})).count() == 14


def test_lake_params_carry_layout_and_exclusions():
    src = build_source("wh", "parquet", {"path": "/x", "layout": "database/table", "exclude_databases": ["tmp"]})
    assert (src.layout, src.exclude_databases, src.database) == ("database/table", ("tmp",), "main")


def test_filters_reach_the_source_and_unknown_parameters_are_refused():
    params = {"host": "h", "port": 1, "include_tables": ["a"], "exclude_tables": ["b"], "exclude_databases": ["tmp"],
              "trustServerCertificate": "false", "options": {"loginTimeout": 5}}
    src = build_source("m", "mssql", params)
    assert (src.include_tables, src.exclude_tables, src.exclude_databases) == (("a",), ("b",), ("tmp",))
    assert src.options == {"loginTimeout": "5", "trustServerCertificate": "false"}
    assert build_source("l", "parquet", {"path": "/x", "include_tables": ["t"]}).include_tables == ("t",)
    with pytest.raises(ValueError, match="exclude_tabels"):
        build_source("l", "parquet", {"path": "/x", "exclude_tabels": ["t"]})
    with pytest.raises(ValueError, match="list of names"):
        build_source("l", "parquet", {"path": "/x", "exclude_tables": "tmp"})


def test_a_failure_ends_with_status_1(spark, tmp_path, capsys):
    argv = [
        "--source_name", "gone", "--source_type", "parquet", "--source_params", json.dumps({"path": str(tmp_path / "no")}),
        "--destination_type", "parquet", "--destination_params", json.dumps({"path": str(tmp_path / "registry")}),
    ]
    assert main(argv, spark) == 1
    assert "gone (listing)" in capsys.readouterr().err
