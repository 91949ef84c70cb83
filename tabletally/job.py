"""Command-line job: inventory one source and add its new tables to the registry.

Same arguments as the original job, so an existing spark-submit line keeps
working (``python -m tabletally.job`` runs it with a local session)::

    spark-submit --py-files tabletally.zip scripts/registry_job.py \\
        --source_name pg1 --source_type postgresql \\
        --source_params '{"host": "...", "port": 5432, "user": "...", "password_env": "PG1_PASSWORD"}' \\
        --destination_type postgresql \\
        --destination_params '{"host": "...", "port": 5432, "database": "audit", "table_name": "public.tracker", ...}'

A file lake is ``--source_type parquet --source_params '{"path": "...", "database": "main"}'``
(or ``{"path": "...", "layout": "database/table", "exclude_databases": ["tmp"]}``).
Every source takes the lists ``include_tables``, ``exclude_tables`` and
``exclude_databases``; further JDBC reader options go under ``options``.
The job ends with status 1 if any table or source failed;
a Parquet registry is ``--destination_type parquet --destination_params '{"path": "..."}'``.
Passwords may be given as ``password_env``: the name of an environment
variable to read, so they stay off the command line. ``--jars`` is accepted
and ignored (jars belong to spark-submit). The session is the one
spark-submit provides; its ``spark.checkpoint.dir`` must be a shared folder.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession

from .plans.sync import sync_registry
from .sources.model import FILE_KINDS, Source
from .sources.registry_store import RegistryTarget

# Parameter names that existing job lines use, and the reader options taken from beside them.
_CONNECTION_KEYS = ("host", "port", "user", "password", "password_env")
_OPTION_KEYS = ("service", "owners", "encrypt", "trustServerCertificate", "fetchsize")


def _password(params: dict) -> str | None:
    if "password_env" in params:
        return os.environ[params["password_env"]]
    return params.get("password")


def _names(params: dict, key: str) -> tuple[str, ...] | None:
    """A list of names, or null; a single text is refused, for it would be read letter by letter."""
    value = params.get(key)
    if value is not None and (isinstance(value, str) or not all(isinstance(v, str) for v in value)):
        raise ValueError(f"{key} must be a list of names")
    return None if value is None else tuple(value)


def build_source(name: str, kind: str, params: dict) -> Source:
    """A source from the job's parameters; unknown ones are refused."""
    filters = {
        "include_tables": _names(params, "include_tables"),
        "exclude_tables": _names(params, "exclude_tables") or (),
        "exclude_databases": _names(params, "exclude_databases"),
    }
    if kind in FILE_KINDS:
        own = ("path", "database", "layout")
        fields = {k: params[k] for k in own if k in params}
    else:
        own = (*_CONNECTION_KEYS, "options")
        fields = {k: params.get(k) for k in ("host", "port", "user")} | {"password": _password(params)}
        fields["options"] = {k: str(v) for k, v in params.get("options", {}).items()}
        fields["options"] |= {k: str(params[k]) for k in _OPTION_KEYS if k in params}
        own = (*own, *_OPTION_KEYS)
    unknown = sorted(set(params) - set(own) - set(filters))
    if unknown:
        raise ValueError(f"unknown parameters of a {kind} source: {', '.join(unknown)}")
    return Source(name, kind, **fields, **filters)


def build_target(kind: str, params: dict) -> RegistryTarget:
    if kind == "parquet":
        return RegistryTarget(path=params["path"])
    conn_params = {k: v for k, v in params.items() if k not in ("database", "table_name")}
    conn = build_source("registry", kind, conn_params)
    return RegistryTarget(source=conn, database=params.get("database"), table=params["table_name"])


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    # The argument names of existing job lines.
    p = argparse.ArgumentParser(prog="tabletally.job")
    p.add_argument("--source_name", required=True)
    p.add_argument("--source_type", required=True)
    p.add_argument("--source_params", required=True, type=json.loads)
    p.add_argument("--destination_type", required=True)
    p.add_argument("--destination_params", required=True, type=json.loads)
    p.add_argument("--jars", default="")
    p.add_argument("--as_of", default=None, help="registry date, YYYY-MM-DD (default: today)")
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parse_args(argv)
    source = build_source(args.source_name, args.source_type, args.source_params)
    target = build_target(args.destination_type, args.destination_params)
    spark = spark or SparkSession.builder.appName(f"tabletally_{args.source_name}").getOrCreate()
    report = sync_registry(spark, [source], target, as_of=args.as_of)
    errors = report.errors.collect()  # one row per failed table: small
    for e in errors:
        where = ".".join(x for x in (e["source_name"], e["database_name"], e["table_name"]) if x)
        print(f"error: {where} ({e['stage']}): {e['message']}", file=sys.stderr)
    summary = {
        "listed": report.listed,
        "inventoried": report.inventoried,
        "inserted": report.inserted,
        "errors": len(errors),
    }
    print(json.dumps(summary))
    return 1 if errors else 0


if __name__ == "__main__":
    sys.exit(main())
