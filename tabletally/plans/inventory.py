"""The inventory of sources: dispatch by kind, several sources in one plan.

The work itself lives in ``lake_inventory`` (file lakes), ``jdbc_inventory``
(JDBC servers) and ``assemble`` (the joins both share); their public names
are re-exported here.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from .. import schemas
from ..functions.errors import error_text
from ..sources.model import Source
from .assemble import TABLE_KEY, Inventory, build_inventory, errors_frame, table_schema_json
from .jdbc_inventory import jdbc_inventory, jdbc_table_keys
from .lake_inventory import _lake_facts, _lake_rows, keeps, lake_inventory

__all__ = [
    "TABLE_KEY",
    "Inventory",
    "build_inventory",
    "inventory_all",
    "jdbc_inventory",
    "jdbc_table_keys",
    "lake_inventory",
    "source_inventory",
    "table_schema_json",
]


def source_inventory(spark: SparkSession, source: Source, robust: bool = False) -> Inventory:
    """Dispatch on the kind of source (S6); unknown kinds fail in ``Source``."""
    if source.is_files:
        return lake_inventory(spark, source, robust=robust)
    return jdbc_inventory(spark, source, robust=robust)


def inventory_all(
    spark: SparkSession,
    sources: list[Source],
    robust: bool = False,
    parallel_sources: int = 4,
    only: dict[str, set[tuple[str, str]]] | None = None,
) -> Inventory:
    """Inventories of several sources in one plan.

    Sources are independent, so up to ``parallel_sources`` of them are
    inventoried at once (their catalog reads and count jobs overlap). File
    sources over the same folder share one listing, one footer pass and one
    count scan; each then keeps its own tables, name and namespace.
    ``only`` maps a source name to the ``(database_name, table_name)`` keys
    to inventory; other tables are not counted or described. With
    ``robust`` a source that fails as a whole (server unreachable, folder
    missing) becomes one error row and the other sources go on.
    """

    def wanted(s: Source) -> set[tuple[str, str]] | None:
        return None if only is None else only.get(s.name, set())

    by_root: dict[tuple[str, str, str], list[Source]] = {}
    servers = []
    for s in sources:
        if s.is_files:
            by_root.setdefault((s.kind, s.path.rstrip("/"), s.layout), []).append(s)
        else:
            servers.append(s)

    def lake_group(group: list[Source]) -> list[Inventory]:
        facts = _lake_facts(spark, group[0], lambda t: any(keeps(s, t, wanted(s)) for s in group), robust)
        return [_lake_rows(spark, s, facts, wanted(s)) for s in group]

    def server(s: Source) -> list[Inventory]:
        return [jdbc_inventory(spark, s, robust=robust, only=wanted(s))]

    def failed(group: list[Source], exc: Exception) -> list[Inventory]:
        return [
            Inventory(
                spark.createDataFrame([], schemas.INVENTORY),
                errors_frame(spark, s, [(None, None, "source", error_text(exc))]),
            )
            for s in group
        ]

    def run(item) -> list[Inventory]:
        fn, arg = item
        try:
            return fn(arg)
        except Exception as exc:  # noqa: BLE001 - with robust, one source must not stop the rest
            if not robust:
                raise
            return failed(arg if isinstance(arg, list) else [arg], exc)

    work = [(server, s) for s in servers] + [(lake_group, g) for g in by_root.values()]
    parts: list[Inventory] = []
    if work:
        with ThreadPoolExecutor(max_workers=max(1, min(parallel_sources, len(work)))) as pool:
            for result in pool.map(run, work):
                parts += result
    if not parts:
        return Inventory(
            spark.createDataFrame([], schemas.INVENTORY), spark.createDataFrame([], schemas.ERRORS)
        )
    return Inventory(
        reduce(DataFrame.unionByName, [p.rows for p in parts]),
        reduce(DataFrame.unionByName, [p.errors for p in parts]),
    )
