"""tabletally: table inventory and an insert-only registry, on Spark.

Lists the tables of file lakes and JDBC servers, counts their rows and turns
their columns into ordered JSON maps, as set-based Spark jobs over all tables
at once; then appends to a registry the tables it does not know yet.
"""

from .operators.counts import count_lake_rows
from .operators.insert_missing import insert_missing, latest_per_key, missing_rows
from .operators.names import distinct_names, exclude_names
from .operators.pairs_json import pairs_to_json
from .plans.catalog import list_databases, list_tables
from .plans.inventory import Inventory, build_inventory, inventory_all, source_inventory
from .plans.registry import load_registry, missing_entries, registry_after_load
from .plans.sync import SyncReport, sync_registry
from .sources.model import Source
from .sources.registry_store import RegistryTarget, read_registry

__all__ = [
    "Inventory",
    "RegistryTarget",
    "Source",
    "build_inventory",
    "count_lake_rows",
    "distinct_names",
    "exclude_names",
    "insert_missing",
    "inventory_all",
    "latest_per_key",
    "list_databases",
    "list_tables",
    "load_registry",
    "missing_entries",
    "missing_rows",
    "pairs_to_json",
    "read_registry",
    "registry_after_load",
    "source_inventory",
    "sync_registry",
    "SyncReport",
]
