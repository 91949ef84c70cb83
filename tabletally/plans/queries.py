"""The queries registered for the driver's checks and the bench.

"Lake" is the folder of test tables, seen as one source ``lake`` of type
``parquet`` with the namespace ``main``. Counts and column maps cover all files
and footers of each table; failures are raised, never left out. The catalog
queries filter rows of ``documents``, whose source and language play database
and table names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..operators.counts import count_lake_rows
from ..operators.incremental_counts import count_files, counts_of_files
from ..operators.insert_missing import missing_rows
from ..operators.key_filter import missing_rows_filtered
from ..operators.names import catalog_names, distinct_names
from ..operators.pairs_json import pairs_to_json
from ..operators.segments import pairs_to_json_segments as segments
from ..operators.type_merge import merge_types
from ..session import kept, scratch_folder
from ..sources import lake, lake_catalog
from ..sources.bucketed import BucketedRegistry
from ..sources.counted_sink import insert_missing_counted
from ..sources.model import Source
from .inventory import inventory_all, lake_inventory
from .registry import missing_entries, registry_after_load

# Fixed values of the test scenario.
LAKE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
EXCLUDED_DATABASES = ("src0", "src1")
LISTED_DATABASE = "src2"
EXCLUDED_TABLES = ("de",)
REGISTERED_TABLES = ("orders", "lineitem")
REGISTERED_ON = "2024-01-01"
AS_OF = "2024-06-30"
SOURCE_GROUPS = {
    "tpch": ("region", "nation", "customer", "supplier", "part", "orders", "lineitem"),
    "text": ("documents", "pages", "benchmark", "labels", "conversations"),
    "stream": ("events", "embeddings"),
}
ORDERS_KNOWN_BEFORE = "1998-01-01 00:00:00"
EVENTS_KNOWN_BEFORE = "2024-01-15 00:00:00"
SEGMENT = 100


def lake_source(sf_dir: str, **kw) -> Source:
    kw.setdefault("include_tables", tuple(LAKE_TABLES))
    return Source(name=kw.pop("name", "lake"), kind="parquet", path=sf_dir, **kw)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def table_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = lake_source(sf_dir)
    counts = count_lake_rows(spark, lake.list_lake_tables(spark, src), src.database)
    return counts.select("table_name", "row_count")


def list_databases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_names(_table(spark, sf_dir, "documents"), "source", EXCLUDED_DATABASES, alias="database_name")


def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "documents").select(
        F.col("source").alias("database_name"), F.col("lang").alias("table_name")
    )
    return catalog_names(
        rows, "table_name", equals={"database_name": LISTED_DATABASE}, exclude=EXCLUDED_TABLES
    ).distinct()


def table_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory(spark, sf_dir).select("table_name", "table_schema")


def lake_footers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and column maps of all tables from one footer pass; tables Arrow cannot open through Spark's readers."""
    return lake_inventory(spark, lake_source(sf_dir)).rows.select(
        "database_name", "table_name", "row_count",
        F.size(F.json_object_keys("table_schema")).alias("n_columns"), "table_schema",
    )


def table_schema_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each group of tables stacked by position, as a union would: the type that holds all of a position's types."""
    groups = F.create_map(*[F.lit(x) for name, tables in SOURCE_GROUPS.items() for t in tables for x in (t, name)])
    schemas_of = inventory(spark, sf_dir).select(
        groups[F.col("table_name")].alias("source_name"), F.from_json("table_schema", "map<string,string>").alias("columns")
    )
    positions = schemas_of.select("source_name", F.posexplode(F.map_values("columns")).alias("pos", "data_type"))
    return merge_types(positions.withColumn("pos", F.col("pos") + 1), ["source_name", "pos"])


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_inventory(spark, lake_source(sf_dir)).rows


def inventory_multi_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = [
        lake_source(sf_dir, name=name, database=name, include_tables=tables)
        for name, tables in SOURCE_GROUPS.items()
    ]
    return inventory_all(spark, sources).rows


def _registry_fixture(inv: DataFrame) -> DataFrame:
    """A registry that already knows two tables, with other counts than today."""
    day = F.lit(REGISTERED_ON).cast("date")
    return inv.where(F.col("table_name").isin(list(REGISTERED_TABLES))).select(
        *schemas.KEYS,
        (F.col("row_count") - 1).alias("row_count"),
        "table_schema",
        day.alias("created_at"),
        day.alias("updated_at"),
    )


def registry_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = inventory(spark, sf_dir)
    return missing_entries(inv, _registry_fixture(inv), AS_OF, unique=True)


def registry_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = inventory(spark, sf_dir)
    return registry_after_load(inv, _registry_fixture(inv), AS_OF, unique=True)


def registry_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    inv = inventory(spark, sf_dir)
    after = registry_after_load(inv, _registry_fixture(inv), AS_OF, unique=True)
    return missing_entries(inv, after, AS_OF, unique=True)


def insert_missing_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    known = orders.where(F.col("o_orderdate") < F.expr(f"TIMESTAMP_NTZ '{ORDERS_KNOWN_BEFORE}'"))
    return missing_rows(orders, known, ["o_orderkey"])


def insert_missing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    # a second delivery of the clicks, with a higher value that must win
    redelivered = events.where(F.col("event_type") == "click").withColumn("value", F.col("value") + 1)
    batch = events.unionByName(redelivered)
    known = events.where(F.col("ts") < F.expr(f"TIMESTAMP_NTZ '{EVENTS_KNOWN_BEFORE}'"))
    return missing_rows(batch, known, ["event_id"], order=["value"])


def row_counts_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second count of the lake after its first tables were counted: only the other tables' files are read."""
    src = lake_source(sf_dir)
    tables = lake.list_lake_tables(spark, src)
    state = count_files(spark, [t for t in tables if t.name in SOURCE_GROUPS["tpch"]])
    files = count_files(spark, tables, state)
    return counts_of_files(spark, tables, files, src.database).select(
        "table_name", "row_count", (F.col("n_fresh") > 0).alias("counted_anew")
    )


def insert_missing_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    known = orders.where(F.col("o_orderdate") < F.expr(f"TIMESTAMP_NTZ '{ORDERS_KNOWN_BEFORE}'"))
    return missing_rows_filtered(orders, known, ["o_orderkey"])


def registry_missing_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``registry_missing`` against a registry that is stored in buckets of its key."""
    inv = kept(inventory(spark, sf_dir))  # see load_registry
    registry = BucketedRegistry(scratch_folder(spark, "registry"), buckets=8)
    registry.append(_registry_fixture(inv))
    return missing_entries(inv, registry.attach(spark), AS_OF, unique=True)


def pairs_to_json_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event type's users with their last event, in objects of at most ``SEGMENT`` users."""
    events = _table(spark, sf_dir, "events").withColumn("last_event", F.col("event_id"))
    return segments(events, ["event_type"], "user_id", "last_event", "event_id", SEGMENT, "user_events")


def append_counted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders after a load that appends what is missing, with the number of rows its tasks reported."""
    orders = _table(spark, sf_dir, "orders")
    path = scratch_folder(spark, "orders")
    orders.where(F.col("o_orderdate") < F.expr(f"TIMESTAMP_NTZ '{ORDERS_KNOWN_BEFORE}'")).write.parquet(path)
    n = insert_missing_counted(orders, path, ["o_orderkey"])
    return spark.read.schema(orders.schema).parquet(path).withColumn("n_appended", F.lit(n).cast("bigint"))


def catalog_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake's catalog read as a data source, with a filter on the table names."""
    rows = lake_catalog.catalog(spark, lake_source(sf_dir))
    return rows.where(F.col("table_name").isin(list(LAKE_TABLES))).select("database_name", "table_name")


def lake_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake's tables, listed by tasks."""
    return lake_catalog.list_tables(spark, lake_source(sf_dir))


def pairs_to_json_by_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    return pairs_to_json(orders, ["o_custkey"], "o_orderpriority", "o_orderstatus", "o_orderkey", "priority_status")


QUERIES = {
    "table_row_counts": table_row_counts,
    "list_databases": list_databases,
    "list_tables": list_tables,
    "table_schema_json": table_schemas,
    "lake_footers": lake_footers,
    "table_schema_merged": table_schema_merged,
    "inventory": inventory,
    "inventory_multi_source": inventory_multi_source,
    "registry_missing": registry_missing,
    "registry_append": registry_append,
    "registry_rerun": registry_rerun,
    "insert_missing_orders": insert_missing_orders,
    "insert_missing_events": insert_missing_events,
    "pairs_to_json_by_customer": pairs_to_json_by_customer,
    "row_counts_incremental": row_counts_incremental,
    "insert_missing_bloom": insert_missing_bloom,
    "registry_missing_bucketed": registry_missing_bucketed,
    "pairs_to_json_segments": pairs_to_json_segments,
    "catalog_source": catalog_source,
    "lake_listing": lake_listing,
    "append_counted": append_counted,
}
