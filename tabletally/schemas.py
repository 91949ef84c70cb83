"""Fixed schemas of the inventory, its column rows, the registry and errors.

Every DataFrame the library creates from driver-side metadata uses one of
these explicit schemas, so an empty input gives an empty, typed DataFrame
instead of a schema-inference error.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Registry key: a table is known once this 4-tuple is registered.
KEYS = ["source_name", "database_type", "database_name", "table_name"]

INVENTORY_COLUMNS = KEYS + ["row_count", "table_schema"]
REGISTRY_COLUMNS = INVENTORY_COLUMNS + ["created_at", "updated_at"]

TABLES = T.StructType(
    [
        T.StructField("database_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
    ]
)

# A table's path (its encoded path part) beside its names.
ROOTS = T.StructType([T.StructField("root", T.StringType(), False), *TABLES.fields])

# One row per column of a table; `pos` is the 1-based ordinal position.
COLUMNS = T.StructType(
    [
        T.StructField("database_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("pos", T.IntegerType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), True),
    ]
)

COUNTS = T.StructType(
    [
        T.StructField("database_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
    ]
)

# One row per listed table: what an inventory adds to the source's name and kind.
ENTRIES = T.StructType(
    [
        T.StructField("database_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("row_count", T.LongType(), False),
        T.StructField("table_schema", T.StringType(), False),
    ]
)

INVENTORY = T.StructType(
    [
        T.StructField("source_name", T.StringType(), False),
        T.StructField("database_type", T.StringType(), False),
        T.StructField("database_name", T.StringType(), False),
        T.StructField("table_name", T.StringType(), False),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("table_schema", T.StringType(), True),
    ]
)

REGISTRY = T.StructType(
    list(INVENTORY.fields)
    + [
        T.StructField("created_at", T.DateType(), True),
        T.StructField("updated_at", T.DateType(), True),
    ]
)

ERRORS = T.StructType(
    [
        T.StructField("source_name", T.StringType(), False),
        T.StructField("database_name", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("stage", T.StringType(), False),
        T.StructField("message", T.StringType(), False),
    ]
)
