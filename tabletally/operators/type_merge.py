"""The least common type of many files' types, as an aggregate.

Types are Spark's short names. They form a lattice in which a value of the
lower type is a value of the upper one without loss, and Spark's Parquet reader
reads the lower as the upper:

    tinyint < smallint < int < bigint, int < double, float < double,
    integers < decimal(p,s) with enough digits, decimal < wider decimal,
    date < timestamp_ntz

Types without a common upper one (``bigint`` and ``double``, ``int`` and
``string``, arrays of different types) are a conflict. The fold needs no list
of all files' types: a few maxima per column say everything, so it combines
map-side, in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The integer types from narrow to wide, and the digits each needs in a decimal.
INTEGERS = ("tinyint", "smallint", "int", "bigint")
DIGITS = (3, 5, 10, 20)
MOST_DIGITS = 38
_DECIMAL = r"^decimal\((\d+),(-?\d+)\)$"


def type_facts(data_type: Column) -> list[Column]:
    """The aggregates of a column's types that ``merged_type`` decides by."""
    rank = F.array_position(F.array(*[F.lit(t) for t in INTEGERS]), data_type)
    is_decimal = data_type.rlike(_DECIMAL)
    scale = F.when(is_decimal, F.regexp_extract(data_type, _DECIMAL, 2).cast("int"))
    whole = F.when(is_decimal, F.regexp_extract(data_type, _DECIMAL, 1).cast("int")) - scale
    known = data_type.isin(*INTEGERS, "float", "double", "date", "timestamp_ntz") | is_decimal
    other = F.when(~known, data_type)
    return [
        F.max(F.when(rank > 0, rank)).alias("_integer"),
        F.max(scale).alias("_scale"),
        F.max(whole).alias("_whole"),
        F.max(data_type == "float").alias("_float"),
        F.max(data_type == "double").alias("_double"),
        F.max(data_type == "date").alias("_date"),
        F.max(data_type == "timestamp_ntz").alias("_time"),
        F.min(other).alias("_other_min"),
        F.max(other).alias("_other_max"),
        # distinct names of a column's types: for the text of a conflict
        F.array_join(F.array_sort(F.collect_set(data_type)), ", ").alias("types"),
    ]


def _flag(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(False))


def _by_rank(rank: Column, values: tuple) -> Column:
    """The value at a rank from 1; null for a null rank (which ``element_at`` of a constant array does not give)."""
    return F.coalesce(*[F.when(rank == i, F.lit(v)) for i, v in enumerate(values, start=1)])


def merged_type() -> Column:
    """The merged type's name from the columns of ``type_facts``; null for a conflict (or no type at all)."""
    integer, scale, other = F.col("_integer"), F.col("_scale"), F.col("_other_min")
    floating, temporal = _flag("_float") | _flag("_double"), _flag("_date") | _flag("_time")
    numeric = integer.isNotNull() | scale.isNotNull() | floating
    families = sum(x.cast("int") for x in (numeric, temporal, other.isNotNull()))
    digits = _by_rank(integer, DIGITS)
    whole = F.greatest("_whole", digits)  # nulls are skipped
    as_decimal = F.when(
        ~floating & (whole + scale <= MOST_DIGITS), F.format_string("decimal(%d,%d)", whole + scale, scale)
    )
    narrow = integer.isNull() | (integer < len(INTEGERS))
    as_float = F.when(narrow, F.when(_flag("_double") | integer.isNotNull(), "double").otherwise("float"))
    as_integer = _by_rank(integer, INTEGERS)
    as_number = F.when(scale.isNotNull(), as_decimal).when(floating, as_float).otherwise(as_integer)
    return F.when(
        families == 1,
        F.when(numeric, as_number)
        .when(temporal, F.when(_flag("_time"), "timestamp_ntz").otherwise("date"))
        .when(other == F.col("_other_max"), other),
    )


def in_conflict() -> Column:
    """True where there are types but no merged one (after ``data_type`` was set to ``merged_type()``)."""
    return F.col("data_type").isNull() & (F.col("types") != "")


def merge_types(rows: DataFrame, keys: list[str], type_col: str = "data_type") -> DataFrame:
    """One row per key: ``data_type`` (null after a conflict), ``n`` rows, ``conflict`` (the types, or null).

    Null types count as rows and take no part in the merge.
    """
    merged = rows.groupBy(*keys).agg(*type_facts(F.col(type_col)), F.count(F.lit(1)).alias("n"))
    return merged.withColumn("data_type", merged_type()).select(
        *keys, "data_type", "n", F.when(in_conflict(), F.col("types")).alias("conflict")
    )
