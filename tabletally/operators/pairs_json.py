"""Fold key/value rows into one ordered JSON object per group.

Semantics are those of building a dict from the rows in ``order``: a key
keeps the place of its first row and the value of its last one. Keys are
compared as the text they become, so two values with the same text are one
key. A null key adds no entry (a JSON object has no null key), but its group
stays: a group with only null keys gives ``{}``. A null value is written as
``null``. Binary keys are refused: bytes that are no UTF-8 have no text.

Plan: first aggregate per (group, key), with a map-side partial aggregate,
so a hot group with millions of rows shrinks to one row per distinct key
before anything is shuffled; then collect the distinct keys of each group,
sort them by first position and write JSON. The second step holds one group's
distinct keys in one task and writes them into one row, so it is meant for
groups whose distinct keys fit in a row (the columns of a table, the settings
of a user), however many rows they have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def pairs_to_json(
    df: DataFrame,
    group_cols: list[str],
    key_col: str,
    value_col: str,
    order_col: str,
    out_col: str = "json",
) -> DataFrame:
    per_key = last_per_key(df, group_cols, key_col, value_col, order_col)
    return per_key.groupBy(*group_cols).agg(entries_to_json("_first", "_key", "_last").alias(out_col))


def last_per_key(df: DataFrame, group_cols: list[str], key_col: str, value_col: str, order_col: str) -> DataFrame:
    """``group_cols, _key, _first, _last``: each key's first position and its last value, as text."""
    if isinstance(df.schema[key_col].dataType, T.BinaryType):
        raise TypeError(f"{key_col}: binary keys have no JSON text; encode them first")
    per_key = (
        df.withColumn("_key", F.col(key_col).cast("string"))
        .groupBy(*group_cols, "_key")
        .agg(
            F.min(order_col).alias("_first"),
            # last value by order; ties on the order broken by the value itself
            F.max(
                F.struct(F.col(order_col).alias("o"), F.col(value_col).cast("string").alias("v"))
            ).alias("_last"),
        )
    )
    return per_key.withColumn("_last", F.col("_last").getField("v"))


def entries_to_json(first: str, key: str, value: str) -> Column:
    """Aggregate: a group's entries, one per key, as a JSON object in the order of ``first``; null keys are left out."""
    # collect_list leaves nulls out: a null key's row only keeps its group
    entries = F.array_sort(
        F.collect_list(
            F.when(F.col(key).isNotNull(), F.struct(F.col(first).alias("o"), F.col(key).alias("k"), F.col(value).alias("v")))
        )
    )
    return F.to_json(F.map_from_entries(F.transform(entries, lambda e: F.struct(e["k"], e["v"]))))
