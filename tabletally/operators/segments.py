"""Fold key/value rows into JSON maps whose size is bounded (G2, G3 for hot groups).

``pairs_to_json`` writes one object per group. Here a group with more than
``size`` distinct keys becomes several numbered rows, each the object of one
range of the group's keys in their order; joined in that order they are the
object ``pairs_to_json`` writes. No task holds a group: after the aggregate per
(group, key) the keys are dealt by ranges of (group, position, key), so that a
hot group lies in as many partitions as it needs, and a key's place in its group
is its place in the partition plus the group's rows in earlier partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import kept
from .pairs_json import entries_to_json, last_per_key


def pairs_to_json_segments(
    df: DataFrame, group_cols: list[str], key_col: str, value_col: str, order_col: str, size: int, out_col: str = "json"
) -> DataFrame:
    """``group_cols, segment (from 1), n_segments, n_keys, out_col``; semantics of the fold as in ``pairs_to_json``.

    A group with null keys only has one segment, ``{}``. The distinct keys are
    kept once in the session's checkpoint folder (or with the executors), since
    they are read twice.
    """
    if size < 1:
        raise ValueError("size must be at least 1")
    per_key = last_per_key(df, group_cols, key_col, value_col, order_col)
    order = [F.col("_none"), F.col("_first"), F.col("_key")]
    # null keys last: they add no entry, and must not move the places of the others
    dealt = per_key.withColumn("_none", F.col("_key").isNull()).repartitionByRange(*[F.col(c) for c in group_cols], *order)
    placed = kept(dealt.withColumn("_part", F.spark_partition_id()))
    real = F.count_if(~F.col("_none"))
    parts = placed.groupBy(*group_cols, "_part").agg(real.alias("_n"))
    # one row per group and partition that holds some of it
    by_group = Window.partitionBy(*group_cols)
    before = parts.select(
        *group_cols, "_part",
        F.coalesce(F.sum("_n").over(by_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(by_group).alias("n_keys"),
    )
    inside = F.row_number().over(Window.partitionBy(*group_cols, "_part").orderBy(*order))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*group_cols, "_part"]]
    ranked = placed.withColumn("_inside", inside).alias("p").join(before.alias("b"), same).select(
        "p.*", "b._before", "b.n_keys"
    )
    n_segments = F.greatest(F.ceil(F.col("n_keys") / size), F.lit(1))
    place = F.col("_before") + F.col("_inside") - 1
    segment = F.when(F.col("_none"), n_segments).otherwise(F.floor(place / size) + 1)
    return (
        ranked.withColumn("segment", segment).withColumn("n_segments", n_segments)
        .groupBy(*group_cols, "segment", "n_segments", "n_keys")
        .agg(entries_to_json("_first", "_key", "_last").alias(out_col))
    )
