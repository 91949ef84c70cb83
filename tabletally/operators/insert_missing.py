"""Insert the rows whose key the target lacks (J1, W3, W4 in general form).

``missing_rows`` is pure: it keeps one row per key of the batch (the last by
``order``), drops keys the target already has, and returns the rest. Both
sides are reduced to one row per key by aggregates that combine map-side, so
a key holding a third of all rows costs one row per task in the shuffle, and
the left anti join then sees unique keys on both sides. The join reuses the
hash partitioning of those aggregates: two shuffles in all, one per side.
The join strategy is left to AQE, which turns it into a broadcast only when
the measured size of the target's keys is under the broadcast threshold.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import any_null


def latest_per_key(
    batch: DataFrame,
    keys: list[str],
    order: list[str | Column] | None = None,
    keep_null_keys: bool = False,
) -> DataFrame:
    """One row per key: the greatest by ``order``, then by the whole row.

    The whole row as last tie-breaker makes the choice deterministic (all
    columns must be orderable: no map columns). Rows with a null key are
    left out unless ``keep_null_keys``; then they collapse per key like the
    others (a null key can never match, so they are only ever reported).
    """
    cols = batch.columns
    order_names = [o for o in (order or []) if isinstance(o, str)]
    order_exprs = [F.col(o) if isinstance(o, str) else o for o in (order or [])]
    # Keys come from the grouping columns and named order columns from the
    # ranking, so the payload holds neither twice; and the output keeps the
    # aggregate's hash partitioning for a following join on the keys.
    rest = [c for c in cols if c not in keys and c not in order_names]
    ranked = F.struct(
        *[e.alias(f"_o{i}") for i, e in enumerate(order_exprs)],
        *([F.struct(*[F.col(c) for c in rest]).alias("_row")] if rest else [F.lit(True).alias("_row")]),
    )
    place = {o: f"_best._o{i}" for i, o in reversed([*enumerate(order or [])]) if isinstance(o, str)}
    place |= {c: f"_best._row.{c}" for c in rest}
    rows = batch if keep_null_keys else batch.where(~any_null(keys))
    return (
        rows.groupBy(*keys)
        .agg(F.max(ranked).alias("_best"))
        .select(*[F.col(c) if c in keys else _field(place[c]).alias(c) for c in cols])
    )


def _field(path: str) -> Column:
    """A nested field by its path; the last step may hold any characters."""
    parts = path.split(".", 2)
    out = F.col(parts[0])
    for part in parts[1:]:
        out = out.getField(part)
    return out


def known_keys(target: DataFrame, keys: list[str], batch: DataFrame | None = None) -> DataFrame:
    """Non-null keys of ``target``; with ``batch``, only those the batch has.

    Narrowing is a left semi join. Where the planner knows the batch to be small
    (a local relation, say) it filters the target map-side, so a large target is
    read but never shuffled whole.
    """
    known = target.select(*keys).where(~any_null(keys))
    if batch is None:
        return known
    return known.join(batch.select(*keys).where(~any_null(keys)), keys, "left_semi")


def missing_rows(
    batch: DataFrame,
    target: DataFrame,
    keys: list[str],
    order: list[str | Column] | None = None,
    keep_null_keys: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Rows of ``batch`` (one per key) whose key is not in ``target``.

    A caller whose batch has one row per key says so with ``unique``; otherwise
    the batch is reduced first. With ``keep_null_keys`` rows with a null key are
    kept: they never match, so the left anti join lets them through.
    """
    if unique:
        rows = batch if keep_null_keys else batch.where(~any_null(keys))
        return rows.join(known_keys(target, keys, rows), keys, "left_anti")
    # distinct keys on both sides: a key with a third of the target's rows is one row in the join
    known = known_keys(target, keys).distinct()
    return latest_per_key(batch, keys, order, keep_null_keys).join(known, keys, "left_anti")


def null_key_rows(batch: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that cannot be inserted because a key column is null."""
    return batch.where(any_null(keys))


def insert_missing(
    batch: DataFrame,
    target: DataFrame,
    write,
    keys: list[str],
    order: list[str | Column] | None = None,
    reject_null_keys: bool = True,
) -> int:
    """Write the missing rows with ``write(df)``; return how many were written.

    With ``reject_null_keys`` any null key raises before anything is written;
    without it such rows are left out. The test reads the key columns only.
    """
    if reject_null_keys:
        refuse_null_keys(batch, keys)
    return write_if_any(missing_rows(batch, target, keys, order), write)


def refuse_null_keys(batch: DataFrame, keys: list[str]) -> None:
    if not null_key_rows(batch.select(*keys), keys).isEmpty():
        raise ValueError(f"batch has rows with a null key in {keys}")


def write_if_any(missing: DataFrame, write) -> int:
    """Write ``missing`` if it has any row; return how many rows were written.

    The rows are evaluated once, by the count, which keeps them on the
    executors (memory, then disk) for the write; a lost executor's part is
    evaluated again. Counting before the write makes the number independent of
    how the sink runs: a sink that asks for the rows as an RDD, as JDBC does,
    evaluates a plan of its own. ``rebalance`` lets AQE size the files by bytes:
    a daily append of a few keys is one file, a big one keeps its parallelism.
    """
    rows = missing.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = rows.count()
        if n:
            write(rows.hint("rebalance"))
        return n
    finally:
        rows.unpersist()
