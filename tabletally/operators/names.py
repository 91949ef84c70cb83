"""Name lists as catalog filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exclude_names(df: DataFrame, col: str, names: Iterable[str]) -> DataFrame:
    """Rows whose ``col`` is not in ``names``; a null name is left out, as in SQL ``NOT IN``."""
    names = list(names)
    if not names:
        return df.where(F.col(col).isNotNull())
    return df.where(~F.col(col).isin(names))


def distinct_names(df: DataFrame, col: str, exclude: Iterable[str] = (), alias: str | None = None) -> DataFrame:
    """Distinct values of ``col`` minus ``exclude``: a database or owner list."""
    out = exclude_names(df.select(col), col, exclude).distinct()
    return out.withColumnRenamed(col, alias) if alias else out


def catalog_names(
    df: DataFrame,
    col: str,
    equals: Mapping[str, object] | None = None,
    exclude: Iterable[str] = (),
    include: Iterable[str] | None = None,
) -> DataFrame:
    """Catalog rows that pass the filters of a listing.

    Columns in ``equals`` have the given value, and ``col`` is outside
    ``exclude`` and, if given, inside ``include``. Over JDBC, Spark pushes all
    of it into the server's query.
    """
    for name, value in (equals or {}).items():
        df = df.where(F.col(name) == F.lit(value))
    df = exclude_names(df, col, exclude)
    return df if include is None else df.where(F.col(col).isin(list(include)))
