"""Type names as they are stored in ``table_schema``."""

from __future__ import annotations

from pyspark.sql import types as T


def type_text(data_type: T.DataType) -> str:
    """Spark's short type name, e.g. ``bigint``, ``array<float>``, ``timestamp_ntz``.

    JDBC sources keep the server's own type text; file lakes have no server,
    so the name Spark reads from the footer stands in for it.
    """
    return data_type.simpleString()
