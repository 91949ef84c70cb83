"""Column expressions shared by the operators."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme ":" ["//" authority] path  ->  path, still URI-encoded
_URI_PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*:(?://[^/]*)?(/.*)$"


_GLOB_CHARS = "\\*?[]{}"


def literal_path(path: str) -> str:
    """``path`` with glob characters escaped, so a reader takes it as it is.

    Spark's file readers expand glob patterns: a table folder named
    ``br[1]`` would otherwise be looked up as ``br1``, and ``q?x`` would
    also match ``qax``.
    """
    return "".join("\\" + c if c in _GLOB_CHARS else c for c in path)


def uri_raw_path(col: Column) -> Column:
    """The encoded path part of a file URI such as ``_metadata.file_path``."""
    return F.regexp_extract(col, _URI_PATH, 1)


def leading_components(raw_path: Column, n: int) -> Column:
    """The first ``n`` components of an absolute path: ``/a/b/c``, 2 -> ``/a/b``."""
    return F.regexp_extract(raw_path, "^((?:/[^/]*){%d})" % n, 1)


def as_of_date(as_of: dt.date | str | None) -> Column:
    """Audit date (K2, K3): a fixed date when given, else the session's today."""
    if as_of is None:
        return F.current_date()
    return F.lit(str(as_of)).cast("date")


def any_null(cols: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in cols])
