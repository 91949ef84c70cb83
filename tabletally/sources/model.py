"""What a source is: a name, a kind, and how to reach it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

FILE_KINDS = ("parquet", "orc")
JDBC_KINDS = ("postgresql", "mssql", "oracle")
KINDS = FILE_KINDS + JDBC_KINDS
# File lakes: tables directly under the path, or under one folder per database.
LAYOUTS = ("flat", "database/table")


@dataclass(frozen=True)
class Source:
    """A place whose tables are inventoried.

    File lakes (``kind`` in ``FILE_KINDS``) use ``path``. With ``layout``
    ``"flat"`` every direct child that is a directory, or a file ending in
    ``.<kind>``, is a table, listed under the namespace ``database``. With
    ``"database/table"`` every child folder is a database (a ``.db`` suffix
    is dropped, ``exclude_databases`` apply) holding such tables. JDBC servers use host/port/user/password;
    ``options`` are passed to the JDBC reader as they are. Credentials are
    taken from the caller and are never logged (``repr`` hides them).
    """

    name: str
    kind: str
    path: str | None = None
    database: str = "main"
    host: str | None = None
    port: int | str | None = None
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    layout: str = "flat"
    include_tables: tuple[str, ...] | None = None
    exclude_tables: tuple[str, ...] = ()
    exclude_databases: tuple[str, ...] | None = None
    options: Mapping[str, str] = field(default_factory=dict, repr=False)

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"Unsupported source type: {self.kind}")
        if self.kind in FILE_KINDS and not self.path:
            raise ValueError(f"source {self.name!r}: a file lake needs a path")
        if self.layout not in LAYOUTS:
            raise ValueError(f"source {self.name!r}: layout must be one of {LAYOUTS}")
        if self.kind in JDBC_KINDS and not self.host:
            raise ValueError(f"source {self.name!r}: a JDBC source needs a host")

    @property
    def is_files(self) -> bool:
        return self.kind in FILE_KINDS

    def keeps_table(self, table: str) -> bool:
        if self.include_tables is not None and table not in self.include_tables:
            return False
        return table not in self.exclude_tables

    def keeps_lake_table(self, database: str, table: str) -> bool:
        """For lakes: the table filters, and no database exclusion by default."""
        return self.keeps_table(table) and database not in (self.exclude_databases or ())
