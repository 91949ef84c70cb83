"""Files of any store that Arrow can open, by their URI, inside tasks and data sources."""

from __future__ import annotations

from urllib.parse import quote, unquote, urlsplit

#: Stores opened in this process, by scheme and authority.
_OPEN: dict[tuple[str, str], object] = {}


def open_store(uri: str):
    """``(file system, path in it)`` of an encoded URI; raises for a store Arrow does not know."""
    from pyarrow import fs

    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return _OPEN.setdefault(("file", ""), fs.LocalFileSystem()), unquote(parts.path)
    store = _OPEN.get((parts.scheme, parts.netloc))
    if store is None:
        store, path = fs.FileSystem.from_uri(uri)
        _OPEN[parts.scheme, parts.netloc] = store
        return store, path
    return store, type(store).from_uri(uri)[1]


def can_open(uri: str) -> bool:
    """Whether this process can list the folder ``uri`` through Arrow."""
    from pyarrow import fs

    try:
        store, path = open_store(uri)
        return store.get_file_info(path).type != fs.FileType.NotFound
    except Exception:  # noqa: BLE001 - an unknown store, or one without access
        return False


def children(uri: str) -> list[tuple[str, str, bool]]:
    """``(name, URI, is a folder)`` of the visible children of a folder, by name."""
    from pyarrow import fs

    store, path = open_store(uri)
    found = store.get_file_info(fs.FileSelector(path))
    return sorted(
        (f.base_name, f"{uri.rstrip('/')}/{quote(f.base_name)}", f.type == fs.FileType.Directory)
        for f in found
        if not f.base_name.startswith(("_", "."))
    )


def qualified_uri(spark, path: str) -> str:
    """The encoded, fully qualified URI of a path as Hadoop sees it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p).toUri().toString()
