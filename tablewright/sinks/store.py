"""Files of a shared store from Python workers."""

from __future__ import annotations


def store_of(path: str):
    """(file system, path within it) of a folder that Spark names: a local path or
    any address that ``pyarrow.fs`` supports."""
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)
