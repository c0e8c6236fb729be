"""Files in the shared folder, by its URI (file:, hdfs:, s3:, gs: through pyarrow)."""

from __future__ import annotations

import os

from pyarrow import fs


def open_fs(uri: str):
    """(file system, path) of a URI or of a plain local path."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def write_bytes(uri: str, data: bytes) -> None:
    """Write one whole file, making its folder."""
    system, path = open_fs(uri)
    system.create_dir(os.path.dirname(path), recursive=True)
    with system.open_output_stream(path) as out:
        out.write(data)


__all__ = ["open_fs", "write_bytes"]
