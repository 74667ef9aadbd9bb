"""Whole writes and range reads of files in the shared folder, from any executor."""

from __future__ import annotations

from urllib.parse import unquote, urlparse

from pyarrow import fs


def _local(path: str) -> str | None:
    parts = urlparse(path)
    if parts.scheme == "file":
        return unquote(parts.path)
    return path if not parts.scheme else None


def open_write(path: str):
    """A binary stream to a new file; folders are made. Give every attempt its own name."""
    if (local := _local(path)) is not None:
        import os

        os.makedirs(os.path.dirname(local), exist_ok=True)
        return open(local, "wb")
    system, inner = fs.FileSystem.from_uri(path)
    system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(inner, compression=None)


def open_read(path: str):
    """A binary stream with ``seek`` and ``read``."""
    if (local := _local(path)) is not None:
        return open(local, "rb")
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_file(inner)


def read_range(path: str, offset: int, length: int) -> bytes:
    with open_read(path) as f:
        f.seek(offset)
        return f.read(length)
