"""Files that tasks write to and read from the folder shared by driver and executors.

A plain path or file:// is opened as it stands (the folder is mounted
everywhere); other schemes go through ``pyarrow.fs``.  A file appears under its
name only when complete, so a task that is lost or runs twice does no harm.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow.fs as pafs


def _local(path: str) -> str | None:
    url = urlparse(path)
    return url.path if url.scheme in ("", "file") else None


def put(path: str, data: bytes | memoryview) -> None:
    """Writes a whole file; an equal file of another attempt is replaced."""
    local = _local(path)
    part = f".{uuid.uuid4().hex}.part"
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local + part, "wb") as out:
            out.write(data)
        os.replace(local + part, local)
        return
    fs, name = pafs.FileSystem.from_uri(path)
    fs.create_dir(os.path.dirname(name), recursive=True)
    with fs.open_output_stream(name + part) as out:
        out.write(data)
    fs.move(name + part, name)


def get(path: str) -> bytes:
    local = _local(path)
    if local is not None:
        with open(local, "rb") as file:
            return file.read()
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(name) as file:
        return file.read()


def mapped(path: str, dtype: str) -> np.ndarray:
    """The file as a read-only array, memory-mapped.

    A file of a remote store is fetched to a temporary file without a name,
    which goes with the mapping.
    """
    local = _local(path)
    if local is not None:
        return np.memmap(local, dtype=dtype, mode="r") if os.path.getsize(local) else np.zeros(0, dtype)
    fs, name = pafs.FileSystem.from_uri(path)
    with fs.open_input_stream(name) as source, tempfile.TemporaryFile() as copy:
        while chunk := source.read(8 << 20):
            copy.write(chunk)
        copy.flush()
        return np.memmap(copy, dtype=dtype, mode="r") if copy.tell() else np.zeros(0, dtype)
