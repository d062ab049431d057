"""Binary files in the shared folder, written and mapped inside tasks.

Paths are URIs (or local paths) of any store that pyarrow knows; files of a local or
mounted folder are memory-mapped, others are read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyarrow import fs


def _resolve(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):  # also the one-slash form that Hadoop prints
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


class Writer:
    """Appends arrays to a new file; usable in a ``with`` block."""

    def __init__(self, path: str):
        store, inner = _resolve(path)
        store.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        self._out = store.open_output_stream(inner)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self._out.close()

    def write(self, data) -> int:
        view = memoryview(data).cast("B") if len(data) else b""
        self._out.write(view)
        return len(view)


def mapped(path: str) -> pa.Buffer:
    """The file as a buffer: a memory map where that is possible."""
    store, inner = _resolve(path)
    if isinstance(store, fs.LocalFileSystem):
        return pa.memory_map(inner).read_buffer()
    with store.open_input_file(inner) as f:
        return f.read_buffer()


def array(buffer: pa.Buffer, kind: str, start: int = 0, count: int = -1) -> np.ndarray:
    """A view of ``count`` items of a little-endian ``kind`` from byte ``start``."""
    if count == 0 or buffer.size == start:
        return np.empty(0, np.dtype(kind).newbyteorder("<"))
    return np.frombuffer(buffer, np.dtype(kind).newbyteorder("<"), count=count, offset=start)


class Pieces:
    """Reads parts of one file by place; neighbouring parts cost one read."""

    def __init__(self, path: str, ahead: int = 4 << 20):
        store, inner = _resolve(path)
        self._file = pa.memory_map(inner) if isinstance(store, fs.LocalFileSystem) else store.open_input_file(inner)
        self._ahead, self._start, self._held = ahead, 0, b""

    def get(self, start: int, length: int) -> bytes:
        a = start - self._start
        if a < 0 or a + length > len(self._held):
            self._start, a = start, 0
            self._held = self._file.read_at(max(length, self._ahead), start)
        return self._held[a:a + length]


@functools.lru_cache(maxsize=8)
def pieces(path: str) -> Pieces:
    return Pieces(path)
