"""Files that tasks write and read themselves, under a folder that all of them see."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.fs as pafs


def folder(root: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path or URI, and the path there."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    return pafs.FileSystem.from_uri(root) if "://" in root else (pafs.LocalFileSystem(), root)


@contextmanager
def whole_file(fs: pafs.FileSystem, name: str) -> Iterator[pa.NativeFile]:
    """A new file that takes its name only when it is complete: a repeated task replaces it with the same content."""
    draft = f"{name}.{uuid.uuid4().hex}.tmp"
    try:
        with fs.open_output_stream(draft) as out:
            yield out
    except BaseException:
        fs.delete_file(draft)
        raise
    fs.move(draft, name)
