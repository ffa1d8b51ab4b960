"""Binary files in the shared folder, written and read by tasks."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyarrow import fs


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI (file:, hdfs:, s3:, gs:) or plain path, and the path in it."""
    return fs.FileSystem.from_uri(uri)


def new_file(folder: str, suffix: str) -> tuple[str, Callable]:
    """A name that no other attempt of any task uses, and how to open it for writing.

    A task that is run again writes another file; only files named in a table that Spark has
    committed count, so what a lost attempt left behind is never read.
    """
    system, path = open_folder(folder)
    system.create_dir(path, recursive=True)
    name = f"{uuid.uuid4().hex}{suffix}"
    return name, lambda: system.open_output_stream(f"{path}/{name}", compression=None)
