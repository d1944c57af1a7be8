"""Binary files in the shared folder, opened by tasks through pyarrow's file systems."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyarrow import fs


def _at(uri: str) -> tuple[fs.FileSystem, str]:
    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    return fs.FileSystem.from_uri(uri)


def make_folder(uri: str) -> None:
    system, path = _at(uri)
    system.create_dir(path, recursive=True)


def open_file(uri: str) -> pa.NativeFile:
    system, path = _at(uri)
    return system.open_input_file(path)


@contextmanager
def publish(uri: str) -> Iterator[pa.NativeFile]:
    """Write under a hidden name of its own, then rename: other tasks see whole files only, and a task
    that is run again replaces the file by the same one."""
    system, path = _at(uri)
    folder, _, name = path.rpartition("/")
    system.create_dir(folder, recursive=True)
    hidden = f"{folder}/_{uuid.uuid4().hex}-{name}.part"
    with system.open_output_stream(hidden) as out:
        yield out
    if system.type_name != "local" and system.get_file_info(path).type != fs.FileType.NotFound:
        system.delete_file(path)
    system.move(hidden, path)
