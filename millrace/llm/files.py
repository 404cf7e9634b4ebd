"""Binary files in the shared folder, from executors: written under a name of the attempt, then renamed."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow.fs as pafs


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, and the path in it."""
    return pafs.FileSystem.from_uri(uri if "://" in uri else f"file://{uri}" if not uri.startswith("file:") else uri.replace("file:", "file://", 1))


@contextmanager
def committed(uri: str) -> Iterator:
    """An output stream; the file has its name only once it is whole, so a lost or doubled attempt leaves no part of it."""
    fs, path = file_system(uri)
    folder, _, name = path.rpartition("/")
    fs.create_dir(folder, recursive=True)
    attempt = f"{folder}/.{name}.{uuid.uuid4().hex}"
    try:
        with fs.open_output_stream(attempt) as out:
            yield out
        if fs.get_file_info(path).type != pafs.FileType.NotFound:
            # an earlier attempt's; not every file system moves onto it
            fs.delete_file(path)
        fs.move(attempt, path)
    except BaseException:
        if fs.get_file_info(attempt).type != pafs.FileType.NotFound:
            fs.delete_file(attempt)
        raise


@contextmanager
def written(uri: str) -> Iterator:
    """An output stream to a name that no other attempt has; only who is told the name reads the file."""
    fs, path = file_system(uri)
    fs.create_dir(path.rpartition("/")[0], recursive=True)
    with fs.open_output_stream(path) as out:
        yield out


def opened(uri: str):
    fs, path = file_system(uri)
    return fs.open_input_file(path)
