"""Files of any file system that tasks write and read themselves.

A URI (`hdfs://`, `s3://`, `gs://`, `abfs://`, `file://`) names its file system. A bare path is one
of the machine, which is the same for all tasks on one machine only; on a cluster it is refused,
because pages would end up scattered over the executors. `file://` says that all of them mount it.
"""

from __future__ import annotations

import posixpath
from collections.abc import Callable
from typing import BinaryIO

from pyarrow import fs as pafs
from pyspark.sql import SparkSession


def shared_uri(spark: SparkSession, path: str) -> str:
    """The URI of a folder or file that all tasks reach; an error for a bare path on a cluster."""
    if "://" in path or path.startswith("file:"):
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{path} is a path of one machine; name a URI that all executors reach")
    return "file://" + posixpath.abspath(path)


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri.removeprefix("file:").replace("///", "/", 1).replace("//", "/", 1) if uri.startswith("file://") else uri.removeprefix("file:")
    return pafs.FileSystem.from_uri(uri)


class Folder:
    """A folder below which a task writes files, each whole or not at all."""

    def __init__(self, uri: str, attempt: int):
        self.fs, self.root = _place(uri)
        self.attempt, self._made = attempt, set()

    def path(self, name: str) -> str:
        """Where `name` lies; an error if it leaves the folder."""
        full = posixpath.normpath(posixpath.join(self.root, name))
        if not full.startswith(self.root.rstrip("/") + "/"):
            raise ValueError(f"entry outside of the folder: {name}")
        return full

    def put(self, name: str, write: Callable[[BinaryIO], None]) -> str:
        full = self.path(name)
        parent = posixpath.dirname(full)
        if parent not in self._made:
            self.fs.create_dir(parent, recursive=True)
            self._made.add(parent)
        part = f"{full}.{self.attempt}.part"  # a task may run twice
        with self.fs.open_output_stream(part) as out:
            write(out)
        self.fs.move(part, full)
        return full


def open_input(uri: str):
    """A random-access file."""
    fs, path = _place(uri)
    return fs.open_input_file(path)
