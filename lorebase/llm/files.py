"""Files that tasks write to and read from the shared folder.

A task writes each file under a name of its own and hands on a row that names it. Those rows are stored by Spark's own writer,
which keeps one attempt of each task; so the stored rows are the list of valid files, and what a lost or repeated attempt
left is in no list.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame


def attempt_path(folder: str, prefix: str, partition: int, number: int, suffix: str) -> str:
    return f"{folder}/{prefix}-{partition:06d}-{number:05d}-{uuid.uuid4().hex}{suffix}"


def open_output(path: str) -> pa.NativeFile:
    filesystem, name = pa.fs.FileSystem.from_uri(path)
    filesystem.create_dir(name.rpartition("/")[0], recursive=True)
    return filesystem.open_output_stream(name, compression=None)


def open_input(path: str) -> pa.NativeFile:
    filesystem, name = pa.fs.FileSystem.from_uri(path)
    return filesystem.open_input_file(name)


def one_file_a_task(listing: DataFrame) -> DataFrame:
    """The listing dealt out so that every file is read by a task of its own."""
    return listing.repartition(max(1, listing.count()))
