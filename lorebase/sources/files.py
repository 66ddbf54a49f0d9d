"""Rows written out as files of their own."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame


def write_files(files: DataFrame, folder: str) -> int:
    """Write each row (name, content) as the file `name` in a folder that all tasks reach; the number of files.

    A task that runs again writes the same files again; a name that occurs twice is one file.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = pyarrow.fs.FileSystem.from_uri(folder)
        filesystem.create_dir(path, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with filesystem.open_output_stream(f"{path}/{name}", compression=None) as out:
                    out.write(content or b"")
            yield pa.record_batch([pa.array([batch.num_rows], type=pa.int64())], names=["n"])

    return files.select("name", "content").mapInArrow(write, "n BIGINT").groupBy().sum("n").first()[0] or 0
