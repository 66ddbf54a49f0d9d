"""What the operators share: Arrow batches of bounded size, free column names, tables written once."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from lorebase.session import fresh_path, remove

#: Bytes of text that a step over whole batches works on at a time.
RUN_BYTES = 1 << 20
#: Bytes and rows after which a task hands a batch on.
BATCH_BYTES = 4 << 20
BATCH_ROWS = 4096

Batches = Iterator[pa.RecordBatch]


def weight(value) -> int:
    """Roughly the bytes that a value takes; exact enough to bound a batch."""
    return len(value) * getattr(value, "itemsize", 1) if hasattr(value, "__len__") else 8


def in_batches(rows: Iterable[tuple], schema: pa.Schema) -> Batches:
    """Rows as record batches of bounded size, each row held once."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(map(weight, row))
        if size >= BATCH_BYTES or len(held) >= BATCH_ROWS:
            yield record_batch(held, schema)
            held, size = [], 0
    if held:
        yield record_batch(held, schema)


def record_batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows)
    return pa.record_batch([pa.array(column, type=field.type) for column, field in zip(columns, schema)], schema=schema)


def rows_of(batches: Batches) -> Iterator[tuple]:
    """The rows of record batches as tuples, converted a slice at a time: a long text is never held twice for a whole batch."""
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            yield from zip(*(column.to_pylist() for column in part.columns))


def runs_of(texts: pa.Array, size: int) -> Iterator[tuple[int, int]]:
    """(start, count) of runs of rows with about `size` bytes of text, a longer text alone."""
    start, held = 0, 0
    for place, length in enumerate(pc.binary_length(texts).to_pylist()):
        held += length or 0
        if held >= size:
            yield start, place + 1 - start
            start, held = place + 1, 0
    if start < len(texts):
        yield start, len(texts) - start


def by_runs(batches: Batches, place: int, size: int = RUN_BYTES) -> Batches:
    """The batches cut into runs with about `size` bytes of text in the column at `place`."""
    for batch in batches:
        for start, count in runs_of(batch.column(place), size):
            yield batch.slice(start, count)


def give_back() -> None:
    """Hand memory that is free to the system; otherwise a Python worker keeps the most it ever held for all later tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def in_task(*steps: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """`steps`, one after the other in the same task, which gives its memory back at its end."""

    def job(batches: Batches) -> Batches:
        for step in steps:
            batches = step(batches)
        yield from batches
        del batches
        give_back()

    return job


def map_batches(df: DataFrame, schema: str | StructType, *steps: Callable[[Batches], Batches]) -> DataFrame:
    """`df` through `steps`, one after the other in the same task."""
    return df.mapInArrow(in_task(*steps), schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """`wanted`, with underscores added until no column of `df` has that name."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def key_type(df: DataFrame, key: str) -> tuple[str, pa.DataType]:
    """The type of a column in SQL and in Arrow."""
    kind = df.schema[key].dataType
    return kind.simpleString(), to_arrow_type(kind)


class Written:
    """A table written once to the shared folder; `drop()` removes its files when nothing reads it any more."""

    def __init__(self, df: DataFrame, name: str, partition_by: list[str] | None = None):
        self.spark, self.path = df.sparkSession, fresh_path(df.sparkSession, name)
        df.write.parquet(self.path, partitionBy=partition_by)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        remove(self.spark, self.path)

