"""A data source of document pages: a folder of documents as one row per page, long documents read by many tasks.

    spark.dataSource.register(PageSource)
    spark.read.format("document_pages").load(folder)
    spark.readStream.format("document_pages").load(folder)

Rows: path, product_name (the file's name without the suffix), place (where the page starts in the file), text, error. Pages end at a
form feed; what is cut is the file: a task reads the pages that start in its stretch of `splitBytes`, so a document is read in
parallel, and a page is held one at a time. Small documents share a task, and of many small stretches a task takes about a TASKS-th
of all bytes, so that the number of tasks doesn't grow with the folder where `splitBytes` is small. A filter on product_name for one or
several names is pushed to the listing, so other files aren't opened. Options: suffix (".pdf"; case matters), splitBytes, filesPerTask.

A page that can't be decoded has a null text and an error; `documents_of` puts pages together and makes such a document null. Other kinds of
documents need a class of their own with `pages(file, start, end, size)`; one that can't be cut sets `whole`.

As a stream, the offset is the newest modification time and name seen: files are taken in that order, and a file that is moved in with
an older time than one already read is not seen. A restart goes on after the last batch that was committed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, In, InputPartition
from pyspark.sql.types import StructType

from lorebase.functions.text import strip

PAGES = "path STRING, product_name STRING, place BIGINT, text STRING, error STRING"
SCHEMA = pa.schema([("path", pa.string()), ("product_name", pa.string()), ("place", pa.int64()), ("text", pa.string()), ("error", pa.string())])
SPLIT_BYTES, FILES_PER_TASK = 64 << 20, 1_000
#: Tasks up to which each takes a single stretch; beyond it they take several, up to SPLIT_BYTES together.
TASKS = 256
#: Bytes read at once; bytes and pages of a batch.
CHUNK, BATCH_BYTES, BATCH_PAGES = 1 << 20, 4 << 20, 1 << 12
BREAK = b"\f"


@dataclass
class Stretch(InputPartition):
    """What one task reads: (path, start, end, size) of stretches of files."""

    parts: list[tuple[str, int, int, int]]


class FormFeedPages:
    """Pages of a text file that form feeds separate. A page belongs to the stretch that it starts in."""

    whole = False

    def pages(self, file: pa.NativeFile, start: int, end: int, size: int) -> Iterator[tuple[int, bytes]]:
        place, held = start, b""
        if start:
            # The first page here starts after the first break from the byte before on.
            file.seek(start - 1)
            place = start - 1
            while BREAK not in held:
                place += len(held)
                held = file.read(CHUNK)
                if not held:
                    return
            skipped = held.index(BREAK) + 1
            place, held = place + skipped, held[skipped:]
        parts = [held]
        while place < end or (place == end == size):
            while BREAK not in parts[-1]:
                more = file.read(CHUNK)
                if not more:
                    # The last page has no break after it.
                    yield place, b"".join(parts)
                    return
                parts.append(more)
            head, _, rest = parts[-1].partition(BREAK)
            page = b"".join([*parts[:-1], head])
            yield place, page
            place, parts = place + len(page) + 1, [rest]


def listed(folder: str, suffix: str) -> list[tuple[str, int, int]]:
    """(path, size, modification time in ns) of the folder's own files of that suffix, in the order of time and name."""
    filesystem, root = pyarrow.fs.FileSystem.from_uri(folder) if ":/" in folder else (pyarrow.fs.LocalFileSystem(), folder)
    scheme = folder.split(":/")[0] + "://" if ":/" in folder else ""
    found = filesystem.get_file_info(pyarrow.fs.FileSelector(root, allow_not_found=True))
    files = [(scheme + one.path, one.size, one.mtime_ns) for one in found if one.is_file and one.base_name.endswith(suffix)]
    return sorted(files, key=lambda file: (file[2], file[0]))


def opened(path: str) -> pa.NativeFile:
    filesystem, name = pyarrow.fs.FileSystem.from_uri(path) if ":/" in path else (pyarrow.fs.LocalFileSystem(), path)
    return filesystem.open_input_file(name)


class PageFolder:
    """What the reader and the stream reader share: options, the cutting of files, reading."""

    def __init__(self, options: dict, kind: FormFeedPages):
        self.folder, self.suffix, self.kind = options["path"], options.get("suffix", ".pdf"), kind
        self.split = int(options.get("splitbytes", SPLIT_BYTES))
        self.most = int(options.get("filespertask", FILES_PER_TASK))

    def key(self, path: str) -> str:
        return path.rpartition("/")[2].replace(self.suffix, "")

    def cut(self, files: list[tuple[str, int, int]]) -> list[Stretch]:
        """Stretches of at most `split` bytes, small ones together; neighbours that meet in a task are one stretch."""
        most = max(self.split, min(SPLIT_BYTES, sum(size for _, size, _ in files) // TASKS))
        tasks: list[Stretch] = []
        held, room = [], 0
        for path, size, _ in files:
            edges = [0, size] if self.kind.whole or size <= self.split else [*range(0, size, self.split), size]
            for start, end in zip(edges, edges[1:]):
                if held and (room + end - start > most or len(held) >= self.most):
                    tasks.append(Stretch(held))
                    held, room = [], 0
                if held and start and held[-1][0] == path:
                    held[-1] = (path, held[-1][1], end, size)
                else:
                    held.append((path, start, end, size))
                room += end - start
        return tasks + [Stretch(held)] if held else tasks

    def rows(self, part: Stretch) -> Iterator[tuple]:
        for path, start, end, size in part.parts:
            try:
                with opened(path) as file:
                    for place, page in self.kind.pages(file, start, end, size):
                        try:
                            yield path, self.key(path), place, page.decode("utf-8"), None
                        except UnicodeDecodeError as problem:
                            yield path, self.key(path), place, None, f"{type(problem).__name__}: {problem}"
            except OSError as problem:
                yield path, self.key(path), start, None, f"{type(problem).__name__}: {problem}"

    def batches(self, part: Stretch) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in self.rows(part):
            held.append(row)
            size += len(row[3] or "")
            if size >= BATCH_BYTES or len(held) >= BATCH_PAGES:
                yield pa.record_batch([pa.array(column, field.type) for column, field in zip(zip(*held), SCHEMA)], schema=SCHEMA)
                held, size = [], 0
        if held:
            yield pa.record_batch([pa.array(column, field.type) for column, field in zip(zip(*held), SCHEMA)], schema=SCHEMA)


class PageReader(DataSourceReader):
    def __init__(self, folder: PageFolder):
        self.folder, self.names = folder, None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Names that the listing can look for; other filters are left to Spark."""
        for one in filters:
            wanted = {one.value} if isinstance(one, EqualTo) else set(one.value) if isinstance(one, In) else None
            if wanted is None or one.attribute != ("product_name",):
                yield one
            else:
                self.names = wanted if self.names is None else self.names & wanted

    def partitions(self) -> Sequence[Stretch]:
        files = listed(self.folder.folder, self.folder.suffix)
        if self.names is not None:
            files = [file for file in files if self.folder.key(file[0]) in self.names]
        return self.folder.cut(files) or [Stretch([])]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return self.folder.batches(partition)


class PageStreamReader(DataSourceStreamReader):
    def __init__(self, folder: PageFolder):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        files = listed(self.folder.folder, self.folder.suffix)
        return {"time": files[-1][2], "path": files[-1][0]} if files else self.initialOffset()

    def partitions(self, start: dict, end: dict) -> Sequence[Stretch]:
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        return self.folder.cut([file for file in listed(self.folder.folder, self.folder.suffix) if low < (file[2], file[0]) <= high])

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        return self.folder.batches(partition)


class PageSource(DataSource):
    """The source; a subclass may read another kind of documents."""

    kind = FormFeedPages()

    @classmethod
    def name(cls) -> str:
        return "document_pages"

    def schema(self) -> str:
        return PAGES

    def reader(self, schema: StructType) -> PageReader:
        return PageReader(PageFolder(self.options, self.kind))

    def streamReader(self, schema: StructType) -> PageStreamReader:
        return PageStreamReader(PageFolder(self.options, self.kind))


def read_pages(spark: SparkSession, folder: str, suffix: str = ".pdf", split_bytes: int = SPLIT_BYTES, source: type[PageSource] = PageSource) -> DataFrame:
    """The pages of a folder's documents, with filters on product_name pushed to the listing."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(source)
    return spark.read.format(source.name()).option("suffix", suffix).option("splitBytes", split_bytes).load(folder)


def stream_pages(spark: SparkSession, folder: str, suffix: str = ".pdf", split_bytes: int = SPLIT_BYTES, source: type[PageSource] = PageSource) -> DataFrame:
    """The pages of documents that are new since the last run."""
    # Pushed filters are of no use to a stream, and Spark doesn't ask a stream reader for them.
    spark.dataSource.register(source)
    return spark.readStream.format(source.name()).option("suffix", suffix).option("splitBytes", split_bytes).load(folder)


def documents_of(pages: DataFrame) -> DataFrame:
    """Pages to documents: (product_name, product_doc, error), as `extract_documents` makes of whole files.

    Each page is followed by a line break, the whole is stripped; one unreadable page makes the document null and names the
    error. Files are told by their paths. A document is one row, whatever tasks its pages came from.
    """
    whole = pages.groupBy("path").agg(
        F.first("product_name").alias("product_name"),
        F.array_sort(F.collect_list(F.struct("place", "text"))).alias("_pages"),
        F.min_by("error", F.when(F.col("error").isNotNull(), F.col("place"))).alias("error"),
    )
    text = strip(F.array_join(F.transform("_pages", lambda page: F.concat(page["text"], F.lit("\n"))), ""))
    return whole.select("product_name", F.when(F.col("error").isNull(), text).alias("product_doc"), "error")
