"""Vector search over product-quantised codes: every vector is scanned as a few bytes, the likeliest are scored again exactly.

A code is the number of the nearest of a few coarse centres and, for each part of the rest, the number of the nearest entry of that
part's codebook. A query's score with a code is a sum of entries of its own tables, one look-up per byte: the tables hold the inner
products of the query with all centres and entries. Candidates are the codes whose score is at most MARGIN standard errors below the k-th
best one (the error of a code's score is measured when the codebooks are fitted); only their vectors are read, and ranked by their
exact scores. So a query in a thin place has few candidates and one in a dense place as many as it needs: up to CANDIDATES over
all queries of a block, the best codes first and equal ones by id.

The codebooks are fitted on a sample of at most 2 * SAMPLE vectors, drawn by a hash of their ids; every vector is encoded. They are a few
hundred KB whatever the table, so they travel with the tasks. The vectors are written as fixed-width rows in one file a task, which only
re-ranking reads, at the places that a code's row names; the codes are a table of their own. What a lost task attempt wrote is named by no row.

A search reads all codes, so it is never exact by right: `recall` of `operators.search` measures it. Vectors and queries that are null or not
finite are left out; all vectors have one length; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from lorebase.operators.search import SCORES, VECTOR_ID, finite, first_k, matrix_of, query_block, ranked, stored_queries, usable
from lorebase.session import fresh_path, stored

#: Vectors that codebooks are fitted on, about.
SAMPLE = 1 << 14
PARTS, CENTRES, LEVELS, ROUNDS = 32, 32, 256, 8
#: Queries of a block up to which codes are looked up in tables.
FEW = 32
#: Standard errors of a code's score that a candidate may lie below the k-th best one; candidates of a block, and of a query at least.
MARGIN, CANDIDATES, DEPTH = 3.0, 1 << 22, 64
#: New candidates that a task gathers before it cuts them to the best ones, at least; candidates of a batch that it gives out.
MERGE, GIVEN = 1 << 19, 1 << 15
#: Rows that are written, and bytes between two wanted rows up to which one read takes both.
SLICE, GAP = 1 << 12, 1 << 14


def nearest(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The number of the centre nearest to each row, of equally near ones the first."""
    return np.argmax(rows @ centres.T - (centres * centres).sum(axis=1) / 2, axis=1)


def clustered(rows: np.ndarray, most: int, draw: np.random.Generator) -> np.ndarray:
    """Centres of at most `most` clusters of the rows, by Lloyd's rounds from randomly chosen distinct rows."""
    # Some more than wanted are drawn, as rows may be copies of each other.
    some = rows if len(rows) <= 4 * most else rows[draw.choice(len(rows), 4 * most, replace=False)]
    distinct = np.unique(some, axis=0)
    centres = distinct[np.sort(draw.choice(len(distinct), min(most, len(distinct)), replace=False))]
    for _ in range(ROUNDS if len(rows) > len(centres) else 0):
        own = nearest(rows, centres)
        number = np.bincount(own, minlength=len(centres))
        sums = np.stack([np.bincount(own, column, len(centres)) for column in rows.T], axis=1)
        # A centre without rows stays where it is.
        centres = np.where(number[:, None] > 0, sums / np.maximum(number, 1)[:, None], centres)
    return centres


@dataclass(frozen=True)
class Codebooks:
    """Coarse centres (centre, number) and, for each part of the numbers, its entries (level, number of the part)."""

    centres: np.ndarray
    parts: list[np.ndarray]
    #: Standard error of the score of a code with a query of length 1.
    error: float = 0.0

    @property
    def cuts(self) -> np.ndarray:
        """Where the parts after the first one start."""
        return np.cumsum([part.shape[1] for part in self.parts])[:-1]

    @classmethod
    def of(cls, sample: np.ndarray, parts: int = PARTS, centres: int = CENTRES, levels: int = LEVELS, seed: int = 1) -> Codebooks:
        draw = np.random.default_rng(seed)
        coarse = clustered(sample, min(centres, 256), draw)
        rest = sample - coarse[nearest(sample, coarse)]
        pieces = np.array_split(rest, min(parts, rest.shape[1]), axis=1)
        entries = [clustered(piece, min(levels, 256), draw) for piece in pieces]
        left = [piece - some[nearest(piece, some)] for piece, some in zip(pieces, entries)]
        return cls(coarse, entries, float(np.sqrt(np.mean(np.concatenate(left, axis=1) ** 2))))

    def encode(self, rows: np.ndarray) -> np.ndarray:
        """One byte for the centre and one for each part."""
        code = np.empty((len(rows), 1 + len(self.parts)), dtype=np.uint8)
        code[:, 0] = nearest(rows, self.centres)
        rest = rows - self.centres[code[:, 0]]
        for place, (piece, entries) in enumerate(zip(np.split(rest, self.cuts, axis=1), self.parts), 1):
            code[:, place] = nearest(piece, entries)
        return code

    def scorer(self, queries: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
        """A function from codes to the products (query, code) of queries with what the codes stand for.

        Up to FEW queries it looks up each byte of a code in a table (level, query). For many one matrix product of the queries with
        what the codes stand for is cheaper than as many look-ups; it is the same sum.
        """
        queries = queries.astype(np.float32)
        centres, parts = self.centres.astype(np.float32), [entries.astype(np.float32) for entries in self.parts]
        if len(queries) > FEW:

            def multiplied(codes: np.ndarray) -> np.ndarray:
                stands = centres.take(codes[:, 0], axis=0)
                stands += np.concatenate([entries.take(column, axis=0) for entries, column in zip(parts, codes.T[1:])], axis=1)
                return queries @ stands.T

            return multiplied
        tables = [centres @ queries.T, *(entries @ piece.T for entries, piece in zip(parts, np.split(queries, self.cuts, axis=1)))]

        def looked_up(codes: np.ndarray) -> np.ndarray:
            total = tables[0].take(codes[:, 0], axis=0)
            for table, column in zip(tables[1:], codes.T[1:]):
                total += table.take(column, axis=0)
            return total.T

        return looked_up


def fit(vectors: DataFrame, ids: tuple[str, ...] = VECTOR_ID, sample: int = SAMPLE, **sizes: int) -> Codebooks | None:
    """Codebooks of a table of vectors, from about `sample` of them; None if there is none."""
    good = vectors.select(*ids, "embedding").filter(finite(F.col("embedding")))
    total = vectors.count()
    if total > sample:
        good = good.filter(F.pmod(F.xxhash64(*ids), F.lit(1 << 40)) < F.lit(int((1 << 40) * (sample / total)))).limit(2 * sample)
    found = good.select("embedding").toArrow().column(0).combine_chunks()
    rows = matrix_of(found.chunk(0) if isinstance(found, pa.ChunkedArray) else found) if len(found) else np.empty((0, 0))
    return Codebooks.of(rows, **sizes) if len(rows) else None


@dataclass(frozen=True)
class Index:
    """`codes` has the ids, file and row of every vector and its code; a file holds rows of `width` numbers of type `kind`."""

    codes: DataFrame
    books: Codebooks | None
    ids: tuple[str, ...]
    kind: str
    width: int

    @property
    def row_bytes(self) -> int:
        return self.width * np.dtype(self.kind).itemsize


def build(vectors: DataFrame, books: Codebooks | None, ids: tuple[str, ...] = VECTOR_ID, folder: str | None = None) -> Index:
    """Encode and store every vector; one scan, no shuffle."""
    spark = vectors.sparkSession
    folder = folder or fresh_path(spark, "vectors")
    kind = "<f8" if vectors.schema["embedding"].dataType.elementType.simpleString() == "double" else "<f4"
    names = list(ids)
    fields = f"{', '.join(f'{name} BIGINT' for name in names)}, file STRING, row BIGINT, code BINARY"

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = pyarrow.fs.FileSystem.from_uri(folder)
        filesystem.create_dir(path, recursive=True)
        name, row = f"{uuid.uuid4().hex}.bin", 0
        with filesystem.open_output_stream(f"{path}/{name}", compression=None) as out:
            for batch in batches:
                for start in range(0, batch.num_rows, SLICE):
                    part, rows = usable(batch.slice(start, SLICE))
                    if not len(rows):
                        continue
                    out.write(rows.astype(kind).tobytes())
                    code = books.encode(rows)
                    packed = pa.Array.from_buffers(pa.binary(code.shape[1]), len(code), [None, pa.py_buffer(code.tobytes())])
                    idents = [part.column(one).cast(pa.int64()) for one in names]
                    places = pa.array(np.arange(row, row + len(rows)))
                    files = pa.array([f"{folder}/{name}"] * len(rows))
                    yield pa.record_batch([*idents, files, places, packed.cast(pa.binary())], names=[*names, "file", "row", "code"])
                    row += len(rows)

    known = vectors.select(*(F.col(name).cast("long").alias(name) for name in names), "embedding")
    codes = known.mapInArrow(job, fields) if books else spark.createDataFrame([], fields)
    return Index(stored(codes, "codes"), books, ids, kind, books.centres.shape[1] if books else 0)


def code_matrix(column: pa.Array, width: int) -> np.ndarray:
    """Codes of one length as a matrix, straight from the batch's bytes."""
    start = column.offset and column.slice(0, 0).offset
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int32)[start : start + len(column) + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]].reshape(len(column), width)


class Shortlist:
    """The candidates of a block's queries that a task holds: numbers only, 32 bytes each and as much again for what is new.

    Candidates are added as they come and cut to the best ones when there are as many new ones as kept ones (or MERGE).
    """

    def __init__(self, queries: int, ids: int, k: int, depth: int, short: np.ndarray):
        self.k, self.depth, self.short = k, depth, short
        self.floor = np.full(queries, -np.inf)
        self.kept = [np.empty(0, np.int32), np.empty(0, np.float32), np.empty(0, np.int32), *(np.empty(0, np.int64) for _ in range(1 + ids))]
        self.fresh: list[list[np.ndarray]] = []
        self.waiting = 0

    def add(self, query: np.ndarray, score: np.ndarray, file: np.ndarray, row: np.ndarray, idents: list[np.ndarray]) -> None:
        self.fresh.append([query.astype(np.int32), score, file, row, *idents])
        self.waiting += len(query)
        if self.waiting >= max(MERGE, len(self.kept[0])) or np.isneginf(self.floor).any():
            self.cut()

    def cut(self) -> None:
        columns = [np.concatenate(some) for some in zip(self.kept, *self.fresh)]
        self.fresh, self.waiting = [], 0
        order = first_k(columns[0], columns[1], columns[4:], self.depth)
        query, score = columns[0][order], columns[1][order].astype(np.float64)
        starts = np.flatnonzero(np.r_[True, query[1:] != query[:-1]])
        full = starts[np.diff(np.r_[starts, len(query)]) >= self.k]
        self.floor[query[full]] = score[full + self.k - 1] - self.short[query[full]]
        order = order[score >= self.floor[query]]
        self.kept = [column[order] for column in columns]


def scan_codes(folder: str, index: Index, k: int, margin: float):
    """Partition function: the partition's candidates for each query of the block, with the score that they may fall short by."""
    books, ids, width = index.books, index.ids, 1 + len(index.books.parts)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, matrix = query_block(folder)
        score = books.scorer(matrix) if len(queries) else None
        short = margin * books.error * np.linalg.norm(matrix, axis=1)
        step, depth = max(64, SCORES // max(1, len(queries))), most(k, len(queries))
        held, files = Shortlist(len(queries), len(ids), k, depth, short), {}
        for batch in batches if len(queries) else ():
            for start in range(0, batch.num_rows, step):
                part = batch.slice(start, step)
                found, floor = score(code_matrix(part.column("code"), width)), held.floor
                if found.shape[1] > k and (fresh := np.isneginf(floor)).any():
                    floor = floor.copy()
                    floor[fresh] = np.partition(found[fresh], -k, axis=1)[:, -k] - short[fresh]
                q, v = np.nonzero(found >= floor.astype(np.float32)[:, None])
                if not len(q):
                    continue
                named = part.column("file").dictionary_encode()
                numbers = np.array([files.setdefault(name, len(files)) for name in named.dictionary.to_pylist()], dtype=np.int32)
                file, row = numbers[named.indices.to_numpy()][v], part.column("row").to_numpy()[v]
                held.add(q, found[q, v], file, row, [part.column(name).to_numpy()[v] for name in ids])
        if held.fresh:
            held.cut()
        names = pa.array(list(files), pa.string())
        for start in range(0, len(held.kept[0]), GIVEN):
            q, s, file, row, *idents = (column[start : start + GIVEN] for column in held.kept)
            columns = [queries[q], *idents, names.take(pa.array(file)), row, s.astype(np.float64), short[q], np.full(len(q), depth)]
            yield pa.record_batch([pa.array(column) for column in columns], names=["query_id", *ids, "file", "row", "score", "short", "depth"])

    return job


def most(k: int, queries: int) -> int:
    """Candidates that a query may have, so that a block's fit into a task."""
    return max(k, DEPTH, CANDIDATES // max(1, queries))


def read_rows(path: str, rows: np.ndarray, kind: str, width: int) -> np.ndarray:
    """The given rows (ascending, each once) of a file of vectors; rows close to each other are read at once."""
    size = width * np.dtype(kind).itemsize
    filesystem, name = pyarrow.fs.FileSystem.from_uri(path)
    out = np.empty((len(rows), width))
    starts = np.flatnonzero(np.r_[True, np.diff(rows) * size > GAP])
    with filesystem.open_input_file(name) as file:
        for first, last in zip(starts, [*starts[1:], len(rows)]):
            low, high = int(rows[first]), int(rows[last - 1]) + 1
            data = np.frombuffer(file.read_at((high - low) * size, low * size), dtype=kind).reshape(-1, width)
            out[first:last] = data[rows[first:last] - low]
    return out


def score_again(folder: str, index: Index):
    """Partition function: the exact scores of candidates, which come sorted by file and row."""
    ids, kind, width = index.ids, index.kind, index.width

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, matrix = query_block(folder)
        order = np.argsort(queries, kind="stable")
        for batch in batches:
            files, where = batch.column("file").to_numpy(zero_copy_only=False), batch.column("row").to_numpy()
            asked = order[np.searchsorted(queries[order], batch.column("query_id").to_numpy())]
            found = np.empty(batch.num_rows)
            for path in np.unique(files):
                mine = np.flatnonzero(files == path)
                rows, back = np.unique(where[mine], return_inverse=True)
                vectors = read_rows(path, rows, kind, width)
                found[mine] = np.round(np.einsum("ij,ij->i", matrix[asked[mine]], vectors[back]), 6)
            yield pa.record_batch([*(batch.column(name) for name in ("query_id", *ids)), pa.array(found)], names=["query_id", *ids, "score"])

    return job


def shortlists(index: Index, queries: DataFrame, k: int, margin: float = MARGIN, block_rows: int | None = None) -> list[tuple[str, DataFrame]]:
    """For each block of queries its folder and its candidates: (query_id, ids, file, row)."""
    _, blocks = stored_queries(queries, 1, block_rows)
    names = list(index.ids)
    fields = f"query_id BIGINT, {', '.join(f'{name} BIGINT' for name in names)}, file STRING, row BIGINT, score DOUBLE, short DOUBLE, depth BIGINT"
    scanned = index.codes.select(*names, "file", "row", "code")
    every = Window.partitionBy("query_id")
    found = []
    for folder in blocks if index.books else ():
        hits = scanned.mapInArrow(scan_codes(folder, index, k, margin), fields)
        hits = hits.withColumn("rank", F.row_number().over(every.orderBy(F.desc("score"), *names))).filter("rank <= depth")
        limit = F.coalesce(F.max(F.when(F.col("rank") == k, F.col("score"))).over(every), F.lit(float("-inf")))
        near = hits.withColumn("limit", limit).filter(F.col("score") >= F.col("limit") - F.col("short"))
        found.append((folder, near.select("query_id", *names, "file", "row")))
    return found


def quantised_top_k(index: Index, queries: DataFrame, k: int = 5, margin: float = MARGIN, block_rows: int | None = None) -> DataFrame:
    """Approximate search: as `search.top_k`, over the candidates that the codes give."""
    names, spark = list(index.ids), index.codes.sparkSession
    fields = f"query_id BIGINT, {', '.join(f'{name} BIGINT' for name in names)}, score DOUBLE"
    scored = []
    for folder, found in shortlists(index, queries, k, margin, block_rows):
        # Rows of one stretch of a file meet in one task, so each is read once a block.
        dealt = found.repartition("file", F.floor(F.col("row") / SLICE)).sortWithinPartitions("file", "row")
        scored.append(dealt.mapInArrow(score_again(folder, index), fields))
    return ranked(reduce(DataFrame.unionByName, scored) if scored else spark.createDataFrame([], fields), names, k)


def bytes_read(index: Index, queries: DataFrame, k: int, margin: float = MARGIN) -> DataFrame:
    """One row: bytes of all vectors, of their codes, of the vectors that re-ranking reads, and the share of the last two."""
    spark = index.codes.sparkSession
    lists = [found.select("file", "row") for _, found in shortlists(index, queries, k, margin)]
    picked = reduce(DataFrame.unionByName, lists).distinct().count() if lists else 0
    total = index.codes.count()
    codes = total * (1 + len(index.books.parts)) if index.books else 0
    row = (total * index.row_bytes, codes, picked * index.row_bytes)
    share = (row[1] + row[2]) / row[0] if row[0] else 0.0
    return spark.createDataFrame([(*row, round(share, 6))], "vector_bytes BIGINT, code_bytes BIGINT, reread_bytes BIGINT, share DOUBLE")
