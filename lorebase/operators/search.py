"""Vector search: exact and by cells, many queries at once.

The vectors are scanned where they lie; each task keeps the best k per query and emits only those. Queries are written to
the shared folder in blocks whose size is fixed, and a task reads the one block that it works on; more queries mean more
blocks and more scans. So no query passes through the driver, nothing is broadcast, and a task holds one block at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from lorebase.functions.vectors import BITS, DIM, sign_cell, sign_plane, unit
from lorebase.operators.skew import HOT_ROWS, split_join
from lorebase.session import fresh_path, stored

QUERY_BYTES = 16 << 20
SCORES = 4 << 20
#: From this on numbers are multiplied in double precision.
LARGE = 1e12
#: Pairs whose exact scores are worked out at once.
PAIRS = 1 << 16
VECTOR_ID = ("vec_id",)


def finite(vector: Column) -> Column:
    """Whether a vector is there and none of its numbers is null, NaN or infinite."""
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))


def unusable(vectors: DataFrame) -> DataFrame:
    """Vectors that no search looks at, because they are null or hold a number that is not finite."""
    return vectors.filter(~finite(F.col("embedding")))


def first_k(query: np.ndarray, score: np.ndarray, idents: list[np.ndarray], k: int) -> np.ndarray:
    """Index of the k best rows of every query, best first, equal scores by id."""
    order = np.lexsort((*idents[::-1], -score, query))
    sorted_query = query[order]
    starts = np.flatnonzero(np.r_[True, sorted_query[1:] != sorted_query[:-1]])
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.r_[starts, len(order)]))
    return order[rank < k]


@dataclass(frozen=True)
class Asked:
    """Queries as given, in single precision (large numbers in double), and their lengths."""

    matrix: np.ndarray
    quick: np.ndarray
    lengths: np.ndarray

    @classmethod
    def of(cls, matrix: np.ndarray) -> Asked:
        quick = matrix.astype(np.float32) if np.abs(matrix).max(initial=0) < LARGE else matrix
        return cls(matrix, quick, np.linalg.norm(matrix, axis=1))

    def take(self, rows: np.ndarray) -> Asked:
        return self if len(rows) == len(self.matrix) else Asked(self.matrix[rows], self.quick[rows], self.lengths[rows])

    def scores(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The products with all vectors, in single precision where no number is large, and a bound of each query's error."""
        kind = self.quick.dtype if np.abs(vectors).max(initial=0) < LARGE else np.dtype(np.float64)
        longest = np.sqrt((vectors * vectors).sum(axis=1).max(initial=0))
        error = (vectors.shape[1] + 4) * float(np.finfo(kind).eps) * longest * self.lengths
        return (self.quick if kind == self.quick.dtype else self.matrix) @ vectors.astype(kind).T, error


def candidates(queries: Asked, vectors: np.ndarray, floor: np.ndarray, k: int):
    """(query, vector, score) of a slice that may still be among the best k.

    A query that has k hits takes only scores from its lowest on; one that has not takes the best k of the slice and
    what equals them. All pairs are scored in single precision, whose error is bounded by the vectors' lengths; only the few
    scores near the limit are worked out in double precision and rounded.
    """
    scores, error = queries.scores(vectors)
    open_rows = np.flatnonzero(np.isneginf(floor))
    if len(open_rows) and scores.shape[1] > k:
        floor = floor.copy()
        kth = np.partition(scores[open_rows], -k, axis=1)[:, -k]
        floor[open_rows] = np.round(kth.astype(np.float64) - error[open_rows], 6)
    # The limit is rounded down, so that it stays a lower one.
    limit = np.nextafter((floor - error - 1e-6).astype(scores.dtype), scores.dtype.type(-np.inf))
    query, vector = np.nonzero(scores >= limit[:, None])
    score = np.empty(len(query))
    for start in range(0, len(query), PAIRS):
        part = slice(start, start + PAIRS)
        score[part] = np.round(np.einsum("ij,ij->i", queries.matrix[query[part]], vectors[vector[part]]), 6)
    taken = score >= floor[query]
    return query[taken], vector[taken], score[taken]


def matrix_of(vectors: pa.Array) -> np.ndarray:
    """Vectors of one length as a matrix, straight from the flat numbers of the batch."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    if not len(lengths):
        return np.empty((0, 0))
    if (lengths != lengths[0]).any():
        raise ValueError("vectors of different lengths")
    numbers = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return numbers.reshape(len(lengths), -1)


def usable(batch: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
    """The rows with a vector of finite numbers, and these vectors."""
    batch = batch.filter(pc.is_valid(batch.column("embedding")))
    vectors = matrix_of(batch.column("embedding"))
    good = np.isfinite(vectors).all(axis=1)
    return (batch, vectors) if good.all() else (batch.filter(pa.array(good)), vectors[good])


def query_block(folder: str) -> tuple[np.ndarray, np.ndarray]:
    """One block of the stored queries: (ids, matrix)."""
    filesystem, name = pyarrow.fs.FileSystem.from_uri(folder)
    table = ds.dataset(name, filesystem=filesystem, format="parquet").to_table(["query_id", "embedding"]).combine_chunks()
    if not table.num_rows:
        return np.empty(0, dtype=np.int64), np.empty((0, 0))
    rows, matrix = usable(table.to_batches()[0])
    return rows.column("query_id").to_numpy(), matrix


def _scan(folder: str, ids: list[str], k: int, probe: Callable[[np.ndarray], np.ndarray] | None):
    """Partition function: best k of the partition's vectors for each query of the block."""

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, matrix = query_block(folder)
        probes = None if probe is None else probe(matrix)
        every, block = np.arange(len(queries)), Asked.of(matrix)
        best_q, best_s, best_i = np.empty(0, dtype=np.int64), np.empty(0), [np.empty(0, dtype=np.int64) for _ in ids]
        floor = np.full(len(queries), -np.inf)
        step = max(16, SCORES // max(1, len(queries)))
        for batch in batches if len(queries) else ():
            for start in range(0, batch.num_rows, step):
                part, vectors = usable(batch.slice(start, step))
                if not len(vectors):
                    continue
                idents = [part.column(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in ids]
                found_q, found_s, found_i = [best_q], [best_s], [[one] for one in best_i]
                owner = np.zeros(len(vectors), dtype=int) if probes is None else part.column("cell").to_numpy()
                for cell in np.unique(owner):
                    asking = every if probes is None else np.flatnonzero(probes[:, cell])
                    if not len(asking):
                        continue
                    members = owner == cell
                    q, v, s = candidates(block.take(asking), vectors[members], floor[asking], k)
                    found_q.append(asking[q])
                    found_s.append(s)
                    for held, one in zip(found_i, idents):
                        held.append(one[members][v])
                q, s, i = np.concatenate(found_q), np.concatenate(found_s), [np.concatenate(held) for held in found_i]
                if len(q) == len(best_q):
                    continue
                kept = first_k(q, s, i, k)
                best_q, best_s, best_i = q[kept], s[kept], [one[kept] for one in i]
                # The hits are in order of query and rank: where there are k, the last one sets the limit.
                ends = np.flatnonzero(np.r_[best_q[1:] != best_q[:-1], True])
                ends = ends[np.diff(np.r_[-1, ends]) == k]
                floor[best_q[ends]] = best_s[ends]
        if len(best_q):
            yield pa.record_batch([queries[best_q], *best_i, best_s], names=["query_id", *ids, "score"])

    return job


def stored_queries(queries: DataFrame, cells: int, block_rows: int | None) -> tuple[DataFrame, list[str]]:
    """The queries, worked out and written once, and the folders of their blocks of about QUERY_BYTES."""
    spark, path = queries.sparkSession, fresh_path(queries.sparkSession, "queries")
    queries.select(F.col("query_id").cast("long"), "embedding").write.parquet(path)
    kept = spark.read.parquet(path).filter(finite(F.col("embedding")))
    total, dim = kept.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("embedding")), F.lit(1))).first()
    n = -(-total // (block_rows or max(1, QUERY_BYTES // max(8 * dim, cells))))
    if n < 2:
        return kept, [path] * n
    blocks = fresh_path(spark, "query-blocks")
    dealt = kept.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n)))
    dealt.repartition("block").write.partitionBy("block").parquet(blocks)
    # With few queries to a block one may be empty, and have no folder.
    used = spark.read.parquet(blocks).select("block").distinct().collect()
    return kept, [f"{blocks}/block={number}" for number in sorted(row.block for row in used)]


def ranked(hits: DataFrame, ids: list[str], k: int) -> DataFrame:
    """The k best hits of each query, equal scores by id, with their rank."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), *ids)
    return (
        hits.withColumn("rank", F.row_number().over(best))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", *ids, "score")
    )


def _probed(queries: DataFrame, probe: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """The cells that any query looks into: at most as many numbers as there are cells."""

    def cells_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                looked = np.flatnonzero(probe(matrix_of(batch.column("embedding"))).any(axis=0))
                yield pa.record_batch([looked.astype(np.int32)], names=["cell"])

    return sorted(row.cell for row in queries.select("embedding").mapInArrow(cells_of, "cell INT").distinct().collect())


def _search(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    block_rows: int | None,
    ids: tuple[str, ...] = VECTOR_ID,
    cells: int = 0,
    probe: Callable[[np.ndarray], np.ndarray] | None = None,
) -> DataFrame:
    """Best k per query. `probe` maps a block's matrix to a table (query, cell) of what each query looks into."""
    names = list(ids)
    asked, blocks = stored_queries(queries, cells, block_rows)
    # Tasks leave out unusable vectors: a filter here would be worked out before the vectors, and so make them twice.
    scanned = vectors.select(*names, "embedding") if probe is None else vectors.select(*names, "embedding", "cell")
    if probe is not None and blocks:
        # Only the cells some query probes are read; on a stored index this prunes folders.
        looked = _probed(asked, probe)
        scanned = scanned.filter(F.col("cell").isin(looked)) if len(looked) < cells else scanned
    if len(blocks) > 1:
        # Each block is a scan: vectors that are worked out are worked out once.
        scanned = stored(scanned, "vectors")
    fields = f"query_id BIGINT, {', '.join(f'{name} BIGINT' for name in names)}, score DOUBLE"
    found = [scanned.mapInArrow(_scan(folder, names, k, probe), fields) for folder in blocks]
    if not found:
        return ranked(vectors.sparkSession.createDataFrame([], fields), names, k)
    return ranked(reduce(DataFrame.unionByName, found), names, k)


def top_k(
    vectors: DataFrame, queries: DataFrame, k: int = 5, block_rows: int | None = None, ids: tuple[str, ...] = VECTOR_ID
) -> DataFrame:
    """Exact search: (query_id, rank, ids, score), the k vectors of highest inner product per query.

    `vectors` has the whole numbers `ids`, which together occur once, and embedding, `queries` query_id (once each) and
    embedding. Scores are rounded to 6 digits, equal scores are ordered by the ids. Vectors and queries that are null or
    not finite are left out (`unusable` lists them).
    """
    return _search(vectors, queries, k, block_rows, ids)


def with_cells(vectors: DataFrame, bits: int = BITS) -> DataFrame:
    """Each vector with the sign cell it lies in."""
    return vectors.withColumn("cell", sign_cell(F.col("embedding"), bits))


def ann_top_k(
    index: DataFrame, queries: DataFrame, k: int = 5, within: int = 2, bits: int = BITS, block_rows: int | None = None
) -> DataFrame:
    """Approximate search: as `top_k`, over the sign cells that differ from the query's own in at most `within` bits.

    `index` has vec_id, embedding and cell.
    """

    def probe(matrix: np.ndarray) -> np.ndarray:
        planes = np.array([sign_plane(bit, matrix.shape[1]) for bit in range(bits)], dtype=np.float64)
        own = ((matrix @ planes.T >= 0) << np.arange(bits)).sum(axis=1)
        return np.bitwise_count(own[:, None] ^ np.arange(1 << bits)[None, :]) <= within

    return _search(index, queries, k, block_rows, VECTOR_ID, 1 << bits, probe)


def fit_centroids(vectors: DataFrame, cells: int = 64, seed: int = 1, rounds: int = 10) -> np.ndarray:
    """Centres of `cells` clusters of the vectors, scaled to length 1."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    dense = F.transform("embedding", lambda x: x.cast("double"))
    model = KMeans(k=cells, seed=seed, maxIter=rounds, featuresCol="_v").fit(vectors.select(array_to_vector(dense).alias("_v")))
    centres = np.array(model.clusterCenters())
    return centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-12)


def with_centroid_cells(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Each vector with the cell of its nearest centroid; of equally near ones the first."""
    near = vectors.sparkSession.sparkContext.broadcast(centroids)

    @F.pandas_udf("int")
    def nearest(batch: pd.Series) -> pd.Series:
        vectors = matrix_of(pa.array(batch))
        return pd.Series(np.argmax(vectors @ near.value.T, axis=1).astype(np.int32))

    return vectors.withColumn("cell", nearest("embedding"))


def centroid_top_k(
    index: DataFrame, queries: DataFrame, centroids: np.ndarray, k: int = 5, probes: int = 8, block_rows: int | None = None
) -> DataFrame:
    """Approximate search: as `top_k`, over the cells of the `probes` centroids nearest to each query."""

    def probe(matrix: np.ndarray) -> np.ndarray:
        scores = matrix @ centroids.T
        looked = np.zeros(scores.shape, dtype=bool)
        np.put_along_axis(looked, np.argsort(-scores, axis=1, kind="stable")[:, :probes], True, axis=1)
        return looked

    return _search(index, queries, k, block_rows, VECTOR_ID, len(centroids), probe)


def write_index(index: DataFrame, path: str) -> None:
    """Store vectors with their cell in one folder per cell. Full cells are written as several files, sparse ones as one."""
    index.hint("rebalance", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """A stored index; a filter on `cell` reads only the folders of those cells."""
    return spark.read.parquet(path)


def recall(exact: DataFrame, approximate: DataFrame) -> DataFrame:
    """One row: exact hits, how many of them the approximate search found, and their share."""
    hits = approximate.select("query_id", "vec_id", F.lit(1).alias("_hit"))
    return exact.join(hits, ["query_id", "vec_id"], "left").agg(
        F.count(F.lit(1)).alias("expected"),
        F.count("_hit").alias("found"),
        F.round(F.try_divide(F.count("_hit"), F.count(F.lit(1))), 6).alias("recall"),
    )


def label_queries(vectors: DataFrame, dim: int = DIM) -> DataFrame:
    """One query per label: the mean of its vectors scaled to length 1 (query_id, embedding)."""
    means = (
        vectors.select("label", F.posexplode("embedding").alias("_i", "_x"))
        .groupBy("label", "_i")
        .agg(F.avg(F.col("_x").cast("double")).alias("_x"))
        .groupBy("label")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda p: p["_x"]).alias("_mean"))
    )
    return means.select(F.col("label").cast("long").alias("query_id"), unit(F.col("_mean"), dim).alias("embedding"))


def assemble_context(
    hits: DataFrame, chunks: DataFrame, facts: DataFrame, separator: str = "\n---\n", rows: int = HOT_ROWS
) -> DataFrame:
    """Context and default answer per question: (query_id, context, answer).

    `hits` has query_id, rank and the chunk keys doc_id and chunk_no, at most k per question; `chunks` doc_id,
    chunk_no and chunk; `facts` query_id and fact, one row per question. The context lists the chunks by rank and
    then the fact; the answer is the chunk of rank 1.
    """
    # Many questions may hit the same chunk.
    picked = split_join(hits, chunks, ["doc_id", "chunk_no"], rows=rows)
    told = picked.groupBy("query_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "chunk"))), lambda p: p["chunk"]), separator
        ).alias("_told"),
        F.min_by("chunk", "rank").alias("answer"),
    )
    return told.join(facts, "query_id", "left").select(
        "query_id", F.concat_ws(separator, "_told", "fact").alias("context"), "answer"
    )


def generate(contexts: DataFrame, model) -> DataFrame:
    """Answers by a caller's model, a function from a pandas Series of contexts to a Series of texts."""
    return contexts.withColumn("answer", F.pandas_udf(model, "string")(F.col("context")))
