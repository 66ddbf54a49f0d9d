"""Contexts under a budget: of a question's hits those that add most, without saying the same twice.

Greedy marginal relevance: in each step the hit with the largest `trade * score - (1 - trade) * likeness` is taken, likeness being its largest
inner product with a hit already taken; equal ones in the order of their rank. A hit that is as like to one taken as `same` is left out
for good, and one that doesn't fit into what is left of the word budget is passed over. A question has at most as many hits as the search
before was asked for, so its hits are one small row, and questions don't meet.

Cases: a hit without a vector or text is left out; a question whose first hits are all too long gets the best that fits; without hits it has
no row; hits that share a rank are ordered by their ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.functions.text import tokens
from lorebase.operators.skew import HOT_ROWS, split_join

TRADE, SAME = 0.7, 0.95


def greedy(scores: np.ndarray, vectors: np.ndarray, sizes: np.ndarray, budget: int, trade: float, same: float) -> list[tuple[int, float]]:
    """(place, gain) of the hits that are taken, in the order in which they are; the hits come in their own order."""
    taken: list[tuple[int, float]] = []
    alike = np.zeros(len(scores))
    fits = np.ones(len(scores), dtype=bool)
    left = budget
    while True:
        fits &= sizes <= left
        if not fits.any():
            return taken
        gain = np.where(fits, np.round(trade * scores - (1 - trade) * alike, 6), -np.inf)
        best = int(np.argmax(gain))
        taken.append((best, float(gain[best])))
        left -= int(sizes[best])
        likeness = np.round(vectors @ vectors[best], 6)
        alike = np.maximum(alike, likeness) if len(taken) > 1 else likeness
        fits[best] = False
        fits &= likeness < same


def words_in(text: Column) -> Column:
    return F.size(tokens(text)).cast("long")


def budgeted(hits: DataFrame, chunks: DataFrame, budget: int = 200, trade: float = TRADE, same: float = SAME, rows: int = HOT_ROWS) -> DataFrame:
    """(query_id, place, doc_id, chunk_no, gain, words): the chunks of each question's context, in the order of `place` from 0.

    `hits` has query_id, rank, score, doc_id and chunk_no; `chunks` doc_id, chunk_no, chunk and embedding.
    """
    known = chunks.filter("chunk IS NOT NULL AND embedding IS NOT NULL").select("doc_id", "chunk_no", "embedding", words_in(F.col("chunk")).alias("words"))
    # Many questions may hit the same chunk.
    met = split_join(hits, known, ["doc_id", "chunk_no"], rows=rows)
    one = F.struct("rank", "doc_id", F.col("chunk_no").cast("long").alias("chunk_no"), "score", "words", "embedding")
    held = met.groupBy("query_id").agg(F.array_sort(F.collect_list(one)).alias("hits"))

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for query, some in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                scores, sizes = (np.array([hit[name] for hit in some]) for name in ("score", "words"))
                vectors = np.array([hit["embedding"] for hit in some], dtype=np.float64)
                for place, (number, gain) in enumerate(greedy(scores, vectors, sizes, budget, trade, same)):
                    hit = some[number]
                    found.append((query, place, hit["doc_id"], hit["chunk_no"], gain, hit["words"]))
            if found:
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64())
                columns = [pa.array(column, kind) for column, kind in zip(zip(*found), kinds)]
                yield pa.record_batch(columns, names=["query_id", "place", "doc_id", "chunk_no", "gain", "words"])

    return held.select(F.col("query_id").cast("long"), "hits").mapInArrow(
        job, "query_id BIGINT, place INT, doc_id BIGINT, chunk_no BIGINT, gain DOUBLE, words BIGINT"
    )
