"""Learned embeddings: the strongest directions of the word-document matrix, by a distributed randomised SVD.

A text is a row of weights over hashed words: (1 + log times) * log((1 + texts) / (1 + texts with the word)) + 1, scaled to length 1. A random
block of directions is multiplied by the matrix and its transpose in ROUNDS passes over the stored rows: each task adds up what its
rows give, the sums of all tasks are added by slices of words, and the driver makes the block orthonormal again (a QR of a
matrix of a fixed size). From the last block and its product follow the singular vectors. What passes through the driver and is broadcast is a
matrix of WORDS x (dims + EXTRA) numbers, 37 MB by default, whatever the number of texts; the rows never leave their tasks.

Cases: words whose hashes meet share a weight; a null text or one without words has the zero vector; equal texts count each; without texts there is
no space (None). The same texts give the same space up to the order of sums.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from lorebase.functions.text import TOKEN_SEPARATOR
from lorebase.session import stored

WORDS, DIMS, EXTRA, ROUNDS = 1 << 16, 64, 8, 3
#: Parts of the matrix of words in which tasks hand on their sums; numbers of the matrix that are gathered at once.
SLICES, NUMBERS = 64, 1 << 22
#: Rows that are multiplied at once, at most, and how many of them hold a word that is multiplied densely: two or more, so that the
#: dense part has at most ROWS numbers for every two entries.
ROWS, SHARED = 256, 2
SEPARATOR = regex.compile(TOKEN_SEPARATOR)
#: Signs of ASCII other than letters and digits as blanks.
BLANKED = bytes(byte if byte >= 128 or chr(byte).isalnum() else 32 for byte in range(256))


def words_of(text: str | None) -> list[bytes]:
    """The lower-case words of a text; those in runs with signs beyond ASCII come last, as what these do is for the separator to say."""
    low = (text or "").lower()
    data = low.encode()
    runs = data.translate(BLANKED).split()
    if len(data) == len(low):
        return runs
    found = [run for run in runs if run.isascii()]
    other = b" ".join([run for run in runs if not run.isascii()]).decode()
    return found + [word.encode() for word in SEPARATOR.split(other) if word]


def counted(text: str | None, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashed words of a text, ascending, and how often each occurs."""
    hashes = np.fromiter(map(zlib.crc32, words_of(text)), dtype=np.int64)
    return np.unique((hashes % words).astype(np.int32), return_counts=True)


def weighted(buckets: np.ndarray, times: np.ndarray, starts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """The weights of flat rows that begin at `starts`, none of them empty, each row scaled to length 1."""
    weights = (1 + np.log(times)) * idf[buckets]
    norms = np.sqrt(np.add.reduceat(weights * weights, starts))
    return weights / np.repeat(norms, np.diff(np.r_[starts, len(weights)]))


def flat_rows(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(buckets, times, starts) of runs of at most ROWS rows with about `size` entries."""
    buckets, times = (batch.column(name) for name in ("buckets", "times"))
    ends = np.cumsum(np.r_[0, buckets.value_lengths().to_numpy()]).astype(np.int64)
    flat_buckets, flat_times = buckets.flatten().to_numpy(), times.flatten().to_numpy()
    first = 0
    while first < len(ends) - 1:
        last = min(first + ROWS, max(first + 1, int(np.searchsorted(ends, ends[first] + size, side="right")) - 1))
        part = slice(ends[first], ends[last])
        yield flat_buckets[part], flat_times[part].astype(np.float64), ends[first:last] - ends[first]
        first = last


@dataclass(frozen=True)
class Split:
    """Some rows of A in two parts: words that several of the rows hold as a dense matrix, the others entry by entry."""

    head: np.ndarray
    dense: np.ndarray
    buckets: np.ndarray
    weights: np.ndarray
    owner: np.ndarray

    @classmethod
    def of(cls, buckets: np.ndarray, weights: np.ndarray, starts: np.ndarray, words: int) -> Split:
        held = np.bincount(buckets, minlength=words)
        owner = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(weights)]))
        head = np.flatnonzero(held >= SHARED)
        place = np.full(words, -1)
        place[head] = np.arange(len(head))
        there = place[buckets]
        shared = there >= 0
        dense = np.zeros((len(starts), len(head)))
        dense[owner[shared], there[shared]] = weights[shared]
        return cls(head, dense, buckets[~shared], weights[~shared], owner[~shared])

    def times(self, block: np.ndarray) -> np.ndarray:
        """The rows multiplied by a block of directions."""
        rows = self.dense @ block[self.head]
        add_runs(rows, self.owner, block[self.buckets] * self.weights[:, None])
        return rows

    def add_back(self, rows: np.ndarray, total: np.ndarray) -> None:
        """Adds the product of the transposed rows with `rows` to `total`."""
        total[self.head] += self.dense.T @ rows
        order = np.argsort(self.buckets, kind="stable")
        add_runs(total, self.buckets[order], rows[self.owner[order]] * self.weights[order][:, None])


def add_runs(total: np.ndarray, places: np.ndarray, parts: np.ndarray) -> None:
    """Adds parts to the rows of `total` at ascending places."""
    if len(places):
        first = np.flatnonzero(np.r_[True, np.diff(places) > 0])
        total[places[first]] += np.add.reduceat(parts, first, axis=0)


def product(buckets: np.ndarray, weights: np.ndarray, starts: np.ndarray, block: np.ndarray, total: np.ndarray) -> None:
    """Adds A' (A block) of some rows of A to `total`."""
    rows = Split.of(buckets, weights, starts, len(block))
    rows.add_back(rows.times(block), total)


def summed(rows: DataFrame, shape: tuple[int, int], step) -> np.ndarray:
    """The sum over all tasks of the matrices that `step(batches)` gives, added by slices of their first axis."""
    slices = min(SLICES, shape[0])

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = step(batches)
        if total is not None:
            for number, part in enumerate(np.array_split(total, slices)):
                yield pa.record_batch([pa.array([number], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, sums in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(sums.as_buffer(), dtype=np.float64)
                totals[number] = totals[number] + part if number in totals else part.copy()
        for number, part in totals.items():
            yield pa.record_batch([pa.array([number], pa.int32()), pa.array([part.tobytes()], pa.binary())], names=["slice", "sums"])

    fields = "slice INT, sums BINARY"
    found = rows.mapInArrow(job, fields).repartition("slice").mapInArrow(add, fields).collect()
    parts = {row.slice: np.frombuffer(row.sums, dtype=np.float64) for row in found}
    sizes = [len(part) for part in np.array_split(np.empty(shape[0]), slices)]
    return np.concatenate([parts.get(n, np.zeros(size * shape[1])).reshape(size, shape[1]) for n, size in enumerate(sizes)])


@dataclass(frozen=True)
class Space:
    """Word weights, the directions (word, dimension) and their singular values."""

    idf: np.ndarray
    basis: np.ndarray
    values: np.ndarray

    def vectors(self, texts: list[str | None]) -> np.ndarray:
        """The vectors of some texts; zero without words."""
        out = np.zeros((len(texts), self.basis.shape[1]))
        for first in range(0, len(texts), ROWS):
            rows = [counted(text, len(self.idf)) for text in texts[first : first + ROWS]]
            filled = np.flatnonzero([len(buckets) for buckets, _ in rows])
            if not len(filled):
                continue
            buckets, times = (np.concatenate([rows[row][side] for row in filled]) for side in (0, 1))
            starts = np.cumsum([0, *(len(rows[row][0]) for row in filled[:-1])])
            weights = weighted(buckets, times.astype(np.float64), starts, self.idf)
            found = Split.of(buckets, weights, starts, len(self.idf)).times(self.basis)
            out[first + filled] = found / np.maximum(np.linalg.norm(found, axis=1, keepdims=True), 1e-12)
        return out


def fit(texts: DataFrame, text: str, dims: int = DIMS, words: int = WORDS, rounds: int = ROUNDS, seed: int = 1) -> Space | None:
    """The space of a table of texts; one pass to count words and `rounds` + 1 over the stored counts."""
    spark = texts.sparkSession

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [row for value in batch.column(0) if len((row := counted(value.as_py(), words))[0])]
            if found:
                buckets, times = zip(*found)
                columns = [pa.array(buckets, pa.list_(pa.int32())), pa.array([t.astype(np.int32) for t in times], pa.list_(pa.int32()))]
                yield pa.record_batch(columns, names=["buckets", "times"])

    rows = stored(texts.select(F.col(text).cast("string")).mapInArrow(split, "buckets ARRAY<INT>, times ARRAY<INT>"), "word-counts")

    def frequencies(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros((words + 1, 1))
        for batch in batches:
            total[:words, 0] += np.bincount(batch.column("buckets").flatten().to_numpy(), minlength=words)
            total[words, 0] += batch.num_rows
        return total

    known = summed(rows, (words + 1, 1), frequencies)[:, 0]
    count, width = int(known[words]), dims + EXTRA
    if not count:
        return None
    idf = np.log((1 + count) / (1 + known[:words])) + 1
    block = np.linalg.qr(np.random.default_rng(seed).normal(size=(words, width)))[0]
    for _ in range(rounds + 1):
        shared = spark.sparkContext.broadcast((idf, block))

        def times_block(batches: Iterator[pa.RecordBatch], shared=shared) -> np.ndarray:
            weights_of, directions = shared.value
            total = np.zeros((words, width))
            for batch in batches:
                for buckets, times, starts in flat_rows(batch, NUMBERS // width):
                    product(buckets, weighted(buckets, times, starts, weights_of), starts, directions, total)
            return total

        image = summed(rows, (words, width), times_block)
        shared.destroy()
        last, block = block, np.linalg.qr(image)[0]
    # With orthonormal directions Q, the largest part of A'A is that of Q' (A'A Q).
    squares, turns = np.linalg.eigh((last.T @ image + image.T @ last) / 2)
    best = np.argsort(-squares)[:dims]
    return Space(idf, last @ turns[:, best], np.sqrt(np.maximum(squares[best], 0)))


def embed(texts: DataFrame, ids: list[str], text: str, space: Space | None, out: str = "embedding") -> DataFrame:
    """(ids, embedding): every text in the space, scaled to length 1; no shuffle. Without a space every vector is zero."""
    space = space or Space(np.ones(1), np.zeros((1, DIMS)), np.zeros(DIMS))
    shared, kinds = texts.sparkSession.sparkContext.broadcast(space), dict(texts.dtypes)

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = shared.value.vectors(batch.column(len(ids)).to_pylist())
            offsets = np.arange(0, vectors.size + 1, vectors.shape[1], dtype=np.int32)
            yield pa.record_batch([*batch.columns[:-1], pa.ListArray.from_arrays(offsets, pa.array(vectors.ravel()))], names=[*ids, out])

    fields = ", ".join([*(f"`{name}` {kinds[name]}" for name in ids), f"`{out}` ARRAY<DOUBLE>"])
    return texts.select(*ids, F.col(text).cast("string")).mapInArrow(job, fields)
