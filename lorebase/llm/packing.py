"""Packing documents into sequences of a fixed capacity, without padding: harmonic classes, filled by each task for itself.

Method: the ids of a document, with its end id, are cut into whole sequences of CAPACITY ids as long as they fill one; what is left,
r ids, belongs to the class k = CAPACITY // r of lengths in (CAPACITY / (k + 1), CAPACITY / k]. A bin of class k takes the
fixed number of k rests, which always fit, and less than CAPACITY / (k + 1) ids stay free. As each further rest of the class is longer
than that, the next one is cut: its head fills the bin to the last id and its tail goes to the class of its own length,
which is k or a higher one. So every bin holds exactly CAPACITY ids. A class keeps less than a bin's worth of rests, whatever
the number of documents, and classes don't wait for each other. At the end of a task the rests of all classes are joined, cut into
whole sequences, and what is left into sequences of the powers of two in its length. A sequence is padded to the capacity unless
its length is a power of two, so none is padded if the capacity is a power of two.

Tasks work on the rows of their own scan: no shuffle, no state shared between workers, nothing kept but the rests of at most
2 * sqrt(CAPACITY) classes. The sequences of a task are numbered from its place among the partitions times 2^40, so the
numbers are unique, and a task that runs again on the same rows gives the same pieces.

Cases: a null text counts as empty and an empty text is the end id alone; rows with equal or null keys are packed one by one; equal
texts are packed like others; a very long text is many whole sequences, given out a few at a time; other columns are ignored; an empty
table gives an empty table.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, functions as F

from lorebase.llm.common import BATCH_ROWS, Batches, map_batches, runs_of
from lorebase.llm.token_files import SharedEncoder, with_end

CAPACITY = 1024
#: Bytes of text that are encoded at once.
ENCODE_BYTES = 16 << 20
#: Sequences that a task can number.
TASK_SEQUENCES = 1 << 40

#: A stretch of a document: (key, ids before it, its ids, all ids of the document).
Rest = tuple[int | None, int, np.ndarray, int]


class HarmonicPacker:
    """Packs the stretches that it is given; yields pieces (key, start, length, doc_tokens, sequence, offset, ids)."""

    def __init__(self, capacity: int, first: int):
        self.capacity, self.sequence = capacity, first
        self.classes: dict[int, deque[Rest]] = {}
        self.held: dict[int, int] = {}

    def emit(self, parts: list[Rest]) -> Iterator[tuple]:
        """One sequence of these stretches."""
        offset = 0
        for key, start, ids, total in parts:
            yield key, start, len(ids), total, self.sequence, offset, ids
            offset += len(ids)
        self.sequence += 1

    def add(self, key: int | None, ids: np.ndarray) -> Iterator[tuple]:
        """A document: its whole sequences, and the bins that its rest fills."""
        whole = len(ids) // self.capacity * self.capacity
        for start in range(0, whole, self.capacity):
            yield from self.emit([(key, start, ids[start : start + self.capacity], len(ids))])
        if whole < len(ids):
            # A copy, so that a rest doesn't keep the ids of a whole batch.
            yield from self.put((key, whole, ids[whole:].copy(), len(ids)))

    def put(self, rest: Rest) -> Iterator[tuple]:
        """A rest into its class; when that has a bin's worth, the bin, and the tail of the rest that was cut for it."""
        while rest is not None:
            k = self.capacity // len(rest[2])
            waiting = self.classes.setdefault(k, deque())
            waiting.append(rest)
            self.held[k] = self.held.get(k, 0) + len(rest[2])
            rest = None
            if self.held[k] >= self.capacity:
                # The first k rests fit; the one after them, if the bin isn't full yet, is longer than what is free.
                parts = [waiting.popleft() for _ in range(min(k, len(waiting)))]
                self.held[k] -= sum(len(part[2]) for part in parts)
                free = self.capacity - sum(len(part[2]) for part in parts)
                if free:
                    key, start, ids, total = waiting.popleft()
                    self.held[k] -= len(ids)
                    parts.append((key, start, ids[:free], total))
                    rest = (key, start + free, ids[free:], total)
                yield from self.emit(parts)

    def close(self) -> Iterator[tuple]:
        """What is left in all classes, as whole sequences and then as powers of two."""
        left = deque(rest for k in sorted(self.classes) for rest in self.classes[k])
        total = sum(len(rest[2]) for rest in left)
        sizes = [self.capacity] * (total // self.capacity)
        sizes += [1 << bit for bit in reversed(range(self.capacity.bit_length())) if total % self.capacity >> bit & 1]
        for size in sizes:
            parts = []
            while size:
                key, start, ids, length = left.popleft()
                if len(ids) > size:
                    left.appendleft((key, start + size, ids[size:], length))
                    ids = ids[:size]
                parts.append((key, start, ids, length))
                size -= len(ids)
            yield from self.emit(parts)
        self.classes, self.held = {}, {}


PIECES = (
    "doc_id BIGINT, start BIGINT, length BIGINT, doc_tokens BIGINT, sequence_id BIGINT, offset BIGINT, ids ARRAY<INT>"
)
PIECE_SCHEMA = pa.schema(
    [(name, pa.int64()) for name in ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset")]
    + [("ids", pa.list_(pa.int32()))]
)


def pack_step(shared: Broadcast, end_id: int, capacity: int):
    def step(batches: Batches) -> Batches:
        encoder = shared.value.get()
        packer = HarmonicPacker(capacity, TaskContext.get().partitionId() * TASK_SEQUENCES)
        for batch in batches:
            keys, texts = batch.columns
            for start, count in runs_of(texts, ENCODE_BYTES):
                ids, ends = with_end(*encoder.encode_flat(texts.slice(start, count)), end_id)
                yield from records(packed(packer, keys.slice(start, count).to_pylist(), ids, ends.tolist()))
        yield from records(packer.close())

    return step


def packed(packer: HarmonicPacker, keys: list, ids: np.ndarray, ends: list[int]) -> Iterator[tuple]:
    before = 0
    for key, end in zip(keys, ends):
        yield from packer.add(key, ids[before:end])
        before = end


def records(pieces: Iterator[tuple]) -> Batches:
    """Pieces as record batches, with their ids in one flat array."""
    while some := list(islice(pieces, BATCH_ROWS)):
        *columns, ids = zip(*some)
        offsets = np.cumsum([0, *columns[2]], dtype=np.int32)
        lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(ids).astype(np.int32)))
        yield pa.record_batch([*(pa.array(column, pa.int64()) for column in columns), lists], schema=PIECE_SCHEMA)


def pack(
    df: DataFrame,
    path: str,
    end_id: int = 0,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    schema: str = PIECES,
    steps: tuple = (),
) -> DataFrame:
    """One row per piece: (doc_id, start, length, doc_tokens, sequence_id, offset, ids).

    `start`: the document's ids before the piece; `offset`: the sequence's. `steps` may turn the batches into others with
    `schema` in the same task, so that the ids don't leave it.
    """
    with open(path, encoding="utf-8") as file:
        definition = file.read()
    model = json.loads(definition)
    largest = max([end_id, *model["model"]["vocab"].values(), *(t["id"] for t in model.get("added_tokens", []))])
    encoder = df.sparkSession.sparkContext.broadcast(SharedEncoder(definition, 2 if largest < 1 << 16 else 4))
    named = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return map_batches(named, schema, pack_step(encoder, end_id, capacity), *steps)
