"""Chunks by global segmentation: the cheapest way to cut a whole text, not a decision at each border for itself.

A text is cut between sentences. A cut costs the likeness of the `window` sentences before it to those after it (the cosine of their word
sets), and a chunk costs how far its length is from `size`: penalty * (1 - characters / size) ** 2. The cuts with the least total cost are
found by dynamic programming over the sentences, each looking back over at most `most` of them; of equally cheap ways the one whose last
chunk is longest is taken, from the end. Memory is linear in the text.

Cases: a null or empty text has no chunk; a sentence longer than `size` is a chunk at its price; the chunks of a text put together are that
text; rows that share an id are cut one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type

from lorebase.functions.text import TOKEN_SEPARATOR

SENTENCE = re.compile(r"[^.!?\n]*[.!?\n]+|[^.!?\n]+")
SEPARATOR = regex.compile(TOKEN_SEPARATOR)
WINDOW, MOST = 3, 64


def gap_scores(sentences: list[str], window: int = WINDOW) -> np.ndarray:
    """The likeness of what stands around the cut before each sentence; 0 for the first one."""
    words = [{word for word in SEPARATOR.split(sentence.lower()) if word} for sentence in sentences]
    scores = np.zeros(len(sentences))
    for place in range(1, len(sentences)):
        before = set().union(*words[max(0, place - window) : place])
        after = set().union(*words[place : place + window])
        if before and after:
            scores[place] = len(before & after) / (len(before) * len(after)) ** 0.5
    return scores


def best_cuts(lengths: np.ndarray, gaps: np.ndarray, size: int, penalty: float, most: int = MOST) -> list[int]:
    """The first sentence of each chunk of the cheapest segmentation."""
    count = len(lengths)
    ends = np.r_[0, np.cumsum(lengths)]
    cost, back = np.zeros(count + 1), np.zeros(count + 1, dtype=np.int64)
    for end in range(1, count + 1):
        low = max(0, end - most)
        starts = np.arange(low, end)
        # The cut before the first sentence of the text is free.
        total = cost[low:end] + gaps[low:end] + penalty * (1 - (ends[end] - ends[starts]) / size) ** 2
        best = int(np.argmin(total))
        cost[end], back[end] = total[best], low + best
    cuts, at = [], count
    while at > 0:
        at = int(back[at])
        cuts.append(at)
    return cuts[::-1]


def segments(text: str, size: int = 500, penalty: float = 0.5, window: int = WINDOW, most: int = MOST) -> list[str]:
    """The chunks of one text."""
    sentences = SENTENCE.findall(text)
    if not sentences:
        return []
    cuts = best_cuts(np.array(list(map(len, sentences))), gap_scores(sentences, window), size, penalty, most)
    return ["".join(sentences[start:end]) for start, end in zip(cuts, [*cuts[1:], len(sentences)])]


def global_chunks(df: DataFrame, text: str, size: int = 500, penalty: float = 0.5, window: int = WINDOW, most: int = MOST) -> DataFrame:
    """One row per chunk: the columns of `df` but the text, chunk_no and chunk. No shuffle; a task holds one text at a time."""
    others = [name for name in df.columns if name != text]
    kinds = dict(df.dtypes)
    schema = pa.schema([*((name, to_arrow_type(df.schema[name].dataType)) for name in others), ("chunk_no", pa.int32()), ("chunk", pa.string())])

    def job(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                found = segments(batch.column(len(others))[row].as_py() or "", size, penalty, window, most)
                if found:
                    rows = pa.array([row] * len(found))
                    columns = [batch.column(place).take(rows).cast(schema.field(place).type) for place in range(len(others))]
                    yield pa.record_batch([*columns, pa.array(range(len(found)), pa.int32()), pa.array(found, pa.string())], schema=schema)

    fields = ", ".join([*(f"`{name}` {kinds[name]}" for name in others), "chunk_no INT, chunk STRING"])
    return df.select(*others, df[text].cast("string")).mapInArrow(job, fields)
