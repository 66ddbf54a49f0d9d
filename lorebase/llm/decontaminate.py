"""Benchmark decontamination: passages of documents within an edit budget of a test item.

Method: texts are compared as lower-case words; in scripts that set no blanks between words every character is one. An item of n words may differ from a passage by k = min(n // 5, n // 4 - 1)
insertions, deletions and replacements of words. It is split into k + 1 pieces of four words or more; by the pigeonhole
principle one of them stands unchanged in any passage within the budget. Exact hits of pieces are found by their leading words
in every window of every document; hits of one item that lie close together make one stretch of the document, which is
searched once with Myers' bit-parallel distance, so a document that repeats a passage costs no more than its length.

The items are a stated query set. Their distinct texts go to the tasks in blocks of about BLOCK_CHARS characters (or a single longer
text), dealt by a hash of the text, one block at a time: each block is one scan of the documents without a shuffle, and its hits are
stored before the next one. The ids of the items join the hits afterwards, so items that share a text cost no more than one. Memory is
bounded for any number of items, and documents that share a passage are spread as the scan spreads them.

Cases: a null text or item text has no words; an item without words is found nowhere; an item of fewer than eight words must
stand there unchanged; repeated items and repeated documents are each reported; null ids are carried along; other columns
are ignored; without documents or items the result is empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lorebase.llm.common import Batches, Written, in_batches, key_type, map_batches, rows_of

# Ranges of characters of scripts without blanks (Thai, Lao, Myanmar, Khmer, kana, Han).
UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
WORD = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
#: Shortest piece in words, and words of an item per edit.
PIECE, PER_EDIT = 4, 5
BLOCK_CHARS = 4 << 20
PRIME, MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
NUMBERS = ("distance", "n_words", "start", "end")


def budget(words: int) -> int:
    return max(0, min(words // PER_EDIT, words // PIECE - 1))


def pieces(words: int) -> list[tuple[int, int]]:
    """(offset, length) of the pieces of an item, as even as can be."""
    count = budget(words) + 1
    cuts = [words * number // count for number in range(count + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


class Pattern:
    """Myers' bit vectors of a word sequence."""

    def __init__(self, words: list[int]):
        self.size = len(words)
        self.masks: dict[int, int] = {}
        for place, word in enumerate(words):
            self.masks[word] = self.masks.get(word, 0) | 1 << place

    def distances(self, text: list[int]) -> Iterator[int]:
        """For each end in `text`, the smallest distance between the pattern and a stretch that ends there."""
        full, top = (1 << self.size) - 1, 1 << (self.size - 1)
        plus, minus, score, masks = full, 0, self.size, self.masks
        for word in text:
            equal = masks.get(word, 0)
            vertical = equal | minus
            diagonal = (((equal & plus) + plus) ^ plus) | equal
            up = minus | ~(diagonal | plus) & full
            down = plus & diagonal
            score += bool(up & top) - bool(down & top)
            up, down = up << 1 & full, down << 1 & full
            plus = down | ~(vertical | up) & full
            minus = up & vertical
            yield score


class Items:
    """A block of items with what finding them takes."""

    def __init__(self, rows: list[tuple[object, str | None]]):
        self.vocabulary: dict[str, int] = {}
        self.ids, self.words, entries = [], [], {}
        for item_id, text in rows:
            words = [self.vocabulary.setdefault(w.lower(), len(self.vocabulary) + 1) for w in WORD.findall(text or "")]
            number = len(self.ids)
            self.ids.append(item_id)
            self.words.append(words)
            for offset, length in pieces(len(words)) if words else ():
                lead = min(PIECE, length)
                entries.setdefault(lead, []).append((self.key(words[offset : offset + lead]), number, offset, length))
        self.tables = {lead: self.table(found) for lead, found in entries.items()}
        self.patterns: dict[int, tuple[Pattern, Pattern]] = {}

    @staticmethod
    def key(words: list[int]) -> int:
        return int(window_keys(np.array(words, dtype=np.uint64), len(words))[0])

    @staticmethod
    def table(found: list[tuple[int, int, int, int]]) -> tuple[np.ndarray, np.ndarray]:
        found.sort()
        keys = np.array([entry[0] for entry in found], dtype=np.uint64)
        return keys, np.array([entry[1:] for entry in found], dtype=np.int64)

    def hits(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """For each item the stretches of a document (first and last word) that may hold it, in order and apart."""
        stretches: dict[int, list[tuple[int, int]]] = {}
        for lead, (keys, entries) in self.tables.items():
            if len(words) < lead:
                continue
            windows = window_keys(words, lead)
            left = np.searchsorted(keys, windows, "left")
            places = np.flatnonzero(keys[np.minimum(left, len(keys) - 1)] == windows)
            for place, first in zip(places.tolist(), left[places].tolist()):
                while first < len(keys) and keys[first] == windows[place]:
                    item, offset, length = entries[first].tolist()
                    own = self.words[item]
                    if words[place : place + length].tolist() == own[offset : offset + length]:
                        edits = budget(len(own))
                        start = place - offset
                        stretches.setdefault(item, []).append((start - edits, start + len(own) + edits))
                    first += 1
        return {item: merged(found, len(words)) for item, found in stretches.items()}

    def matches(self, words: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(item, distance, first word, word after the last) of every passage within the budget.

        Passages of one item don't overlap: from the left, each ends where the distance is smallest within the next
        words that still lie within the budget.
        """
        for item, stretches in self.hits(words).items():
            own = self.words[item]
            if item not in self.patterns:
                self.patterns[item] = Pattern(own), Pattern(own[::-1])
            forward, backward = self.patterns[item]
            edits = budget(len(own))
            for first, last in stretches:
                text = words[first:last].tolist()
                while text:
                    best = None
                    for place, distance in enumerate(forward.distances(text)):
                        if best is not None and (distance > edits or place > best[2] + 2 * edits):
                            break
                        if distance <= edits and (best is None or distance < best[0]):
                            best = distance, place + 1, place if best is None else best[2]
                    if best is None:
                        break
                    distance, end, _ = best
                    back = text[max(0, end - len(own) - edits) : end][::-1]
                    length = next(n for n, d in enumerate(backward.distances(back), 1) if d == distance)
                    yield item, distance, first + end - length, first + end
                    first, text = first + end, text[end:]


def window_keys(words: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of `length` words."""
    keys = np.zeros(len(words) - length + 1, dtype=np.uint64)
    for offset in range(length):
        keys = (keys + words[offset : offset + len(keys)] + np.uint64(1)) * PRIME
        keys = (keys ^ (keys >> np.uint64(29))) * MIX
    return keys


def merged(stretches: list[tuple[int, int]], size: int) -> list[tuple[int, int]]:
    found: list[tuple[int, int]] = []
    for start, end in sorted(stretches):
        if found and start <= found[-1][1]:
            found[-1] = found[-1][0], max(found[-1][1], min(end, size))
        else:
            found.append((max(0, start), min(end, size)))
    return found


def find_step(block, key: pa.DataType):
    schema = pa.schema([("doc_id", key), ("item", pa.string())] + [(name, pa.int64()) for name in NUMBERS])

    def rows(batches: Batches) -> Iterator[tuple]:
        items = Items(block.value)
        known = items.vocabulary.get
        for doc_id, text in rows_of(batches):
            words = [known(word.lower(), 0) for word in WORD.findall(text or "")]
            places = None
            for item, distance, first, last in items.matches(np.array(words, dtype=np.uint64)):
                places = places or [match.span() for match in WORD.finditer(text)]
                size = len(items.words[item])
                yield doc_id, items.ids[item], distance, size, places[first][0], places[last - 1][1]

    return lambda batches: in_batches(rows(batches), schema)


def passages(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, distance, n_words, start, end): where documents hold items; characters, end exclusive.

    `doc_id` holds the key, which may be of any type."""
    spark, texts = docs.sparkSession, docs.select(key, text)
    name, arrow = key_type(docs, key)
    numbers = [f"{number} BIGINT" for number in NUMBERS]
    items = benchmark.select(F.col(item).cast("long").alias("item_id"), F.col(item_text).alias("wanted"))
    # Equal texts are one, however many items have them.
    distinct = Written(items.where("wanted IS NOT NULL").select("wanted").distinct(), "item-texts").df
    chars = distinct.agg(F.sum(F.length("wanted"))).first()[0] or 0
    blocks = -(-chars // block_chars)
    found = []
    for number in range(blocks):
        of_block = distinct.where(F.pmod(F.xxhash64("wanted"), F.lit(blocks)) == number)
        # The hash deals different texts evenly, so a block is of about block_chars characters.
        block = spark.sparkContext.broadcast([tuple(row) for row in of_block.select(F.md5("wanted"), "wanted").orderBy("wanted").collect()])
        step = find_step(block, arrow)
        found.append(Written(map_batches(texts, ", ".join([f"doc_id {name}, item STRING", *numbers]), step), "passages").df)
        block.destroy()
    if not found:
        return spark.createDataFrame([], ", ".join([f"doc_id {name}, item_id BIGINT", *numbers]))
    named = items.select("item_id", F.md5("wanted").alias("item"))
    return reduce(DataFrame.unionByName, found).join(named, "item").select("doc_id", "item_id", *NUMBERS)


def without_passages(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs` without any passage, with all their columns. The verdict follows the text, whatever the key."""
    named = docs.select(F.md5(F.col(text)).alias("digest"), F.col(text).alias("text"))
    found = passages(named, benchmark, "digest", "text", item, item_text).select(F.col("doc_id").alias("contaminated")).distinct()
    # Written, so that the documents of a hot text can be split; a null text holds nothing and is kept out of the join.
    found = Written(found, "contaminated").df
    some = docs.where(F.col(text).isNotNull())
    return some.join(found, F.md5(some[text]) == found["contaminated"], "left_anti").unionByName(docs.where(F.col(text).isNull()))
