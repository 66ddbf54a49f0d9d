"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, and how often their ids do in the corpus.

Method: lockstep merging. All documents of a batch lie one after the other in flat arrays of token ends (in bytes of a space and the
text), once for tokenizer A and once for B. One state vector holds a pointer into A and one into B for every document; in each step
every document emits the link of its two tokens, emits a cut where both end, and moves the pointer of the token that ends first, or
both. Finished documents are compacted away. A long document enters the vector as several strips, cut where tokens of A and B end
together, so the number of steps follows STRIP and not the longest document. The cuts order the tokens into groups.

Each document's distinct id pairs, with their number of links, are written once. The number of documents that hold a pair is added up in
each task and then over all; the counts are ordered by pair and written in files of at most about TABLE_ROWS rows. Tasks read
them from the shared folder: a table of up to HELD_ROWS rows is held by a worker, a larger one passes by file for file over
blocks of documents. Nothing is broadcast but the tokenizers and the list of files.

Encoding: as in `token_files`, words that are new to a worker go to the tokenizers' own libraries and are remembered as stretches of a
flat array. A word after a lone space is encoded by itself: for sentencepiece if no piece has a space but in front.

Cases: null and empty texts, and texts whose joined tokens differ from the text (such as ones with U+2581), have no tokens: zeros, no
groups; rows with equal or null keys are documents of their own; special tokens' strings are plain text; other columns are ignored; an
empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.parquet
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from lorebase.llm.common import Batches, Written, map_batches, runs_of
from lorebase.llm.files import open_input
from lorebase.llm.pieces import SPACE, PieceModel
from lorebase.llm.token_files import BYTE_LETTERS, TextEncoder, words_of

#: Bytes of text that are aligned at once, and tokens of A after which a long document gets another strip.
BATCH_BYTES, STRIP = 2 << 20, 256
#: Tokens that are tried for the cut of a strip.
TRIES = 32
#: Rows of a file of counts; rows of counts that a worker holds (about 300 MB); distinct pairs after which a task hands its counts on.
TABLE_ROWS, HELD_ROWS, TASK_PAIRS = 1 << 22, 1 << 24, 1 << 21
#: Pairs of documents that are looked up at once.
LOOK_UP = 1 << 22


class PieceEncoder(TextEncoder):
    """Ids of a sentencepiece model that puts a space before a text; only for texts after that space (`spaced`)."""

    def __init__(self, model: bytes, size: int, by_words: bool):
        from sentencepiece import SentencePieceProcessor

        self.library = SentencePieceProcessor(model_proto=model)
        self.kind, self.by_words, self.sharing = "<u2" if size < 1 << 16 else "<u4", by_words, 2
        self.forget()

    def stored(self, texts: list[str]) -> range:
        lists = self.library.encode(texts, num_threads=1)
        sizes = np.fromiter(map(len, lists), dtype=np.int32, count=len(lists))
        return self.store(np.fromiter(chain.from_iterable(lists), dtype=self.kind, count=int(sizes.sum())), sizes)

    def whole(self, texts: list[str]) -> range:
        return self.stored([text[1:] for text in texts])

    def learn(self, words: list[str]) -> None:
        plain = [word for word in words if word and SPACE not in word]
        self.spaced.update(dict.fromkeys(words, -1))
        self.spaced.update(zip(plain, self.stored(plain)))


class Surfaces:
    """The bytes of every id."""

    def __init__(self, pieces: list[bytes]):
        self.sizes = np.array(list(map(len, pieces)), dtype=np.int32)
        self.starts = (np.cumsum(self.sizes) - self.sizes).astype(np.int32)
        self.bytes = np.frombuffer(b"".join(pieces), dtype=np.uint8)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.arange(total) + np.repeat(self.starts[ids] - ends + sizes, sizes)]


class Tokenizers:
    """What the driver broadcasts: both tokenizers; a worker makes its encoders once and keeps them for later tasks."""

    def __init__(self, byte_path: str, piece_path: str):
        with open(byte_path, encoding="utf-8") as file:
            definition = json.load(file)
        vocab = definition["model"]["vocab"]
        letters = {letter: byte for byte, letter in BYTE_LETTERS.items()}
        by_id = [b""] * (max(vocab.values()) + 1)
        for piece, number in vocab.items():
            by_id[number] = bytes(map(letters.__getitem__, piece)) if letters.keys() >= set(piece) else piece.encode()
        # Without added tokens their strings are plain text.
        self.definition = json.dumps(definition | {"added_tokens": []})
        pieces = PieceModel(piece_path)
        if pieces.prefix != SPACE:
            raise ValueError(f"{piece_path}: puts no space before a text")
        with open(piece_path, "rb") as file:
            self.model = file.read()
        self.piece_words, self.sizes = bool(pieces.words), (len(by_id), pieces.size)
        self.surfaces = Surfaces(by_id), Surfaces(pieces.surfaces)
        self.made = None

    def encoders(self) -> tuple[TextEncoder, PieceEncoder]:
        if self.made is None:
            by_bytes = TextEncoder(self.definition, 2 if self.sizes[0] < 1 << 16 else 4, sharing=2)
            self.made = by_bytes, PieceEncoder(self.model, self.sizes[1], self.piece_words)
        return self.made

    def __getstate__(self) -> dict:
        return self.__dict__ | {"made": None}


def strips(ends_a: np.ndarray, ends_b: np.ndarray, stops_a: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first token of A, first token of B, token of A to stop at) of every strip of the documents, which all have tokens."""
    starts_a = np.r_[0, stops_a][:-1]
    extra = np.maximum(0, (stops_a - starts_a - 1) // STRIP)
    number = np.arange(extra.sum()) - np.repeat(np.cumsum(extra) - extra, extra)
    tries, limit = np.repeat(starts_a, extra) + (number + 1) * STRIP, np.repeat(stops_a, extra)
    found_a, found_b = [starts_a], [starts_b]
    for _ in range(TRIES):
        # The token before a strip ends where one of B does.
        at = np.searchsorted(ends_b, ends_a[tries - 1])
        cut = ends_b[at] == ends_a[tries - 1]
        found_a.append(tries[cut])
        found_b.append(at[cut] + 1)
        tries, limit = tries[~cut] + 1, limit[~cut]
        tries, limit = tries[tries < limit], limit[tries < limit]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    # Two tries may have found the same cut.
    a, order = np.unique(a, return_index=True)
    return a, b[order], np.r_[a[1:], len(ends_a)][: len(a)]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, stops_a: np.ndarray, starts_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """(A of every link, B of every link, A of every cut, B of every cut) as places in the flat arrays, in the order of the steps.

    `ends_*`: byte ends of all tokens, ascending over the whole batch; `stops_a`, `starts_b`: of each document.
    """
    a, b, stop = strips(ends_a, ends_b, stops_a, starts_b)
    links_a, links_b, cuts_a, cuts_b = [], [], [], []
    while len(a):
        end_a, end_b = ends_a[a], ends_b[b]
        links_a.append(a)
        links_b.append(b)
        cut = end_a == end_b
        cuts_a.append(a[cut])
        cuts_b.append(b[cut])
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    none = np.empty(0, dtype=np.int64)
    return tuple(np.concatenate(parts) if parts else none for parts in (links_a, links_b, cuts_a, cuts_b))


def digits(most: int) -> np.ndarray:
    """The decimal digits of 0 to `most` as bytes, zeros before them, and room for a sign after them."""
    width = len(str(most))
    numbers = np.arange(most + 1)
    powers = 10 ** np.arange(width - 1, -1, -1)
    table = np.zeros((most + 1, width + 1), dtype=np.uint8)
    table[:, :width] = numbers[:, None] // powers % 10 + ord("0")
    table[:, :width][(numbers[:, None] < powers) & (powers > 1)] = 0
    return table


def group_texts(ids: tuple, cuts: tuple, stops: tuple, table: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """`a1,a2|b1;a3|b2,b3` of all documents one after the other, a sign after each, and where each ends."""
    total = len(ids[0]) + len(ids[1])
    ends = [np.sort(cut) + 1 for cut in cuts]
    sizes = [np.diff(end, prepend=0) for end in ends]
    # The tokens of a group: those of A after all of B before the group, those of B after all of A up to its end.
    places = [
        np.arange(len(ids[0])) + np.repeat(np.r_[0, ends[1]][:-1], sizes[0]),
        np.arange(len(ids[1])) + np.repeat(ends[0], sizes[1]),
    ]
    merged, signs = np.empty(total, dtype=np.int32), np.full(total, ord(","), dtype=np.uint8)
    for side, sign in ((0, "|"), (1, ";")):
        merged[places[side]] = ids[side]
        signs[places[side][ends[side] - 1]] = ord(sign)
    text = table[merged]
    text[:, -1] = signs
    written = text != 0
    lengths = np.cumsum(written.sum(axis=1, dtype=np.int64))
    last = stops[0] + stops[1] - 1
    return memoryview(text[written]), lengths[last] if total else np.empty(0, dtype=np.int64)


COUNTS = ("n_a", "n_b", "n_groups", "n_links")


class Aligner:
    """Aligns batches of texts."""

    def __init__(self, tokenizers: Tokenizers, digest: bool):
        self.tokenizers, self.digest = tokenizers, digest
        self.table = digits(max(tokenizers.sizes))

    def encoded(self, texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
        """Ids of both tokenizers, their number in each text, and which texts have tokens; the others' are left out."""
        words = words_of(texts)
        filled = bytes_of(texts)
        wanted = np.frombuffer(b"".join(b" " + text for text in filled), dtype=np.uint8)
        sizes = np.fromiter(map(len, filled), dtype=np.int64, count=len(filled)) + 1
        stops = np.cumsum(sizes)
        fine, ids, counts = sizes > 1, [], []
        for encoder, surfaces in zip(self.tokenizers.encoders(), self.tokenizers.surfaces):
            flat, ends = encoder.encode_flat(texts, True, words)
            number = np.diff(ends, prepend=0)
            of_text = np.repeat(np.arange(len(ends)), number)
            long = np.bincount(of_text, surfaces.sizes[flat], len(ends)).astype(np.int64)
            fine &= long == sizes
            ids.append(flat)
            counts.append(number)
        for side, surfaces in enumerate(self.tokenizers.surfaces):
            flat = ids[side][np.repeat(fine, counts[side])]
            text = wanted[np.repeat(fine, sizes)]
            same = surfaces.joined(flat) == text
            if not same.all():
                firsts = np.r_[0, np.cumsum(sizes[fine])][:-1]
                fine[np.flatnonzero(fine)[~np.logical_and.reduceat(same, firsts)]] = False
        ids = [flat[np.repeat(fine, number)] for flat, number in zip(ids, counts)]
        return ids, [np.where(fine, number, 0) for number in counts], fine

    def batch(self, texts: pa.Array) -> list[pa.Array]:
        """The columns n_a, n_b, n_groups, n_links, groups, pairs and times of texts."""
        ids, counts, fine = self.encoded(texts)
        stops = [np.cumsum(number[fine]) for number in counts]
        ends = [np.cumsum(surface.sizes[one], dtype=np.int64) for one, surface in zip(ids, self.tokenizers.surfaces)]
        links_a, links_b, *cuts = lockstep(*ends, stops[0], np.r_[0, stops[1]][:-1])
        docs, size_b = np.repeat(np.flatnonzero(fine), counts[0][fine]), self.tokenizers.sizes[1]
        n_groups, n_links = (np.bincount(docs[some], minlength=len(texts)) for some in (cuts[0], links_a))
        written, text_ends = group_texts(tuple(ids), tuple(cuts), tuple(stops), self.table)
        groups, before = [""] * len(texts), 0
        for number, end in zip(np.flatnonzero(fine).tolist(), text_ends.tolist()):
            text = written[before : end - 1]
            groups[number] = hashlib.sha256(text).hexdigest() if self.digest else str(text, "ascii")
            before = end
        # Distinct pairs of each document, and their links.
        space = self.tokenizers.sizes[0] * size_b
        keys = docs[links_a] * space + ids[0][links_a].astype(np.int64) * size_b + ids[1][links_b]
        keys.sort()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, dtype=np.int64)
        times = np.diff(np.r_[first, len(keys)])
        keys = keys[first]
        offsets = np.searchsorted(keys, np.arange(len(texts) + 1) * space).astype(np.int32)
        kind = pa.int32() if space < 1 << 31 else pa.int64()
        lists = [pa.ListArray.from_arrays(offsets, pa.array(values, type=sort)) for values, sort in ((keys % space, kind), (times, pa.int32()))]
        return [*(pa.array(column.astype(np.int64)) for column in (*counts, n_groups, n_links)), pa.array(groups, pa.string()), *lists]


def bytes_of(texts: pa.Array) -> list[bytes]:
    return [text or b"" for text in texts.cast(pa.binary()).to_pylist()]


def align_step(shared: Broadcast, digest: bool):
    def step(batches: Batches) -> Batches:
        aligner = Aligner(shared.value, digest)
        for batch in batches:
            keys, texts = batch.columns
            for start, count in runs_of(texts, BATCH_BYTES):
                columns = [keys.slice(start, count), *aligner.batch(texts.slice(start, count))]
                yield pa.record_batch(columns, names=["doc_id", *COUNTS, "groups", "pairs", "times"])

    return step


def aligned(
    df: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text", digest: bool = False
) -> tuple[DataFrame, int]:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every document, and how many ids B has.

    `groups` is `a1,a2|b1;a3|b2,b3` or, with `digest`, its SHA-256 (empty without tokens); `pairs` are the distinct linked id pairs, as
    id of A times the ids of B plus id of B, and `times` their links.
    """
    tokenizers = Tokenizers(byte_path, piece_path)
    named = df.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = "INT" if tokenizers.sizes[0] * tokenizers.sizes[1] < 1 << 31 else "BIGINT"
    fields = ", ".join(f"{name} BIGINT" for name in ("doc_id", *COUNTS)) + f", groups STRING, pairs ARRAY<{kind}>, times ARRAY<INT>"
    step = align_step(df.sparkSession.sparkContext.broadcast(tokenizers), digest)
    return map_batches(named, fields, step), tokenizers.sizes[1]


def counted(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs and the sums of their times."""
    order = np.argsort(pairs, kind="stable")
    pairs, times = pairs[order], times[order]
    first = np.flatnonzero(np.r_[True, pairs[1:] != pairs[:-1]])
    return pairs[first], np.add.reduceat(times, first)


def count_step(batches: Batches) -> Batches:
    """(pair, docs): in how many of the task's documents each pair is; handed on when there are many."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def handed_on() -> Iterator[pa.RecordBatch]:
        pairs, docs = counted(*map(np.concatenate, zip(*held)))
        yield pa.record_batch([pa.array(pairs, pa.int64()), pa.array(docs, pa.int64())], names=["pair", "docs"])

    for batch in batches:
        pairs = batch.column(0).flatten().to_numpy()
        if len(pairs):
            distinct, docs = np.unique(pairs, return_counts=True)
            held.append((distinct.astype(np.int64), docs.astype(np.int64)))
            size += len(distinct)
        if size > 2 * TASK_PAIRS:
            held = [counted(*map(np.concatenate, zip(*held)))]
            size = len(held[0][0])
            if size > TASK_PAIRS:
                yield from handed_on()
                held, size = [], 0
    if held:
        yield from handed_on()


def pair_counts(links: DataFrame, size_b: int) -> DataFrame:
    """(pair, docs, best): documents that hold a pair, and whether no other pair of its id of A is in more."""
    counts = links.select("pairs").mapInArrow(count_step, "pair BIGINT, docs BIGINT").groupBy("pair").agg(F.sum("docs").alias("docs"))
    # An id of A has at most as many pairs as B has ids.
    most = F.max("docs").over(Window.partitionBy(F.floor(F.col("pair") / size_b)))
    return counts.select("pair", "docs", (F.col("docs") == most).alias("best"))


class CountTable:
    """The files of counts; a worker that may hold them all reads them once."""

    def __init__(self, paths: list[str], rows: int):
        self.paths, self.held = paths, [] if rows <= HELD_ROWS else None

    def __getstate__(self) -> dict:
        return {"paths": self.paths, "held": None if self.held is None else []}

    def read(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for path in self.paths:
            with open_input(path) as file:
                table = pyarrow.parquet.read_table(file)
            if table.num_rows:
                yield tuple(table.column(name).to_numpy() for name in ("pair", "docs", "best"))

    def blocks(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(pair, docs, best), pairs ascending in each."""
        if self.held is None:
            yield from self.read()
        else:
            if not self.held and self.paths:
                columns = [np.concatenate(parts) for parts in zip(*self.read())]
                if columns:
                    order = np.argsort(columns[0], kind="stable")
                    self.held.append(tuple(column[order] for column in columns))
            yield from self.held


def score_step(table: Broadcast):
    """Adds n_best and count_sum to (…, pairs, times) and takes these away."""

    def scores(pairs: np.ndarray, times: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        best, total = np.zeros(len(pairs), dtype=np.int64), np.zeros(len(pairs), dtype=np.int64)
        for known, docs, is_best in table.value.blocks():
            at = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
            here = known[at] == pairs
            best[here] = is_best[at[here]] * times[here]
            total[here] = docs[at[here]] * times[here]
        sums = (np.r_[0, np.cumsum(values)][ends] for values in (best, total))
        return [pa.array(np.diff(values)) for values in sums]

    def step(batches: Batches) -> Batches:
        for batch in batches:
            ends = batch.column("pairs").offsets.to_numpy()
            start = 0
            while start < batch.num_rows:
                stop = max(start + 1, int(np.searchsorted(ends, ends[start] + LOOK_UP, side="right")) - 1)
                part = batch.slice(start, stop - start)
                pairs, times = (part.column(name).flatten().to_numpy().astype(np.int64) for name in ("pairs", "times"))
                added = scores(pairs, times, ends[start : stop + 1] - ends[start])
                yield pa.record_batch([*part.columns[:-2], *added], names=[*part.schema.names[:-2], "n_best", "count_sum"])
                start = stop

    return step


def scored(links: DataFrame, size_b: int) -> DataFrame:
    """`links` of `aligned`, as they are stored, with n_best and count_sum instead of their pairs.

    n_best: links whose pair is the most widespread one of its id of A; count_sum: the documents of its pair, over all links.
    """
    spark = links.sparkSession
    counts = Written(pair_counts(links, size_b), "pair-counts").df
    rows = counts.count()
    ordered = counts.repartitionByRange(max(1, -(-rows // TABLE_ROWS)), "pair").sortWithinPartitions("pair")
    table = CountTable(sorted(Written(ordered, "pair-table").df.inputFiles()) if rows else [], rows)
    names = [name for name in links.columns if name not in ("pairs", "times")]
    kinds = dict(links.dtypes)
    fields = ", ".join([*(f"`{name}` {kinds[name]}" for name in names), "n_best BIGINT", "count_sum BIGINT"])
    return links.select(*names, "pairs", "times").mapInArrow(score_step(spark.sparkContext.broadcast(table)), fields)


def alignment(df: DataFrame, byte_path: str, piece_path: str, key: str = "doc_id", text: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, n_best, count_sum) of every document."""
    links, size_b = aligned(df, byte_path, piece_path, key, text, digest)
    return scored(Written(links, "links").df, size_b)
