"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network with calibrated probabilities.

Method: a token (a word or a run of signs) falls into one of BUCKETS buckets by its hash and has a shape. Bucket and shape each have a
random index vector, +1 in one place and -1 in another. The vector of a bucket is the sum of the index vectors of all
tokens that stand within REACH places of its tokens, anywhere in the corpus, scaled to length 1. A document is pooled to the mean and the
spread of its tokens' vectors, the mean of their index vectors, and the mean agreement (inner product) of a token's index vector
with those of the tokens 1 to LAGS places before it. A network with one hidden layer gives the logit, and a
temperature, fitted on labelled rows kept out of the network's training, makes it a probability.

The vectors are sums of whole numbers over every document: each task adds up its own tokens in a table of fixed size, Spark adds the
tables up, and at most BUCKETS rows of DIMENSIONS numbers reach the driver and go back as a broadcast. The network is fitted
on at most MAX_LABELLED labelled rows, the first by a hash of their id; only their pooled numbers reach the driver.

Inputs of the score are the tokens of the text alone. Cases: a null text counts as empty; a text without tokens pools to zeros
and is scored like any other; without labels of both kinds every score is the share of label 1, or 0.5 without labels; repeated
rows and null ids are scored one by one; null labels are left out; other columns are ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import Batches, in_batches, map_batches, rows_of
from lorebase.llm.training import labelled_ids, labelled_texts, minimise, sigmoid

TOKEN = re.compile(r"\w+|[^\w\s]+")
BUCKETS, DIMENSIONS, REACH = 1 << 13, 32, 2
SHAPES = 64
MAX_LABELLED = 10_000
HIDDEN = 24
#: One labelled row in so many is kept out of training, for the temperature.
CALIBRATE_EVERY = 5
MEMO_TOKENS = 1 << 17
#: Tokens that are pooled or counted at once, and characters that are split into tokens at once.
STRETCH, PART_CHARS = 1 << 17, 1 << 20
BLANK = re.compile(r"\s")
LAGS = 4
POOLED = 3 * DIMENSIONS + LAGS


def shape_of(token: str) -> int:
    """Case, digits or signs, and length up to 8."""
    if token[0].isalnum() or token[0] == "_":
        kind = 0 if token.islower() else 1 if token.istitle() else 2 if token.isupper() else 3 if token.isdigit() else 4
    else:
        kind = 5
    return 8 * kind + min(len(token), 8) - 1


class TokenCodes(dict):
    """Bucket and shape of tokens as one number, remembered as far as MEMO_TOKENS allows."""

    def __missing__(self, token: str) -> int:
        if len(self) >= MEMO_TOKENS:
            self.clear()
        value = self[token] = zlib.crc32(token.encode()) % BUCKETS * SHAPES + shape_of(token)
        return value


def codes_of(text: str | None, codes: TokenCodes) -> np.ndarray:
    """A long text is split part by part; parts end at white space, which no token holds."""
    text, start, found = text or "", 0, []
    while start < len(text) or not found:
        cut = BLANK.search(text, start + PART_CHARS)
        end = cut.start() if cut else len(text)
        tokens = TOKEN.findall(text, start, end)
        found.append(np.fromiter(map(codes.__getitem__, tokens), dtype=np.int64, count=len(tokens)))
        start = end
    return np.concatenate(found)


def index_places(count: int, salt: int) -> np.ndarray:
    """(plus, minus) for each of `count` things: two different places drawn by a hash."""
    numbers = np.arange(count, dtype=np.uint64) + np.uint64(salt << 32)
    drawn = numbers * np.uint64(0x9E3779B97F4A7C15)
    drawn = (drawn ^ (drawn >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    plus = ((drawn >> np.uint64(40)) % np.uint64(DIMENSIONS)).astype(np.int64)
    step = ((drawn >> np.uint64(8)) % np.uint64(DIMENSIONS - 1)).astype(np.int64)
    return np.stack([plus, (plus + 1 + step) % DIMENSIONS])


WORD_PLACES, SHAPE_PLACES = index_places(BUCKETS, 1), index_places(SHAPES, 2)


def context_sums(codes: np.ndarray, document: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the neighbours' index vectors for each bucket, as one flat table.

    Two tokens are neighbours within a document; `starts` says for which tokens the neighbours after them count here.
    """
    table = np.zeros(BUCKETS * DIMENSIONS, dtype=np.int64)
    rows, words, shapes = codes // SHAPES * DIMENSIONS, codes // SHAPES, codes % SHAPES
    for distance in range(1, min(REACH, len(codes) - 1) + 1):
        near = (document[distance:] == document[:-distance]) & starts[:-distance]
        before, after = np.flatnonzero(near), np.flatnonzero(near) + distance
        for mine, other in ((before, after), (after, before)):
            for sign, word_place, shape_place in zip((1, -1), WORD_PLACES, SHAPE_PLACES):
                table += sign * np.bincount(rows[mine] + word_place[words[other]], minlength=len(table))
                table += sign * np.bincount(rows[mine] + shape_place[shapes[other]], minlength=len(table))
    return table


SUMS = [f"c{place}" for place in range(DIMENSIONS)]


def count_step(batches: Batches) -> Batches:
    """Sums over all documents of a task, one row per bucket that occurs."""
    codes, table = TokenCodes(), np.zeros(BUCKETS * DIMENSIONS, dtype=np.int64)
    held, size = [], 0

    def counted() -> np.ndarray:
        lengths = [len(part) for part, _ in held]
        starts = np.concatenate([np.arange(len(part)) < own for part, own in held])
        return context_sums(np.concatenate([part for part, _ in held]), np.repeat(np.arange(len(held)), lengths), starts)

    for (text,) in rows_of(batches):
        found = codes_of(text, codes)
        for start in range(0, len(found), STRETCH):
            # A stretch of a long text sees REACH tokens of the next one.
            part = found[start : start + STRETCH + REACH]
            held.append((part, min(STRETCH, len(part))))
            size += len(part)
            if size >= STRETCH:
                table += counted()
                held, size = [], 0
    if held:
        table += counted()
    sums = table.reshape(BUCKETS, DIMENSIONS)
    used = np.flatnonzero(sums.any(axis=1))
    columns = [pa.array(used.astype(np.int32))] + [pa.array(sums[used, place]) for place in range(DIMENSIONS)]
    yield pa.record_batch(columns, names=["bucket", *SUMS])


def word_vectors(docs: DataFrame, text: str = "text") -> np.ndarray:
    """The vectors of all buckets, from every document."""
    sums = map_batches(docs.select(text), f"bucket INT, {', '.join(f'{name} BIGINT' for name in SUMS)}", count_step)
    total = sums.groupBy("bucket").agg(*(F.sum(name).alias(name) for name in SUMS)).toPandas()
    table = np.zeros((BUCKETS, DIMENSIONS), dtype=np.float32)
    if len(total):
        vectors = total[SUMS].to_numpy(dtype=np.float64)
        length = np.maximum(np.sqrt((vectors**2).sum(axis=1, keepdims=True)), 1e-9)
        table[total["bucket"].to_numpy()] = vectors / length
    return table


def pooled(codes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean and spread of the tokens' vectors, mean and agreements of their index vectors; zeros without tokens."""
    if not len(codes):
        return np.zeros(POOLED)
    total, squares, index = np.zeros(DIMENSIONS), np.zeros(DIMENSIONS), np.zeros(DIMENSIONS)
    for start in range(0, len(codes), STRETCH):
        part = codes[start : start + STRETCH]
        found = vectors[part // SHAPES]
        total += found.sum(axis=0, dtype=np.float64)
        squares += np.einsum("ij,ij->j", found, found, dtype=np.float64)
        for sign, word_place, shape_place in zip((1, -1), WORD_PLACES, SHAPE_PLACES):
            index += sign * np.bincount(word_place[part // SHAPES], minlength=DIMENSIONS)
            index += sign * np.bincount(shape_place[part % SHAPES], minlength=DIMENSIONS)
    mean = total / len(codes)
    spread = np.sqrt(np.maximum(squares / len(codes) - mean**2, 0))
    plus, minus = WORD_PLACES[:, codes // SHAPES]
    agreements = np.zeros(LAGS)
    for lag in range(1, min(LAGS, len(codes) - 1) + 1):
        same = (plus[lag:] == plus[:-lag]).mean() + (minus[lag:] == minus[:-lag]).mean()
        agreements[lag - 1] = same - (plus[lag:] == minus[:-lag]).mean() - (minus[lag:] == plus[:-lag]).mean()
    return np.concatenate([mean, spread, index / len(codes), agreements])


class Network:
    """Scaled inputs, a hidden layer of tanh, a logit, and a temperature."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, point: np.ndarray, temperature: float):
        self.mean, self.scale, self.point, self.temperature = mean, scale, point, temperature

    @staticmethod
    def layers(point: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        first = POOLED * HIDDEN
        return point[:first].reshape(POOLED, HIDDEN), point[first : first + HIDDEN], point[first + HIDDEN : -1], point[-1]

    def logits(self, rows: np.ndarray) -> np.ndarray:
        weights, bias, out, last = self.layers(self.point)
        return np.tanh((rows - self.mean) / self.scale @ weights + bias) @ out + last

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return sigmoid(self.logits(rows) / self.temperature)


class Constant:
    """The score where there is nothing to learn from."""

    def __init__(self, share: float):
        self.share = share

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return np.full(len(rows), self.share)


def temperature_of(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature, among steps of 5 %, under which the labels are likeliest."""
    grid = np.exp(np.arange(-20, 41) * 0.05)
    signed = np.where(labels > 0, -logits, logits)
    return float(grid[np.argmin([np.logaddexp(0, signed / t).mean() for t in grid])])


def fit(rows: np.ndarray, labels: np.ndarray, ridge: float = 1e-3, steps: int = 300) -> Network | Constant:
    """The network of pooled rows and labels 0 or 1; `rows` in an order that has nothing to do with the labels."""
    if not len(labels) or labels.min() == labels.max():
        return Constant(float(labels.mean()) if len(labels) else 0.5)
    aside = np.arange(len(labels)) % CALIBRATE_EVERY == 0
    if len(np.unique(labels[~aside])) < 2:
        aside[:] = False
    mean, scale = rows[~aside].mean(axis=0), rows[~aside].std(axis=0) + 1e-3
    inputs, wanted = (rows[~aside] - mean) / scale, labels[~aside].astype(np.float64)

    def slope(point: np.ndarray) -> np.ndarray:
        weights, bias, out, last = Network.layers(point)
        hidden = np.tanh(inputs @ weights + bias)
        error = (sigmoid(hidden @ out + last) - wanted) / len(wanted)
        back = error[:, None] * out * (1 - hidden**2)
        return np.concatenate([(inputs.T @ back + ridge * weights).ravel(), back.sum(axis=0), hidden.T @ error + ridge * out, [error.sum()]])

    draw = np.random.default_rng(1)
    start = np.concatenate([draw.normal(0, POOLED**-0.5, POOLED * HIDDEN), np.zeros(HIDDEN), draw.normal(0, HIDDEN**-0.5, HIDDEN), [0.0]])
    network = Network(mean, scale, minimise(slope, start, steps, 0.03), 1.0)
    if len(np.unique(labels[aside])) == 2:
        network.temperature = temperature_of(network.logits(rows[aside]), labels[aside])
    return network


def pool_step(vectors: Broadcast):
    schema = pa.schema([("labelled", pa.int64()), ("label", pa.int32()), ("pooled", pa.list_(pa.float64()))])

    def rows(batches: Batches) -> Iterator[tuple]:
        codes = TokenCodes()
        for labelled, label, text in rows_of(batches):
            yield labelled, label, pooled(codes_of(text, codes), vectors.value)

    return lambda batches: in_batches(rows(batches), schema)


def trained(
    docs: DataFrame,
    labels: DataFrame,
    vectors: Broadcast,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    among: Column | None = None,
) -> Network | Constant:
    """The network fitted on at most MAX_LABELLED labelled rows; `among` limits the ids (column `labelled`) to learn from."""
    sample = labelled_texts(docs, labelled_ids(labels, key, label, MAX_LABELLED, among), key, text)
    found = map_batches(sample, "labelled BIGINT, label INT, pooled ARRAY<DOUBLE>", pool_step(vectors))
    # Rows that share an id: one of them.
    rows = found.groupBy("labelled").agg(F.min(F.struct("label", "pooled")).alias("one"))
    rows = rows.orderBy(F.xxhash64("labelled"), "labelled").collect()
    pools = np.array([r.one.pooled for r in rows]).reshape(len(rows), POOLED)
    return fit(pools, np.array([r.one.label > 0 for r in rows], dtype=np.int64))


def scored(
    docs: DataFrame, vectors: Broadcast, network: Network | Constant, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def rows(batches: Batches) -> Iterator[tuple]:
        codes = TokenCodes()
        for doc_id, value in rows_of(batches):
            row = pooled(codes_of(value, codes), vectors.value)
            yield doc_id, float(shared.value.scores(row[None, :])[0])

    texts = docs.select(F.col(key).cast("long"), F.col(text))
    return map_batches(texts, "doc_id BIGINT, score DOUBLE", lambda batches: in_batches(rows(batches), schema))
