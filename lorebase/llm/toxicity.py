"""Toxicity: cumulative-link ordinal regression on sparse text features.

Method: the features of a text are its distinct lower-case words and their beginnings, hashed; a feature's value is the number of
distinct words that have it. One weight vector gives a text its position s;
ordered thresholds t_1 < t_2 < … cut the line into grades: P(grade >= j) = sigmoid(s - t_j), with the same weights for
all thresholds. The expected severity is the sum of these probabilities, from 0 to the largest grade. A text is toxic from
REJECT on.

Grades: where labels only say toxic or not, a toxic text's grade, 1 to 3, follows from how many of the words that stand out in
toxic texts it holds. The model is fitted by the driver on at most MAX_LABELLED labelled documents, the first by a hash of
their id; of these, near copies (the same three smallest feature hashes) count once. Weights are kept as whole millionths, so a
sum doesn't depend on the order of the words.

Cases: a null text counts as empty and has no features; without labels of both kinds every severity is 0 and nothing is
toxic; repeated rows and null ids are scored one by one; null labels are left out; an empty table gives an empty table.
`scored` gives the id and the results, other columns are ignored; `kept` returns all columns.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lorebase.llm.common import Batches, by_runs, in_batches, map_batches, rows_of
from lorebase.llm.training import labelled_ids, labelled_texts, minimise, sigmoid

WORD = re.compile(r"\w+")
FEATURES = 1 << 20
#: Lengths of the word beginnings that are features beside the whole word.
BEGINNINGS = (4, 5, 6, 7)
MAX_LABELLED = 10_000
#: A feature is used if it occurs in so many texts; the most telling ones are kept.
LEAST_TEXTS, MAX_FEATURES = 3, 2048
#: Numbers of telling words from which the second and third grade of a toxic text start.
GRADE_STEPS = (3, 6)
#: How much more often a telling word occurs in toxic texts, at least.
LIFT = 8.0
REJECT = 0.5
MEMO_WORDS = 1 << 17


def features_of(word: str) -> list[int]:
    """The hashes of a word and of its beginnings."""
    parts = [word, *(f"^{word[:size]}" for size in BEGINNINGS if len(word) >= size)]
    return [zlib.crc32(part.encode()) % FEATURES for part in parts]


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall((text or "").lower()))


def feature_list(text: str | None) -> np.ndarray:
    return np.sort(np.array([f for word in words_of(text) for f in features_of(word)], dtype=np.int32))


class OrdinalModel:
    """Shared weights and ordered thresholds."""

    def __init__(self, features: np.ndarray, weights: np.ndarray, thresholds: np.ndarray):
        self.thresholds = thresholds
        self.millionths = dict(zip(features.tolist(), np.round(weights * 1e6).astype(np.int64).tolist()))

    def grades(self, position: float) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, …"""
        return sigmoid(position - self.thresholds)


class WordWeights(dict):
    """The weight of words, remembered as far as MEMO_WORDS allows."""

    def __init__(self, model: OrdinalModel):
        self.model = model

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        weight = self.model.millionths.get
        value = self[word] = sum(weight(feature, 0) for feature in features_of(word))
        return value


def severity(model: OrdinalModel, weights: WordWeights, text: str | None) -> tuple[float, int]:
    """(expected severity, most likely grade)."""
    above = model.grades(sum(map(weights.__getitem__, words_of(text))) / 1e6)
    shares = np.r_[1.0, above] - np.r_[above, 0.0]
    return float(above.sum()), int(shares.argmax())


def matrix(rows: list[np.ndarray], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of every feature among the chosen ones, ascending; a feature of several words stands there as often."""
    flat = np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    column = np.minimum(np.searchsorted(features, flat), max(0, len(features) - 1))
    known = features[column] == flat if len(features) else np.zeros(len(flat), dtype=bool)
    return row[known], column[known]


def distinct_rows(rows: list[np.ndarray], labels: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """One of each group of near copies: those with the same label and the same three smallest mixed features."""
    seen, chosen = set(), []
    for number, row in enumerate(rows):
        smallest = np.sort((np.unique(row).astype(np.int64) * 0x9E3779B1 + 12345) % 0x7FFFFFFF)[:3]
        name = (int(labels[number]), *smallest.tolist())
        if name not in seen:
            seen.add(name)
            chosen.append(number)
    return [rows[n] for n in chosen], labels[chosen]


def telling(rows: list[np.ndarray], toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most telling features, ascending, and for each whether it stands out in toxic texts."""
    rows = [np.unique(row) for row in rows]
    flat = np.concatenate(rows)
    of_toxic = np.repeat(toxic, [len(r) for r in rows])
    features, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    inside = np.bincount(place, weights=of_toxic, minlength=len(features))
    n_toxic, n_clean = toxic.sum(), (~toxic).sum()
    lift = ((inside + 0.5) / (n_toxic + 1)) / ((count - inside + 0.5) / (n_clean + 1))
    often = count >= LEAST_TEXTS
    features, lift, count = features[often], lift[often], count[often]
    order = np.lexsort((features, -np.abs(np.log(lift)) * np.sqrt(count)))[:MAX_FEATURES]
    order = order[np.argsort(features[order])]
    return features[order], (lift[order] >= LIFT)


def fit(rows: list[np.ndarray], labels: np.ndarray, ridge: float = 2e-3, steps: int = 400) -> OrdinalModel | None:
    """The model of feature lists and labels (0: clean; 1: toxic, or grades above); None without both kinds."""
    rows, labels = distinct_rows(rows, labels)
    toxic = labels > 0
    if not toxic.any() or toxic.all():
        return None
    features, stands_out = telling(rows, toxic)
    row, column = matrix(rows, features)
    grades = labels.astype(np.int64)
    if grades.max() == 1:
        words = np.bincount(row, weights=stands_out[column], minlength=len(rows))
        grades = np.where(toxic, 1 + sum((words >= step).astype(np.int64) for step in GRADE_STEPS), 0)
    # Grades that nobody has would leave a threshold without data.
    grades = np.unique(grades, return_inverse=True)[1]
    top, size = int(grades.max()), len(features)
    above = grades[:, None] >= np.arange(1, top + 1)[None, :]

    def thresholds(point: np.ndarray) -> np.ndarray:
        return np.cumsum(np.r_[point[size], np.exp(point[size + 1 :])])

    def slope(point: np.ndarray) -> np.ndarray:
        cuts = thresholds(point)
        position = np.bincount(row, weights=point[:size][column], minlength=len(rows))
        high = np.c_[np.ones(len(rows)), sigmoid(position[:, None] - cuts), np.zeros(len(rows))]
        share = high[np.arange(len(rows)), grades] - high[np.arange(len(rows)), grades + 1]
        change = high * (1 - high)
        upper, lower = change[np.arange(len(rows)), grades], change[np.arange(len(rows)), grades + 1]
        share = np.maximum(share, 1e-12)
        by_position = -(upper - lower) / share / len(rows)
        by_cut = np.zeros((len(rows), top + 2))
        by_cut[np.arange(len(rows)), grades] += upper / share / len(rows)
        by_cut[np.arange(len(rows)), grades + 1] -= lower / share / len(rows)
        cut = by_cut[:, 1 : top + 1].sum(axis=0)
        steps_slope = np.r_[cut.sum(), [cut[j:].sum() * np.exp(point[size + j]) for j in range(1, top)]]
        return np.r_[np.bincount(column, weights=by_position[row], minlength=size) + ridge * point[:size], steps_slope]

    shares = np.clip(above.mean(axis=0), 1e-4, 1 - 1e-4)
    cuts = np.log((1 - shares) / shares)
    start = np.r_[np.zeros(size), cuts[0], np.log(np.maximum(np.diff(cuts), 0.05))]
    found = minimise(slope, start, steps, 0.1)
    return OrdinalModel(features, found[:size], thresholds(found))


def features_step(batches: Batches) -> Batches:
    schema = pa.schema([("labelled", pa.int64()), ("label", pa.int32()), ("features", pa.list_(pa.int32()))])

    def rows() -> Iterator[tuple]:
        for labelled, label, text in rows_of(batches):
            yield labelled, label, feature_list(text)

    return in_batches(rows(), schema)


def trained(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> OrdinalModel | None:
    """The model fitted on at most MAX_LABELLED labelled documents."""
    sample = labelled_texts(docs, labelled_ids(labels, key, label, MAX_LABELLED), key, text)
    found = map_batches(sample, "labelled BIGINT, label INT, features ARRAY<INT>", features_step)
    # Rows that share an id: one of them.
    one = found.groupBy("labelled").agg(F.min(F.struct("label", "features")).alias("one")).select("labelled", "one.*")
    table = one.toArrow().sort_by("labelled").combine_chunks()
    lists = table["features"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.int32()))
    flat, ends = lists.flatten().to_numpy(), np.cumsum(np.r_[0, lists.value_lengths().to_numpy(zero_copy_only=False)]).tolist()
    return fit([flat[a:b] for a, b in zip(ends, ends[1:])], table["label"].to_numpy())


def scored(docs: DataFrame, model: OrdinalModel | None, key: str = "doc_id", text: str = "text", reject: float = REJECT) -> DataFrame:
    """(doc_id, severity, grade, toxic) of every document; the model is of bounded size and is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("severity", pa.float64()), ("grade", pa.int32()), ("toxic", pa.bool_())])

    def step(batches: Batches) -> Batches:
        weights = WordWeights(shared.value)

        def rows() -> Iterator[tuple]:
            for doc_id, value in rows_of(batches):
                expected, grade = (0.0, 0) if shared.value is None else severity(shared.value, weights, value)
                yield doc_id, expected, grade, expected >= reject

        return in_batches(rows(), schema)

    texts = docs.select(F.col(key).cast("long"), F.col(text))
    return map_batches(texts, "doc_id BIGINT, severity DOUBLE, grade INT, toxic BOOLEAN", step)


def kept(docs: DataFrame, model: OrdinalModel | None, text: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows of `docs` whose expected severity is below `reject`, with all their columns."""
    shared, place = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text)

    def step(batches: Batches) -> Batches:
        weights = WordWeights(shared.value)
        for batch in by_runs(batches, place):
            if shared.value is None:
                yield batch
                continue
            clean = [severity(shared.value, weights, value.as_py())[0] < reject for value in batch.column(place)]
            yield batch.filter(pa.array(clean, type=pa.bool_()))

    return map_batches(docs, docs.schema, step)
