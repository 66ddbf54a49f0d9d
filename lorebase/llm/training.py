"""Labelled samples of bounded size, and the optimiser, for the models that the driver fits."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F


def labelled_ids(labels: DataFrame, key: str, label: str, most: int, among: Column | None = None) -> DataFrame:
    """(labelled, label): at most `most` ids, the first by a hash of the id; of several labels of an id the largest holds."""
    known = labels.select(F.col(key).cast("long").alias("labelled"), F.col(label).cast("int").alias("label"))
    known = known.where(F.col("labelled").isNotNull() & F.col("label").isNotNull())
    known = known.groupBy("labelled").agg(F.max("label").alias("label"))
    if among is not None:
        known = known.where(among)
    return known.orderBy(F.xxhash64("labelled"), "labelled").limit(most)


def labelled_texts(docs: DataFrame, ids: DataFrame, key: str, text: str) -> DataFrame:
    """(labelled, label, text) of the sampled ids, whose number is bounded; they are broadcast, the texts don't move."""
    texts = docs.select(F.col(key).cast("long").alias("labelled"), F.col(text).alias("text"))
    return texts.join(F.broadcast(ids), "labelled").select("labelled", "label", "text")


def minimise(
    gradient: Callable[[np.ndarray], np.ndarray], start: np.ndarray, steps: int, rate: float
) -> np.ndarray:
    """Adam with a rate that falls linearly, over all rows in every step: the same data give the same model."""
    point, mean, square = start.astype(np.float64).copy(), np.zeros(start.shape), np.zeros(start.shape)
    for step in range(1, steps + 1):
        slope = gradient(point)
        mean = 0.9 * mean + 0.1 * slope
        square = 0.999 * square + 0.001 * slope**2
        fall = rate * (1 - (step - 1) / steps)
        point -= fall * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    return point


def sigmoid(values: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(values, -500, 500)))
