"""Segmentations equal the best of all ways to cut short texts; long ones take linear memory."""

import random
import tracemalloc
from itertools import combinations

import numpy as np
import pytest
from conftest import rows
from hypothesis import given, settings, strategies as st

from lorebase.functions import segments


def price(lengths, gaps, cuts, size, penalty):
    ends = [*cuts[1:], len(lengths)]
    return sum(gaps[c] for c in cuts if c) + sum(penalty * (1 - sum(lengths[a:b]) / size) ** 2 for a, b in zip(cuts, ends))


@pytest.mark.parametrize("seed", range(12))
def test_the_cheapest_of_all_cuts(seed):
    draw = random.Random(seed)
    count, most = draw.randrange(1, 10), draw.choice([3, 64])
    lengths, gaps = [draw.randrange(1, 90) for _ in range(count)], [0, *(draw.random() for _ in range(count - 1))]
    found = segments.best_cuts(np.array(lengths), np.array(gaps), 60, 0.5, most)
    every = [(0, *cuts) for n in range(count) for cuts in combinations(range(1, count), n)]
    every = [c for c in every if max(b - a for a, b in zip(c, [*c[1:], count])) <= most]
    assert found[0] == 0 and np.isclose(price(lengths, gaps, found, 60, 0.5), min(price(lengths, gaps, c, 60, 0.5) for c in every))


def test_scores_of_gaps():
    scores = segments.gap_scores(["Red cat. ", "A red cat! ", "...", "Blue sea."], 1)
    assert scores[0] == 0 and np.isclose(scores[1], 2 / 6**0.5) and list(scores[2:]) == [0, 0]
    assert segments.gap_scores(["a b.", "c.", "a b."], 2)[1] > 0


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab .\n!Éß"))
def test_chunks_put_together_are_the_text(text):
    found = segments.segments(text, 20)
    assert "".join(found) == text and all(found)


def test_topics_are_told_apart():
    one, two = "The red cat sat on the mat. ", "Blue ships sail over deep water. "
    # A sentence starts with the blank before it.
    assert [chunk.strip() for chunk in segments.segments(one * 6 + two * 6, 190)] == [(one * 6).strip(), (two * 6).strip()]


def test_rows(spark):
    df = spark.createDataFrame([(1, "One. Two.", "x"), (1, "One. Two.", "x"), (2, None, "y"), (3, "", "z")], "id INT, t STRING, chunk_id STRING")
    assert rows(segments.global_chunks(df, "t")) == [(1, "x", 0, "One. Two.")] * 2


def test_memory_is_linear():
    sizes = []
    for count in (4_000, 16_000):
        gaps, lengths = np.random.default_rng(1).random(count), np.full(count, 40)
        tracemalloc.start()
        segments.best_cuts(lengths, gaps, 500, 0.5)
        sizes.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert sizes[1] < 6 * sizes[0]
