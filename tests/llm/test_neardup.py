"""Components equal those of a comparison of all pairs."""

import random
import re
from itertools import combinations

import numpy as np
import pytest

from lorebase.llm import neardup, queries


def sets_of(texts, size):
    found = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        shingles = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if len(words) >= size else {tuple(words)}
        found.append(shingles if words else set())
    return found


def brute_force(rows, size):
    """{doc_id: (n_shingles, component)} of rows with distinct ids."""
    parent = {doc_id: doc_id for doc_id, _ in rows}

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    sets = dict(zip((doc_id for doc_id, _ in rows), sets_of([t for _, t in rows], size)))
    by_shingle = {}
    for doc_id, items in sets.items():
        for item in items:
            by_shingle.setdefault(item, []).append(doc_id)
    for a, b in {pair for ids in by_shingle.values() for pair in combinations(sorted(ids), 2)}:
        if 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id, _ in rows}


def edited(words, share, draw):
    return " ".join(draw.choice("pqrs") * 3 + str(draw.random()) if draw.random() < share else w for w in words)


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize("slice_bytes", [neardup.SLICE_BYTES, 20_000])
def test_components(spark, slice_bytes):
    draw = random.Random(3)
    base = [f"w{draw.randrange(500)}" for _ in range(150)]
    texts = [edited(base, draw.choice([0, 0.01, 0.03, 0.05]), draw) for _ in range(120)]
    texts += [" ".join(f"v{draw.randrange(300)}" for _ in range(draw.randint(1, 60))) for _ in range(60)]
    texts += ["", "  \n", "one two", "One  TWO", "one", "Éa b c d", "éa b c d"] + [texts[5]] * 20
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert found(neardup.near_duplicates(df, size=4, slice_bytes=slice_bytes)) == brute_force(rows, 4)


def test_chain_is_one_component(spark):
    words = [f"w{k}" for k in range(400)]
    rows = [(100 - k, " ".join(words[3 * k : 3 * k + 100])) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    result = found(neardup.near_duplicates(df, size=4))
    assert result == brute_force(rows, 4) and len({c for _, c in result.values()}) == 1


def test_defined_cases(spark):
    rows = [(1, None, 9), (2, "", 9), (None, "a b c d e f", 9), (4, "a b c d e f", 9), (3, "a b c d e f", 1), (3, "a b c d e f", 2)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, component_id INT")
    result = sorted(map(tuple, neardup.near_duplicates(df, size=5).collect()), key=str)
    wanted = [(1, 0, 1, True), (2, 0, 2, True), (3, 2, 3, True), (3, 2, 3, True), (4, 2, 3, False), (None, 2, None, True)]
    assert result == sorted(wanted, key=str)
    assert neardup.near_duplicates(df.limit(0), size=5).collect() == []


def test_sketch_fills_and_estimates():
    draw = np.random.default_rng(1)
    for count in (1, 2, 7, 300, 5000):
        items = np.unique(draw.integers(0, 2**63, count).astype(np.uint64))
        assert neardup.sketch(items, 288).max() < np.iinfo(np.uint64).max
    shared, left, right = (draw.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    a, b = (neardup.sketch(np.concatenate([shared, own]), 288) for own in (left, right))
    assert abs(np.mean(a == b) - 0.8) < 0.12


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    assert found(queries.op9_neardup(spark, folder)) == brute_force(rows, 4)
