"""Word vectors equal a plain count; held-out rows are told apart with calibrated probabilities."""

import random
import zlib

import numpy as np
import pytest

from lorebase.llm import quality, queries


def plain_sums(texts):
    table = np.zeros((quality.BUCKETS, quality.DIMENSIONS), dtype=np.int64)
    for text in texts:
        codes = [zlib.crc32(t.encode()) % quality.BUCKETS * quality.SHAPES + quality.shape_of(t) for t in quality.TOKEN.findall(text or "")]
        for place, code in enumerate(codes):
            for other in range(max(0, place - quality.REACH), min(len(codes), place + quality.REACH + 1)):
                if other != place:
                    word, shape = divmod(codes[other], quality.SHAPES)
                    for sign, words, shapes in zip((1, -1), quality.WORD_PLACES, quality.SHAPE_PLACES):
                        table[code // quality.SHAPES, words[word]] += sign
                        table[code // quality.SHAPES, shapes[shape]] += sign
    return table


TEXTS = ["one two, Two three!! FOUR 5", "", None, " \n", "x", "one one one one", "é ß | é", "a b " * 30]


@pytest.mark.parametrize("stretch, part", [(1 << 17, 1 << 20), (7, 9), (3, 4)])
def test_word_vectors(spark, monkeypatch, stretch, part):
    monkeypatch.setattr(quality, "STRETCH", stretch)
    monkeypatch.setattr(quality, "PART_CHARS", part)
    docs = spark.createDataFrame([(t, 1) for t in TEXTS], "text STRING, bucket INT").repartition(3)
    sums = plain_sums(TEXTS).astype(np.float64)
    wanted = sums / np.maximum(np.sqrt((sums**2).sum(axis=1, keepdims=True)), 1e-9)
    assert np.allclose(quality.word_vectors(docs), wanted, atol=1e-6)


def test_pooling(monkeypatch):
    vectors = np.random.default_rng(1).normal(size=(quality.BUCKETS, quality.DIMENSIONS)).astype(np.float32)
    codes = quality.codes_of("a b a b c!! A " * 5, quality.TokenCodes())
    whole = quality.pooled(codes, vectors)
    found = vectors[codes // quality.SHAPES]
    assert np.allclose(whole[: quality.DIMENSIONS], found.mean(axis=0), atol=1e-5)
    assert np.allclose(whole[quality.DIMENSIONS : 2 * quality.DIMENSIONS], found.std(axis=0), atol=1e-4)
    monkeypatch.setattr(quality, "STRETCH", 7)
    assert np.allclose(quality.pooled(codes, vectors), whole, atol=1e-6)
    assert not quality.pooled(codes[:0], vectors).any()
    same = quality.pooled(quality.codes_of("w " * 9, quality.TokenCodes()), vectors)
    assert (same[-quality.LAGS :] == 2).all()


def test_network_learns_and_is_calibrated():
    draw = np.random.default_rng(2)
    rows = draw.normal(size=(4000, quality.POOLED))
    rows[:, 6:] = 0
    chance = quality.sigmoid(2.5 * rows[:, 0] * rows[:, 1] + rows[:, 2])
    labels = (draw.random(4000) < chance).astype(np.int64)
    scores = quality.fit(rows[:3000], labels[:3000], ridge=1e-2).scores(rows[3000:])
    assert np.mean((scores >= 0.5) == (chance[3000:] >= 0.5)) > 0.85
    assert abs(scores.mean() - chance.mean()) < 0.05
    assert quality.temperature_of(np.array([9.0, 9.0, -9.0, 9.0]), np.array([1, 0, 0, 1])) > 2


def test_defined_cases(spark):
    draw = random.Random(4)
    texts = [(k, " ".join(draw.choices(["good", "fine", "prose", "here"] if k % 3 else ["x##", "$$", "!!", "Z|"], k=20))) for k in range(200)]
    rows = [(k, t, "s") for k, t in texts] + [(900, None, "s"), (901, "", "s"), (None, "good prose", "s"), (5, texts[5][1], "s")]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, score STRING")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k, _ in texts] + [(None, 1), (7, None), (9999, 0)], "doc_id BIGINT, quality INT")
    shared = spark.sparkContext.broadcast(quality.word_vectors(docs))
    network = quality.trained(docs, labels, shared)
    found = {r.doc_id: r.score for r in quality.scored(docs, shared, network).collect()}
    assert len(found) == 203 and all(0 <= s <= 1 for s in found.values()) and found[900] == found[901]
    assert all((found[k] >= 0.7) == (k % 3 > 0) for k, _ in texts)
    for some, score in ((labels.where("quality = 1"), 1.0), (labels.limit(0), 0.5)):
        assert {r.score for r in quality.scored(docs, shared, quality.trained(docs, some, shared)).collect()} == {score}
    assert quality.scored(docs.limit(0), shared, network).collect() == []
    assert not quality.word_vectors(docs.limit(0)).any()


def test_query(spark):
    folder = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = queries.op10_quality(spark, folder).collect()
    assert len(found) == 10_000
    held_out = []
    for row in found:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2)
        assert row.predicted == int(row.score >= 0.7)
        if row.held_out and row.doc_id in labels:
            held_out.append((labels[row.doc_id], row.score))
    right = [(score >= 0.7) == (label == 1) for label, score in held_out]
    assert len(right) > 500 and np.mean(right) > 0.97
    # Of the rows that get about the same probability, about that share has label 1.
    assert abs(np.mean([s for _, s in held_out]) - np.mean([label for label, _ in held_out])) < 0.02


def plain_pool(text, vectors):
    """Mean, spread, index means and agreements of a text's tokens, token by token."""
    codes = [(zlib.crc32(t.encode()) % quality.BUCKETS, quality.shape_of(t)) for t in quality.TOKEN.findall(text or "")]
    if not codes:
        return np.zeros(quality.POOLED)
    found = np.array([vectors[word] for word, _ in codes], dtype=np.float64)
    index = []
    for word, shape in codes:
        one = np.zeros(quality.DIMENSIONS)
        for sign, words, shapes in zip((1, -1), quality.WORD_PLACES, quality.SHAPE_PLACES):
            one[words[word]] += sign
            one[shapes[shape]] += sign
        index.append(one)
    words = []
    for word, _ in codes:
        words.append((quality.WORD_PLACES[0][word], quality.WORD_PLACES[1][word]))
    agreements = np.zeros(quality.LAGS)
    for lag in range(1, quality.LAGS + 1):
        pairs = list(zip(words, words[lag:]))
        if pairs:
            agreements[lag - 1] = np.mean([int(a == c) + int(b == d) - int(a == d) - int(b == c) for (a, b), (c, d) in pairs])
    spread = np.sqrt(np.maximum((found**2).mean(axis=0) - found.mean(axis=0) ** 2, 0))
    return np.concatenate([found.mean(axis=0), spread, np.mean(index, axis=0), agreements])


def test_scores_equal_plain_sums(spark):
    """Pooling and both layers by hand, for odd texts and some of the given ones."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    table = quality.word_vectors(docs)
    vectors = spark.sparkContext.broadcast(table)
    network = quality.trained(docs, labels, vectors)
    odd = spark.createDataFrame([(-n - 1, t) for n, t in enumerate(TEXTS)], "doc_id BIGINT, text STRING")
    some = docs.where("doc_id < 40").unionByName(odd)
    texts = {r.doc_id: r.text for r in some.collect()}
    weights, bias, out, last = network.layers(network.point)
    for row in quality.scored(some, vectors, network).collect():
        inputs = (plain_pool(texts[row.doc_id], table) - network.mean) / network.scale
        hidden = [np.tanh(sum(x * w for x, w in zip(inputs, column)) + b) for column, b in zip(weights.T, bias)]
        logit = (sum(h * o for h, o in zip(hidden, out)) + last) / network.temperature
        assert row.score == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-4), row.doc_id
