"""The space is that of a plain SVD; it finds passages that hashed counts lose."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lorebase.functions import vectors
from lorebase.operators import search, semantic

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").repartition(5).cache()


def plain(texts, words):
    """The weighted matrix, row by row."""
    rows = [semantic.counted(text, words) for text in texts]
    rows = [row for row in rows if len(row[0])]
    known = np.zeros(words)
    for buckets, _ in rows:
        known[buckets] += 1
    idf = np.log((1 + len(rows)) / (1 + known)) + 1
    matrix = np.zeros((len(rows), words))
    for place, (buckets, times) in enumerate(rows):
        matrix[place, buckets] = (1 + np.log(times)) * idf[buckets]
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def test_space_equals_plain_svd(docs):
    words = 1 << 11
    matrix = plain([r.text for r in docs.collect()], words)
    _, values, directions = np.linalg.svd(matrix, full_matrices=False)
    space = semantic.fit(docs, "text", dims=12, words=words, rounds=6)
    assert np.allclose(space.values, values[:12], rtol=0.02)
    assert np.allclose(space.basis.T @ space.basis, np.eye(12), atol=1e-8)
    # The first directions lie within the plain ones.
    inside = np.linalg.norm(directions[:14] @ space.basis[:, :6], axis=0)
    assert inside.min() > 0.95


def test_odd_texts(spark, docs):
    space = semantic.fit(docs, "text", dims=8, words=1 << 10, rounds=1)
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "..."), (4, "the"), (4, "the")], "id INT, t STRING")
    found = sorted((r.id, tuple(r.embedding)) for r in semantic.embed(odd, ["id"], "t", space).collect())
    assert [i for i, _ in found] == [1, 2, 3, 4, 4] and found[3] == found[4]
    assert all(not any(v) for i, v in found if i < 4) and np.isclose(np.linalg.norm(found[3][1]), 1)
    assert semantic.fit(odd.filter("id < 4"), "t", words=64) is None
    assert semantic.fit(odd.limit(0), "t", words=64) is None


def test_it_finds_passages(spark):
    """Of benchmark items that stand in a document, how many of those documents are among the first five."""
    folder = "/root/testdata/sf0.01"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{folder}/benchmark.parquet").select(F.col("item_id").alias("query_id"), F.col("text").alias("item"))
    holds = {(r.query_id, r.doc_id) for r in texts.join(items, F.contains("text", "item")).select("query_id", "doc_id").collect()}
    assert holds

    def found(embedded, asked):
        hits = search.top_k(embedded.withColumnRenamed("doc_id", "vec_id"), asked, 5).collect()
        return sum((r.query_id, r.vec_id) in holds for r in hits)

    space = semantic.fit(texts, "text")
    learned = found(semantic.embed(texts, ["doc_id"], "text", space), semantic.embed(items, ["query_id"], "item", space))
    hashed = found(vectors.embed(texts, ["doc_id"], "text"), vectors.embed(items, ["query_id"], "item"))
    print("learned", learned, "hashed", hashed, "of", len(holds))
    assert learned >= hashed


def test_words_are_those_of_the_separator():
    texts = [None, "", "a_b  C-d\x00e\x1cf", "Ünï cödé ²x ٣ 日本", "".join(map(chr, range(300))), "İx Σς K", "tab\tline\n9"]
    for text in texts:
        assert sorted(w.decode() for w in semantic.words_of(text)) == sorted(w for w in semantic.SEPARATOR.split((text or "").lower()) if w)


def test_dense_and_sparse_products_are_the_same(monkeypatch):
    draw = np.random.default_rng(2)
    sizes = draw.integers(1, 60, 100)
    buckets = np.concatenate([np.sort(draw.choice(500, size, replace=False)) for size in sizes]).astype(np.int32)
    weights, starts = draw.random(len(buckets)), np.r_[0, np.cumsum(sizes)[:-1]]
    block, plain = draw.normal(size=(500, 9)), np.zeros((100, 500))
    for row, (start, size) in enumerate(zip(starts, sizes)):
        plain[row, buckets[start : start + size]] = weights[start : start + size]
    for held in (1, 2, 20, 1000):
        monkeypatch.setattr(semantic, "SHARED", held)
        total = np.zeros((500, 9))
        semantic.product(buckets, weights, starts, block, total)
        assert np.allclose(total, plain.T @ (plain @ block))
        assert np.allclose(semantic.Split.of(buckets, weights, starts, 500).times(block), plain @ block)


def test_runs_of_rows_are_bounded():
    rows = 3 * semantic.ROWS + 5
    batch = pa.record_batch([pa.array([[n % 7, 9] for n in range(rows)], pa.list_(pa.int32()))] * 2, names=["buckets", "times"])
    sizes = [len(starts) for _, _, starts in semantic.flat_rows(batch, 1 << 30)]
    assert sum(sizes) == rows and max(sizes) <= semantic.ROWS
