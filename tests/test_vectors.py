import numpy as np
import pandas as pd
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lorebase.functions import vectors
from lorebase.operators import search
from lorebase.session import fresh_path


@pytest.fixture(scope="module")
def data():
    made = np.random.default_rng(5).normal(size=(3_000, vectors.DIM))
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    made[1_000:2_000] = made[0]  # a third of the rows are copies
    return made


@pytest.fixture(scope="module")
def stored(spark, data):
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(data)), "embedding": list(data)}))
    return df.repartition(6).cache()


@pytest.fixture(scope="module")
def asked(stored):
    return stored.filter("vec_id % 60 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def brute(data, ids, k, allowed=None):
    found = []
    for q in ids:
        scores = np.round(data @ data[q], 6)
        if allowed is not None:
            scores = np.where(allowed(q), scores, -np.inf)
        best = np.lexsort((np.arange(len(data)), -scores))[:k]
        found += [(int(q), r, int(i), float(scores[i])) for r, i in enumerate(best, 1) if scores[i] > -np.inf]
    return found


def close(mine, theirs):
    mine, theirs = sorted(mine), sorted(theirs)
    assert [m[:2] for m in mine] == [t[:2] for t in theirs]
    assert np.allclose([m[3] for m in mine], [t[3] for t in theirs], atol=2e-6)
    same = sum(m[2] == t[2] for m, t in zip(mine, theirs))
    assert same >= len(mine) - 2  # a pair may swap where scores differ in the last digit


@pytest.mark.parametrize("block_rows", [10_000, 7])
def test_exact_search(stored, asked, data, block_rows):
    ids = range(0, 3_000, 60)
    close([tuple(r) for r in search.top_k(stored, asked, 4, block_rows).collect()], brute(data, ids, 4))


@pytest.mark.parametrize("cells", [False, True])
def test_search_over_many_small_slices(stored, asked, data, monkeypatch, cells):
    monkeypatch.setattr(search, "SCORES", 64)  # 16 vectors at a time
    known = stored.orderBy(F.desc("vec_id")).coalesce(2)  # copies arrive with falling ids
    if cells:
        found = search.ann_top_k(search.with_cells(known, 4), asked, 4, 4, 4)
    else:
        found = search.top_k(known, asked, 4)
    close([tuple(r) for r in found.collect()], brute(data, range(0, 3_000, 60), 4))
    copies = search.top_k(known, asked.filter("query_id = 0"), 5)
    assert [r.vec_id for r in copies.orderBy("rank").collect()] == [0, 1000, 1001, 1002, 1003]


def test_search_keeps_equal_scores_by_id(stored, asked):
    best = search.top_k(stored, asked.filter("query_id = 0"), 5)
    assert [r.vec_id for r in best.orderBy("rank").collect()] == [0, 1000, 1001, 1002, 1003]


def test_rows_without_a_vector_take_no_part(spark, stored, asked):
    gap = spark.createDataFrame([(9_999, None)], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = search.top_k(stored.unionByName(gap), asked.unionByName(gap.withColumnRenamed("vec_id", "query_id")), 2)
    assert rows(found) == rows(search.top_k(stored, asked, 2))


def test_no_queries_and_few_vectors(stored, asked):
    assert search.top_k(stored, asked.filter("false")).count() == 0
    assert search.top_k(stored.filter("vec_id < 3"), asked.filter("query_id = 60"), 5).count() == 3


def test_cell_search_is_exact_within_its_cells(stored, asked, data):
    index = search.with_cells(stored, 6).cache()
    cells = dict(rows(index, "vec_id", "cell"))
    owner = np.array([cells[i] for i in range(len(data))])
    near = brute(data, range(0, 3_000, 60), 4, lambda q: np.bitwise_count(owner ^ owner[q]) <= 2)
    close([tuple(r) for r in search.ann_top_k(index, asked, 4, 2, 6).collect()], near)
    every = search.ann_top_k(index, asked, 4, 6, 6)
    assert rows(search.recall(search.top_k(stored, asked, 4), every))[0][2] >= 0.99


def test_recall_has_a_floor(stored, asked):
    exact = search.top_k(stored, asked, 2)
    found = search.ann_top_k(search.with_cells(stored, 6), asked, 2, 2, 6)
    assert search.recall(exact, found).first().recall > 0.5  # every query finds itself


def test_stored_index_prunes_folders(spark, stored, asked):
    path = fresh_path(spark, "index")
    search.write_index(search.with_cells(stored, 4), path)
    index = spark.read.parquet(path)
    assert index.count() == 3_000
    one = search.ann_top_k(index, asked.filter("query_id = 60"), 3, 1, 4)
    filters = [line for line in plan(one).splitlines() if line.startswith("PartitionFilters")]
    assert filters and all("cell" in line for line in filters)
    memory = search.ann_top_k(search.with_cells(stored, 4), asked.filter("query_id = 60"), 3, 1, 4)
    assert rows(one) == rows(memory)


def test_search_by_centroids(stored, asked, data):
    centroids = search.fit_centroids(stored, 12)
    index = search.with_centroid_cells(stored, centroids).cache()
    owner = dict(rows(index, "vec_id", "cell"))
    cells = np.array([owner[i] for i in range(len(data))])
    assert (cells == np.argmax(data @ centroids.T, axis=1)).mean() > 0.999

    def near(q):
        return np.isin(cells, np.argsort(-(centroids @ data[q]), kind="stable")[:3])

    close([tuple(r) for r in search.centroid_top_k(index, asked, centroids, 4, 3).collect()], brute(data, range(0, 3_000, 60), 4, near))
    every = search.centroid_top_k(index, asked, centroids, 4, 12, block_rows=9)
    close([tuple(r) for r in every.collect()], brute(data, range(0, 3_000, 60), 4))


def test_search_never_joins(stored, asked):
    shown = plan(search.top_k(stored, asked, 3))
    assert "Join" not in shown and "Cartesian" not in shown and "WindowGroupLimit" in shown


def test_vectors_that_are_not_finite_are_left_out(spark):
    rows_ = [(i, [float(i), 0.0]) for i in range(8)] + [(8, [float("nan"), 1.0]), (9, None), (10, [float("inf"), 0.0]), (11, [1.0, None])]
    known = spark.createDataFrame(rows_, "vec_id BIGINT, embedding ARRAY<DOUBLE>").coalesce(1)
    asked = spark.createDataFrame([(1, [1.0, 0.0]), (2, [float("nan"), 0.0])], "query_id BIGINT, embedding ARRAY<DOUBLE>")
    assert rows(search.top_k(known, asked, 1)) == [(1, 1, 7, 7.0)]
    assert rows(search.unusable(known), "vec_id") == [(10,), (11,), (8,), (9,)]


def test_ids_of_several_columns(spark):
    known = spark.createDataFrame([(1 << 40, 3, [1.0]), (1 << 40, 1, [1.0]), (5, 9, [1.0]), (4, 0, [0.5])], "a BIGINT, b INT, embedding ARRAY<DOUBLE>")
    asked = spark.createDataFrame([(1, [1.0])], "query_id BIGINT, embedding ARRAY<DOUBLE>")
    assert rows(search.top_k(known, asked, 2, ids=("a", "b")), "rank", "a", "b") == [(1, 5, 9), (2, 1 << 40, 1)]


def test_texts_that_share_an_id_stay_apart(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "id BIGINT, t STRING")
    assert vectors.embed(df, ["id"], "t").count() == 3


def test_embedding(spark):
    texts = ["", "a b a", "Été, été!", "x" * 50]
    df = spark.createDataFrame(list(enumerate(texts)), "id BIGINT, t STRING")
    found = dict(rows(vectors.embed(df, ["id"], "t")))
    for i, t in enumerate(texts):
        assert np.allclose(found[i], vectors.literal_vector(t))
    assert sum(found[0]) == 0 and np.isclose(np.linalg.norm(found[1]), 1)


def test_model_slots(spark):
    df = spark.createDataFrame([("abc",), ("",)], "t STRING")
    sized = vectors.embed_with(df, "t", lambda texts: texts.map(lambda t: [float(len(t))]))
    assert rows(sized) == [("", [0.0]), ("abc", [3.0])]
    answered = search.generate(df.withColumnRenamed("t", "context"), lambda texts: texts.str.upper())
    assert rows(answered, "answer") == [("",), ("ABC",)]


def test_cell_search_finds_nine_tenths(spark):
    from lorebase.plans import retrieval

    assert retrieval.ann_recall(spark, "/root/testdata/sf0.01").first().recall >= 0.9
    # Rows of the table as queries.
    known = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    asked = known.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding")
    index = search.with_cells(known, retrieval.ANN_BITS)
    found = search.ann_top_k(index, asked, 10, retrieval.ANN_WITHIN, retrieval.ANN_BITS)
    assert search.recall(search.top_k(known, asked, 10), found).first().recall >= 0.9


def test_cluster_search_finds_nine_tenths(spark):
    from lorebase.plans import retrieval

    assert retrieval.CENTROID_RECALL >= 0.9
    assert tuple(retrieval.centroid_recall(spark, "/root/testdata/sf0.01").first()) == (100, True)
    recalls = {r.queries: r.recall for r in retrieval.centroid_recalls(spark, "/root/testdata/sf0.01").collect()}
    assert set(recalls) == {"labels", "rows"} and min(recalls.values()) >= 0.9


def test_vectors_are_worked_out_once_for_many_query_blocks(spark, data, asked):
    worked = spark.sparkContext.accumulator(0)

    @F.udf("array<double>")
    def made(vec_id):
        worked.add(1)
        return [float(x) for x in data[vec_id]]

    known = spark.range(200).withColumnRenamed("id", "vec_id").withColumn("embedding", made("vec_id"))
    found = search.top_k(known, asked, 3, block_rows=7)
    want = []
    for q in range(0, 3_000, 60):
        scores = np.round(data[:200] @ data[q], 6)
        want += [(q, r, int(i), float(scores[i])) for r, i in enumerate(np.lexsort((np.arange(200), -scores))[:3], 1)]
    close([tuple(r) for r in found.collect()], want)
    assert worked.value == 200


@pytest.mark.parametrize("scale", [1e-9, 1.0, 1e6, 1e13])
def test_quick_scores_lose_no_hit(data, scale):
    """Vectors that differ by less than single precision can tell are still ranked by their exact scores."""
    draw = np.random.default_rng(3)
    known = np.repeat(data[:40], 25, axis=0) * (1 + draw.normal(size=(1_000, 1)) * 1e-8) * scale
    queries = data[2_000:2_030]
    exact = np.round(np.einsum("qj,vj->qv", queries, known), 6)
    for floor in (np.full(30, -np.inf), np.sort(exact, axis=1)[:, -9]):
        q, v, s = search.candidates(search.Asked.of(queries), known, floor, 5)
        assert np.allclose(s, exact[q, v], rtol=1e-12, atol=2e-6)
        for query in range(30):
            assert (np.sort(s[q == query])[-5:] == pytest.approx(np.sort(exact[query])[-5:], rel=1e-12, abs=2e-6))


@pytest.mark.parametrize("dim", [1, 16, 64, 94, 95, 130])
def test_words_are_counted_by_bucket(spark, dim):
    texts = ["", "one", "a a a b, c-d", " ".join(f"w{n % 57}" for n in range(500)), "Grüße 日本 ٣"]
    df = spark.createDataFrame(list(enumerate(texts)), "id LONG, t STRING")
    found = df.select("id", vectors.buckets(F.col("t"), dim).alias("b"))
    counted = found.select("id", "b", vectors.signs(F.col("b"), dim).alias("s")).select("b", vectors.counts(F.col("s"), dim).alias("c")).collect()
    assert all(row.c == np.bincount(row.b, minlength=dim).tolist() for row in counted)
