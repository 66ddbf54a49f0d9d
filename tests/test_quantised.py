"""Codes find what the exact search finds; scores are exact; re-ranking reads few vectors."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lorebase.operators import quantised, search
from lorebase.plans import retrieval


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(8)
    made = draw.normal(size=(40, 64))[draw.integers(0, 40, 4_000)] + draw.normal(size=(4_000, 64)) * 0.5
    made /= np.linalg.norm(made, axis=1, keepdims=True)
    made[1_000:2_300] = made[0]  # a third of the rows are copies
    return made


@pytest.fixture(scope="module")
def known(spark, data):
    return spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(len(data)), "embedding": list(data)})).repartition(5).cache()


@pytest.fixture(scope="module")
def index(known):
    return quantised.build(known, quantised.fit(known))


@pytest.fixture(scope="module")
def asked(known):
    return known.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


def test_codebooks_stand_for_their_rows():
    draw = np.random.default_rng(1)
    rows_ = draw.normal(size=(600, 10))
    books = quantised.Codebooks.of(rows_, parts=5, centres=8, levels=64)
    code, queries = books.encode(rows_), draw.normal(size=(3, 10))
    stands = books.centres[code[:, 0]] + np.concatenate([part[code[:, i]] for i, part in enumerate(books.parts, 1)], axis=1)
    for asked in (queries, np.repeat(queries, 20, axis=0)):
        assert np.allclose(books.scorer(asked)(code), asked @ stands.T, atol=1e-4)
    assert np.isclose(books.error, np.sqrt(np.mean((rows_ - stands) ** 2)))
    for column, centres in ((rows_, books.centres), (rows_[:, :2] - books.centres[code[:, 0]][:, :2], books.parts[0])):
        distances = ((column[:, None, :] - centres[None]) ** 2).sum(axis=2)
        assert np.allclose(distances[np.arange(600), quantised.nearest(column, centres)], distances.min(axis=1))
    few = quantised.Codebooks.of(rows_[:5])
    assert few.error == 0 and len(few.centres) == 5


@pytest.mark.parametrize("block_rows", [None, 30])
def test_search(known, index, asked, block_rows):
    exact = search.top_k(known, asked, 5)
    found = quantised.quantised_top_k(index, asked, 5, block_rows=block_rows).cache()
    assert found.count() == exact.count()
    assert search.recall(exact, found).first().recall >= 0.98
    # What was found has its exact score.
    both = found.join(exact.withColumnRenamed("score", "want"), ["query_id", "vec_id"])
    assert both.filter(F.abs(F.col("score") - F.col("want")) > 1e-6).count() == 0


def test_copies_are_found_by_their_ids(known, index):
    one = known.filter("vec_id = 0").select(F.lit(7).alias("query_id"), "embedding")
    found = quantised.quantised_top_k(index, one, 4).orderBy("rank").collect()
    assert [r.vec_id for r in found] == [0, 1000, 1001, 1002] and found[0].score == pytest.approx(1, abs=1e-6)


def test_candidates_are_bounded(known, index, asked, monkeypatch):
    monkeypatch.setattr(quantised, "CANDIDATES", 100)
    monkeypatch.setattr(quantised, "DEPTH", 12)
    (_, found), = quantised.shortlists(index, asked, 5)
    assert found.groupBy("query_id").count().agg(F.max("count")).first()[0] <= 12
    exact = search.top_k(known, asked, 5)
    assert search.recall(exact, quantised.quantised_top_k(index, asked, 5)).first().recall >= 0.9


def test_files_give_back_their_rows(known, index, data):
    place = {r.vec_id: (r.file, r.row) for r in index.codes.select("vec_id", "file", "row").collect()}
    file = place[17][0]
    mine = sorted(i for i, (name, _) in place.items() if name == file)
    wanted = sorted(place[i][1] for i in mine[::9])
    back = {row: i for i, (name, row) in place.items() if name == file}
    got = quantised.read_rows(file, np.array(wanted), index.kind, index.width)
    assert np.allclose(got, data[[back[row] for row in wanted]])


def test_odd_vectors(spark):
    rows_ = [(i, [float(i), 1.0]) for i in range(8)] + [(8, [float("nan"), 1.0]), (9, None), (10, [float("inf"), 0.0])]
    table = spark.createDataFrame(rows_, "vec_id BIGINT, embedding ARRAY<FLOAT>").repartition(3)
    queries = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, float("nan")])], "query_id BIGINT, embedding ARRAY<DOUBLE>")
    built = quantised.build(table, quantised.fit(table))
    assert built.kind == "<f4" and built.codes.count() == 8
    assert rows(quantised.quantised_top_k(built, queries, 2)) == [(1, 1, 7, 7.0), (1, 2, 6, 6.0)]
    assert rows(quantised.quantised_top_k(built, queries, 20), "vec_id") == [(i,) for i in range(8)]
    empty = table.filter("vec_id < 0")
    nothing = quantised.build(empty, quantised.fit(empty))
    assert quantised.quantised_top_k(nothing, queries, 2).count() == 0
    assert quantised.bytes_read(nothing, queries, 2).first().share == 0
    assert quantised.quantised_top_k(built, queries.filter("false"), 2).count() == 0


def test_ids_of_several_columns(spark):
    table = spark.createDataFrame([(1 << 40, 3, [1.0]), (1 << 40, 1, [1.0]), (5, 9, [1.0]), (4, 0, [0.5])], "a BIGINT, b INT, embedding ARRAY<DOUBLE>")
    queries = spark.createDataFrame([(1, [1.0])], "query_id BIGINT, embedding ARRAY<DOUBLE>")
    built = quantised.build(table, quantised.fit(table, ("a", "b")), ("a", "b"))
    assert rows(quantised.quantised_top_k(built, queries, 2), "rank", "a", "b") == [(1, 5, 9), (2, 1 << 40, 1)]


def test_the_scan_reads_no_vectors(index, asked):
    shown = plan(quantised.quantised_top_k(index, asked, 3))
    assert "embedding" not in shown.split("ReadSchema")[1].splitlines()[0]
    assert "Join" not in shown and "Cartesian" not in shown


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
def test_recall_on_the_given_tables(spark, folder):
    found = {r.queries: r for r in retrieval.pq_recall(spark, folder).collect()}
    assert set(found) == {"labels", "rows"} and min(r.recall for r in found.values()) >= 0.98
    assert found["labels"].share <= 0.4
    assert retrieval.pq_topk(spark, folder).count() == 100


def test_candidates_are_held_and_given_in_bounds(tmp_path, monkeypatch):
    """A task gives its candidates in small batches, the same ones however often it cuts them."""
    draw = np.random.default_rng(4)
    made = draw.normal(size=(3_000, 16))
    books = quantised.Codebooks.of(made, parts=8, levels=32)
    asked = pa.table({"query_id": pa.array(range(70)), "embedding": pa.array(list(made[:70]), pa.list_(pa.float64()))})
    pq.write_table(asked, tmp_path / "asked.parquet")
    index = quantised.Index(None, books, ("vec_id",), "<f8", 16)

    def batches():
        for start in range(0, 3_000, 500):
            code = [bytes(row) for row in books.encode(made[start : start + 500])]
            columns = [range(start, start + 500), [f"f{start % 1_000}"] * 500, range(start, start + 500), code]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.string(), pa.int64(), pa.binary()))], names=["vec_id", "file", "row", "code"])

    found = []
    for merge in (1, 1 << 19):
        monkeypatch.setattr(quantised, "MERGE", merge)
        monkeypatch.setattr(quantised, "GIVEN", 100)
        given = list(quantised.scan_codes(str(tmp_path), index, 5, 1.0)(batches()))
        assert len(given) > 1 and max(batch.num_rows for batch in given) <= 100
        found.append(sorted(tuple(row.values()) for batch in given for row in batch.to_pylist()))
    assert found[0] == found[1] and {row[2] for row in found[0]} == {"f0", "f500"} and all(row[1] == row[3] for row in found[0])
