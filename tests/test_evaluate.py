import random

import pytest
from conftest import rows

from lorebase.operators import evaluate, search


def pairs(spark):
    return spark.createDataFrame(
        [(1, "where is my parcel", "your parcel is here"), (2, "login", "your Password is x"), (3, "hi", "")],
        "id BIGINT, question STRING, answer STRING",
    )


def test_scores(spark):
    found = {(r.id, r.scorer): r.score for r in evaluate.scores(pairs(spark), ["id"]).collect()}
    assert found[(1, "relevance")] > 0 and found[(3, "relevance")] == 0
    assert (found[(1, "safety")], found[(2, "safety")], found[(3, "safety")]) == (1.0, 0.0, 1.0)
    assert (found[(1, "groundedness")], found[(2, "groundedness")], found[(3, "groundedness")]) == (0.5, 0.0, 0.0)
    summary = dict(rows(evaluate.summary(evaluate.scores(pairs(spark), ["id"])), "scorer", "mean_score"))
    assert summary["safety"] == 0.666667


def test_questions_and_their_answers(spark):
    chat = spark.createDataFrame(
        [(1, 0, "system", "s"), (1, 1, "user", "q1"), (1, 2, "assistant", "a1"), (1, 3, "user", "q2"), (2, 0, "assistant", "a")],
        "conv_id BIGINT, seq BIGINT, role STRING, content STRING",
    )
    assert rows(evaluate.answered_questions(chat)) == [(1, 1, "q1", "a1")]


def test_retrieval_scores(spark):
    hits = spark.createDataFrame([(1, 10), (1, 11), (2, 10)], "query_id BIGINT, vec_id BIGINT")
    relevant = spark.createDataFrame([(1, 10), (2, 99)], "query_id BIGINT, vec_id BIGINT")
    assert rows(evaluate.retrieval_relevance(hits, relevant)) == [(1, 2, 0.5), (2, 1, 0.0)]
    labels = spark.createDataFrame([(10, 0), (11, 1)], "doc_id BIGINT, toxic INT")
    assert rows(evaluate.safe_retrieval(hits.withColumnRenamed("vec_id", "doc_id"), labels)) == [(1, 2, 0.5), (2, 1, 1.0)]


def test_context(spark):
    hits = spark.createDataFrame([(7, 2, 1, 0), (7, 1, 1, 3)], "query_id BIGINT, rank INT, doc_id BIGINT, chunk_no INT")
    chunks = spark.createDataFrame([(1, 0, "zero"), (1, 3, "three"), (2, 0, "x")], "doc_id BIGINT, chunk_no INT, chunk STRING")
    facts = spark.createDataFrame([(7, "fact")], "query_id BIGINT, fact STRING")
    assert rows(search.assemble_context(hits, chunks, facts, "|")) == [(7, "three|zero|fact", "three")]
    assert rows(search.assemble_context(hits, chunks, facts.filter("false"), "|")) == [(7, "three|zero", "three")]


def test_intervals_equal_plain_draws(spark):
    import hashlib

    draw = random.Random(3)
    made = [(n, draw.choice(["a", "b"]), draw.random()) for n in range(120)] + [(200, "a", None)]
    found = evaluate.intervals(spark.createDataFrame(made, "id INT, scorer STRING, score DOUBLE"), ["id"], 60, 0.05).collect()
    assert sorted(r.scorer for r in found) == ["a", "b"]
    for row in found:
        mine = [(n, score) for n, scorer, score in made if scorer == row.scorer and score is not None]
        means = []
        for replicate in range(1, 61):
            times = []
            for n, _ in mine:
                value = int(hashlib.md5(f"{n}|{row.scorer}|{replicate}".encode()).hexdigest()[:5], 16)
                times.append(sum(value >= limit for limit in evaluate.POISSON))
            means.append(sum(t * s for t, (_, s) in zip(times, mine)) / sum(times))
        means.sort()
        assert row.n_rows == len(mine) and row.mean_score == pytest.approx(sum(s for _, s in mine) / len(mine), abs=1e-6)
        assert (row.low, row.high) == (pytest.approx(means[3], abs=2e-6), pytest.approx(means[-4], abs=2e-6))
        assert row.low < row.mean_score < row.high


def test_poisson_draws_have_mean_one():
    counts = [sum(value >= limit for limit in evaluate.POISSON) for value in range(0, 1 << 20, 7)]
    assert abs(sum(counts) / len(counts) - 1) < 0.001
