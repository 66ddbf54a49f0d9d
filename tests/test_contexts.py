"""The choice equals a plain one, step by step; budgets hold; what says the same is said once."""

import random

import numpy as np
import pytest

from lorebase.operators import contexts


def plain(hits, budget, trade, same):
    """hits: (rank, id, score, words, vector) in their order."""
    taken, rest = [], list(hits)
    while True:
        room = budget - sum(h[3] for h in taken)
        rest = [h for h in rest if h[3] <= room and all(round(float(np.dot(h[4], t[4])), 6) < same for t in taken)]
        if not rest:
            return [h[1] for h in taken]

        def gain(hit):
            alike = max((round(float(np.dot(hit[4], t[4])), 6) for t in taken), default=0.0)
            return round(trade * hit[2] - (1 - trade) * alike, 6)

        best = max(rest, key=lambda h: (gain(h), -hits.index(h)))
        taken.append(best)
        rest.remove(best)


@pytest.mark.parametrize("budget", [5, 40, 10_000])
def test_choice(spark, budget):
    draw = random.Random(budget)
    hits, chunks, wanted = [], {}, {}
    for query in range(25):
        mine = []
        for rank in range(1, draw.randrange(2, 12)):
            doc, vector = draw.randrange(60), [draw.choice([0.0, 0.6, 0.8, 1.0]) for _ in range(4)]
            if any(h[1] == doc for h in mine):
                continue
            norm = sum(x * x for x in vector) ** 0.5 or 1.0
            _, _, words, vector = chunks.setdefault(doc, (doc, 0, draw.randrange(1, 20), [x / norm for x in vector]))
            mine.append((rank, doc, round(1 - rank / 20, 6), words, vector))
        hits += [(query, rank, score, doc, 0) for rank, doc, score, _, _ in mine]
        wanted[query] = plain(mine, budget, 0.7, 0.95)
    table = spark.createDataFrame([(d, n, "w " * w, v) for d, n, w, v in chunks.values()], "doc_id BIGINT, chunk_no INT, chunk STRING, embedding ARRAY<DOUBLE>")
    asked = spark.createDataFrame(hits, "query_id BIGINT, rank INT, score DOUBLE, doc_id BIGINT, chunk_no INT")
    found = contexts.budgeted(asked, table, budget).orderBy("query_id", "place").collect()
    mine = {query: [r.doc_id for r in found if r.query_id == query] for query in wanted}
    assert mine == wanted
    for query in wanted:
        assert sum(r.words for r in found if r.query_id == query) <= budget
    assert contexts.budgeted(asked.limit(0), table).count() == 0


def test_the_same_is_said_once(spark):
    chunks = [(1, 0, "a b", [1.0, 0.0]), (2, 0, "a b", [1.0, 0.0]), (3, 0, "c", [0.0, 1.0]), (4, 0, None, [1.0, 0.0]), (5, 0, "d", None)]
    table = spark.createDataFrame(chunks, "doc_id BIGINT, chunk_no INT, chunk STRING, embedding ARRAY<DOUBLE>")
    hits = [(9, rank, 1 - rank / 10, rank, 0) for rank in range(1, 6)]
    found = contexts.budgeted(spark.createDataFrame(hits, "query_id BIGINT, rank INT, score DOUBLE, doc_id BIGINT, chunk_no INT"), table)
    assert [r.doc_id for r in found.orderBy("place").collect()] == [1, 3]
