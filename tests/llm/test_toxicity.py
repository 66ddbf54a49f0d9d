"""The model learns ordered grades; held-out documents are told apart; every case has its result."""

import random

import duckdb
import numpy as np

from lorebase.llm import queries, toxicity

BAD = ["vile", "nasty", "awful", "horrid", "rotten", "foul"]


def made(draw, count):
    """(id, grade 0 to 2, text): the more bad words, the higher the grade."""
    rows = []
    for doc_id in range(count):
        grade = draw.choice([0, 0, 0, 1, 2])
        words = [f"w{draw.randrange(400)}x" for _ in range(draw.randint(20, 60))]
        words += draw.sample(BAD, [0, 2, 5][grade])
        draw.shuffle(words)
        rows.append((doc_id, grade, " ".join(words)))
    return rows


def test_gradient_is_that_of_the_likelihood():
    """The fitted model is better than its neighbours in every direction that is tried."""
    rows = made(random.Random(1), 200)
    features, labels = [toxicity.feature_list(t) for _, _, t in rows], np.array([g for _, g, _ in rows])
    model = toxicity.fit(features, labels, ridge=0.05, steps=2000)
    names = np.array(sorted(model.millionths))
    row, column = toxicity.matrix(features, names)

    def loss(weights, cuts):
        position = np.bincount(row, weights=weights[column], minlength=len(rows))
        above = np.c_[np.ones(len(rows)), toxicity.sigmoid(position[:, None] - cuts), np.zeros(len(rows))]
        share = above[np.arange(len(rows)), labels] - above[np.arange(len(rows)), labels + 1]
        return -np.log(share).mean() + 0.025 * (weights**2).sum()

    weights = np.array([model.millionths[n] for n in names.tolist()]) / 1e6
    least = loss(weights, model.thresholds)
    draw = np.random.default_rng(2)
    for _ in range(30):
        assert loss(weights + draw.normal(0, 0.02, len(weights)), model.thresholds) > least
        assert loss(weights, model.thresholds + draw.choice([-0.1, 0.1], 2)) > least


def test_grades_are_ordered():
    rows = made(random.Random(3), 1200)
    features, labels = [toxicity.feature_list(t) for _, _, t in rows], np.array([g for _, g, _ in rows])
    model = toxicity.fit(features[:900], labels[:900])
    assert (np.diff(model.thresholds) > 0).all()
    weights = toxicity.WordWeights(model)
    found = [toxicity.severity(model, weights, t) for _, _, t in rows[900:]]
    means = [np.mean([s for (s, _), g in zip(found, labels[900:]) if g == grade]) for grade in range(3)]
    assert means[0] < 0.3 < means[1] < means[2]
    assert np.mean([g == w for (_, g), w in zip(found, labels[900:])]) > 0.9


def test_defined_cases(spark):
    rows = [(k, g, t) for k, g, t in made(random.Random(5), 300)]
    texts = [(k, t, "a") for k, _, t in rows] + [(900, None, "a"), (901, "", "a"), (None, "vile nasty awful foul", "a"), (3, rows[3][2], "b")]
    docs = spark.createDataFrame(texts, "doc_id BIGINT, text STRING, severity STRING")
    flags = [(k, int(g > 0)) for k, g, _ in rows] + [(None, 1), (7, None), (5000, 1)]
    labels = spark.createDataFrame(flags, "doc_id BIGINT, toxic INT")
    model = toxicity.trained(docs, labels)
    found = toxicity.scored(docs, model).collect()
    assert len(found) == len(texts)
    by_id = {r.doc_id: r for r in found}
    assert by_id[900].severity == by_id[901].severity < 0.5 and by_id[None].toxic
    assert all(r.toxic == (r.severity >= 0.5) for r in found)
    left = toxicity.kept(docs, model)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r.doc_id) for r in found if not r.toxic)
    nothing = toxicity.trained(docs, labels.where("toxic = 0"))
    assert nothing is None and toxicity.trained(docs.limit(0), labels) is None
    assert {(r.severity, r.grade, r.toxic) for r in toxicity.scored(docs, nothing).collect()} == {(0.0, 0, False)}
    assert toxicity.kept(docs, nothing).count() == len(texts)
    assert toxicity.scored(docs.limit(0), model).collect() == []


def test_near_copies_count_once():
    rows = [toxicity.feature_list("one two three four five")] * 5 + [toxicity.feature_list("six seven eight nine")]
    assert len(toxicity.distinct_rows(rows, np.array([1, 1, 0, 1, 1, 1]))[0]) == 3


def test_held_out_rows(spark):
    """Fitted on two thirds of the labels, the query's operator finds the toxic documents of the rest."""
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.trained(docs, labels.where("doc_id % 3 <> 0"))
    known = labels.where("doc_id % 3 = 0").withColumnRenamed("toxic", "label")
    rest = toxicity.scored(docs, model).join(known, "doc_id").collect()
    assert np.mean([r.toxic for r in rest if r.label]) > 0.9
    assert np.mean([r.toxic for r in rest if not r.label]) < 0.01


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op2_toxicity(spark, folder).collect()
    flags = dict(duckdb.connect().execute(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    assert len(found) == 1000 and {type(r.doc_id) for r in found} == {int}
    assert np.mean([r.toxic for r in found if flags.get(r.doc_id) == 1]) > 0.8
    assert np.mean([r.toxic for r in found if flags.get(r.doc_id) == 0]) < 0.02


def test_ten_thousand_labelled_documents_are_learned_from(spark, monkeypatch):
    docs = spark.range(12_000).selectExpr("id AS doc_id", "concat('word', id) AS text")
    labels = spark.range(12_000).selectExpr("id AS doc_id", "CAST(id % 9 = 0 AS INT) AS toxic")
    monkeypatch.setattr(toxicity, "fit", lambda rows, labels: len(rows))
    assert toxicity.trained(docs, labels) == 10_000


def test_scores_equal_plain_sums(spark):
    """Every score of the query by hand: weights of all words and beginnings, then the chance of each grade."""
    import math
    import re
    import zlib

    folder = "/root/testdata/sf0.001"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.trained(docs, labels)
    found = toxicity.scored(docs, model).collect()
    texts = {}
    for row in docs.collect():
        texts.setdefault(row.doc_id, []).append(row.text)
    assert model is not None and len(found) == sum(map(len, texts.values()))
    for row in found:
        scores = []
        for text in texts[row.doc_id]:
            total = 0
            for word in set(re.findall(r"\w+", (text or "").lower())):
                for part in [word] + ["^" + word[:n] for n in (4, 5, 6, 7) if len(word) >= n]:
                    total += model.millionths.get(zlib.crc32(part.encode()) % (1 << 20), 0)
            above = [1 / (1 + math.exp(-(total / 1e6 - cut))) for cut in model.thresholds]
            shares = [a - b for a, b in zip([1.0, *above], [*above, 0.0])]
            scores.append((sum(above), shares.index(max(shares))))
        assert any(abs(row.severity - s) < 1e-9 and row.grade == g and row.toxic == (s >= 0.5) for s, g in scores)
