"""The pipeline's rows equal those of the same steps in plain Python; every stage keeps what it should."""

import public_tokenizers
import sentencepiece
from test_decontaminate import least_distance, words_of
from test_neardup import brute_force

import __spark_entry__ as contract
import corpus_pipeline
from lorebase.llm import decontaminate, pieces, secrets, toxicity

FOLDER = "/root/testdata/sf0.001"
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def contaminated(text, items):
    words = words_of(text)
    for item in items:
        budget = decontaminate.budget(len(item))
        if item and any(tuple(item[a : a + n]) in grams(words, n) for a, n in decontaminate.pieces(len(item))):
            if least_distance(item, words) <= budget:
                return True
    return False


def grams(words, size):
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def test_run_equals_plain_steps(spark):
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "toxicity" and len(corpus_pipeline.STAGES) == 5
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    model = toxicity.trained(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    if model:
        weights = toxicity.WordWeights(model)
        rows = {k: r for k, r in rows.items() if toxicity.severity(model, weights, r.text)[0] < toxicity.REJECT}
    components = brute_force([(k, r.text) for k, r in rows.items()], 5)
    rows = {k: r for k, r in rows.items() if components[k][1] == k}
    items = [words_of(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = {k: r for k, r in rows.items() if not contaminated(r.text, items)}
    texts = {k: secrets.hidden(r.text, "[SECRET]") for k, r in rows.items()}
    found = {r.doc_id: r for r in contract.queries()["pipeline"](spark, FOLDER).collect()}
    assert 100 < len(found) < 200 and set(found) == set(texts)
    for key, row in found.items():
        assert row.text == texts[key] and row.lang == rows[key].lang and row.source == rows[key].source
        assert row.n_chars == (rows[key].n_chars if row.text == rows[key].text else len(row.text))
        assert row.ids == [1, *LIBRARY.encode(texts[key]), 2] and row.n_tokens == len(row.ids)
        assert row.round_trip == (LIBRARY.decode(row.ids) == row.text)


def test_stages_with_odd_rows(spark, tmp_path):
    item = " ".join(f"test{k}" for k in range(30))
    copy = " ".join(f"copy{k}" for k in range(80))
    rows = [(k, f"plain text number {k} " + " ".join(f"w{k}x{n}" for n in range(40)), "en", 1.5) for k in range(30)]
    rows += [(100, copy, None, None), (101, copy, "en", 1.5), (102, copy + " more", "en", 1.5), (100, copy, None, None)]
    rows += [(200, f"a {item} b", "en", 1.5), (None, item.upper(), "en", 1.5), (None, "kept without an id", "en", 1.5)]
    rows += [(300, None, None, None), (301, "", "de", 0.0), (302, "token = abcdefgh12345 here", "de", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, ids STRING, kept DOUBLE")
    spark.createDataFrame([], "doc_id BIGINT, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id BIGINT, text STRING").write.parquet(f"{tmp_path}/benchmark.parquet")
    empty = docs.limit(0)
    for place, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.columns
        docs, empty = stage(spark, docs, str(tmp_path)), stage(spark, empty, str(tmp_path))
        assert docs.columns[: len(before)] == before and (place == 4 or docs.columns == before)
        assert empty.collect() == []
    found = docs.collect()
    wanted = [*range(30), 100, 100, 300, 301, 302, None]
    assert sorted(map(str, (r.doc_id for r in found))) == sorted(map(str, wanted))
    texts = {r.doc_id: r.text for r in found}
    assert texts[302] == "token = [SECRET] here" and texts[300] is None and texts[None] == "kept without an id"
    by_id = {r.doc_id: r for r in found}
    assert by_id[300]["_ids"] == by_id[301]["_ids"] == [1, 2] and by_id[100].ids is None


def test_tokenised_in_small_runs(spark, monkeypatch):
    monkeypatch.setattr(pieces, "ROUND_CHARS", 20)
    texts = ["a text of some words", "", None, "x", "more words than before are here"]
    docs = spark.createDataFrame([(t,) for t in texts], "text STRING")
    found = [r.ids for r in pieces.tokenised(docs, corpus_pipeline.MODEL).collect()]
    assert sorted(found) == sorted([1, *LIBRARY.encode(t or ""), 2] for t in texts)
