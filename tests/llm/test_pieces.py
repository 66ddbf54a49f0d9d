"""Encoding and decoding equal the library's for every kind of text."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from lorebase.llm import pieces, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def made_texts():
    draw = random.Random(7)
    odd = ["", " ", "   ", "a  b   c", "\n\n", "▁x ▁", "日本語のテキスト😀é", "a" * 5000, "ab" * 3000, "<s></s><unk><0x0A>", "\x00\x01"]
    odd += ["".join(draw.choice("etaoin shrdlu.,'\nABC") for _ in range(draw.randint(1, 300))) for _ in range(300)]
    odd += ["".join(draw.choice("abn") for _ in range(60)) for _ in range(300)]
    odd.append("".join(draw.choice("abcdefghij") for _ in range(20_000)))
    return odd


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


def test_ids_and_texts_equal_the_library(model):
    texts = made_texts()
    for text, ids, wanted in zip(texts, pieces.Encoder(model).encode(texts), LIBRARY.encode(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == wanted, text[:40]
        assert pieces.decode_ids(model, np.array([1, *wanted, 2])) == LIBRARY.decode([1, *wanted, 2])


def test_one_pair_a_round_gives_the_same(model):
    encoder = pieces.Encoder(model)
    for text in made_texts()[11:200]:
        points = np.frombuffer(("▁" + text.replace(" ", "▁")).encode("utf-32-le"), "<u4").astype(np.int64)
        word = np.zeros(len(points), dtype=np.int64)
        at_once, _ = encoder.merge(encoder.single[points], word)
        in_order, _ = encoder.merge(encoder.single[points], word, single=True)
        assert at_once.tolist() == in_order.tolist()


def test_long_texts_are_cut_where_no_piece_reaches_across(model, monkeypatch):
    monkeypatch.setattr(pieces, "ROUND_CHARS", 50)
    texts = ["one two  three   four\nfive " * 40, "x" * 400, " " * 300]
    encoded = pieces.Encoder(model).encode(texts)
    assert [np.frombuffer(ids, "<i4").tolist() for ids in encoded] == LIBRARY.encode(texts)


def test_a_full_memo_changes_nothing(model, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO_WORDS", 3)
    encoder = pieces.Encoder(model)
    for text in made_texts()[:40]:
        assert np.frombuffer(encoder.encode([text])[0], "<i4").tolist() == LIBRARY.encode(text)


def test_decoding_any_ids(model):
    draw = random.Random(5)
    for _ in range(500):
        ids = [draw.randrange(32_000) if draw.random() < 0.6 else draw.randrange(3, 259) for _ in range(20)]
        assert pieces.decode_ids(model, np.array(ids)) == LIBRARY.decode(ids)
    assert pieces.decode_ids(model, np.array([], dtype=np.int64)) == ""
    with pytest.raises(ValueError):
        pieces.decode_ids(model, np.array([32_000]))


def test_tables(spark):
    rows = [(1, "some text", 5), (1, "some text", 6), (None, "no key", 7), (2, None, 8), (3, "", 9)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, ids INT")
    encoded = pieces.encode(df, PATH)
    found = sorted((r.doc_id is None, r.doc_id or 0, r.ids) for r in encoded.collect())
    wanted = sorted((k is None, k or 0, [1, *LIBRARY.encode(t or ""), 2]) for k, t, _ in rows)
    assert found == wanted
    decoded = {(r.doc_id, r.decoded) for r in pieces.decode(encoded, PATH).collect()}
    assert decoded == {(k, t or "") for k, t, _ in rows}
    assert pieces.encode(df.limit(0), PATH).collect() == []
    nulls = spark.createDataFrame([(1, None)], "doc_id BIGINT, ids ARRAY<INT>")
    assert pieces.decode(nulls, PATH).first().decoded == ""


def test_query(spark):
    import hashlib

    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op1_sentencepiece(spark, folder).collect()
    assert len(found) == len(texts)
    for row in found:
        ids = [1, *LIBRARY.encode(texts[row.doc_id]), 2]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest()
