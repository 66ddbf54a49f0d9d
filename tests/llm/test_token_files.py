"""Ids equal the library's; files give back what was written; boundaries are found by select."""

import functools
import json
import random
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from lorebase.llm import queries, token_files

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def wanted_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@functools.cache
def made_once():
    with open(PATH, encoding="utf-8") as file:
        return token_files.TextEncoder(file.read(), 2)


@pytest.fixture
def encoder():
    return made_once()


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab'stré1. \n\t\0  \x85\x1c!<|>日😀́"))
def test_ids_of_any_text(text):
    encoder = made_once()
    assert np.frombuffer(encoder.encode(pa.array([text]))[0], "<u2").tolist() == wanted_ids(text)


def test_nothing_to_encode(encoder):
    assert encoder.encode(pa.array([], pa.string())) == []


def test_ids_of_odd_texts(encoder, monkeypatch):
    monkeypatch.setattr(token_files, "MEMO_WORDS", 50)
    texts = ["", " ", "a", " a", "a ", "it's don't 's", "x <|endoftext|> y z", "a<|endoftext|>b c", "a \0b c\0 d", "word " * 3000, "x" * 9000]
    for _ in range(2):
        for text, ids in zip(texts, encoder.encode(pa.array(texts))):
            assert np.frombuffer(ids, "<u2").tolist() == wanted_ids(text), text[:30]


def test_words_of_letters_signs_and_line_ends_are_cut_without_the_library(encoder, monkeypatch):
    """Only the first words go through the library's search for where to split; what an added token holds is left to it."""
    seen = []

    class Seen:
        model = LIBRARY.model

        def encode_batch_fast(self, texts, **options):
            seen.extend(texts)
            return LIBRARY.encode_batch_fast(texts, **options)

    text = "First word.\nWord été$$$ a,\nb;\nc! (word) word--word the|> it's\x1c a.\n\nb a.\x85 x_\ny ,\nz a<|endoftext|>.\nb\n"
    encoder.forget()
    monkeypatch.setattr(encoder, "library", Seen())
    assert np.frombuffer(encoder.encode(pa.array([text[:31]]))[0], "<u2").tolist() == wanted_ids(text[:31])
    assert seen == ["First"]
    assert np.frombuffer(encoder.encode(pa.array([text]))[0], "<u2").tolist() == wanted_ids(text)


def test_signs_of_added_tokens_are_not_cut():
    with open(PATH, encoding="utf-8") as file:
        definition = json.load(file)
    definition["added_tokens"].append(definition["added_tokens"][0] | {"id": 50257, "content": "d$$"})
    library = Tokenizer.from_str(json.dumps(definition))
    text = "a word$$$ word$$ d$$.\nword$$ word. word$"
    found = token_files.TextEncoder(json.dumps(definition), 2).encode(pa.array([text]))[0]
    assert np.frombuffer(found, "<u2").tolist() == library.encode(text, add_special_tokens=False).ids


def test_words_met_again_outlive_the_rare_ones(encoder, monkeypatch):
    encoder.forget()
    for text in ("a often rare", "a often other"):
        encoder.encode(pa.array([text]))
    monkeypatch.setattr(token_files, "MEMO_WORDS", 1)
    assert np.frombuffer(encoder.encode(pa.array(["a new"]))[0], "<u2").tolist() == wanted_ids("a new")
    assert encoder.spaced.keys() == {"a", "often", "new"}
    assert np.frombuffer(encoder.encode(pa.array(["new often a"]))[0], "<u2").tolist() == wanted_ids("new often a")


@pytest.mark.parametrize("count, top", [(0, 1), (1, 0), (1, 10**12), (1000, 50), (3000, 10**9), (2500, 2500)])
def test_elias_fano(count, top):
    values = np.sort(np.random.default_rng(4).integers(0, top + 1, count))
    packed = token_files.EliasFano.from_bytes(token_files.EliasFano.of(values).to_bytes())
    assert packed.values(0, count).tolist() == values.tolist()
    for place in random.Random(1).sample(range(count), min(count, 200)):
        assert packed.select(place) == values[place]
        assert packed.values(place, min(count, place + 7)).tolist() == values[place : place + 7].tolist()
    with pytest.raises(IndexError):
        packed.select(count)
    if count >= 1000:
        bits = 8 * len(token_files.EliasFano.of(values).to_bytes()) / count
        assert bits < 2.6 + max(0, np.log2(max(1, top) / count)) + 1


def test_files(spark, monkeypatch, tmp_path):
    draw = random.Random(2)
    rows = [(draw.randrange(-50, 10**12), "a b  c " * draw.randrange(9), 1) for _ in range(300)]
    rows += [(None, "no key", 1), (7, None, 2), (7, "x", 2), (7, "x", 2), (8, "", 2)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, start INT")
    monkeypatch.setattr(token_files, "FILE_DOCUMENTS", 20)
    listing = token_files.write(df, PATH, end_id=2)
    assert listing.count() > 4
    found = sorted(token_files.read(listing).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in found] == sorted((k for k, _, _ in rows), key=lambda k: (k is not None, k or 0))
    assert sorted(((r.doc_id, r.ids) for r in found), key=str) == sorted(((k, wanted_ids(t) + [2]) for k, t, _ in rows), key=str)
    assert [r.start for r in found] == [0, *np.cumsum([len(r.ids) for r in found])[:-1].tolist()]
    first = token_files.TokenFile(listing.orderBy("start").first().path)
    for number, (key, start, ids) in enumerate(first.rows()):
        assert first.key(number) == key and first.bounds(number) == (start, start + len(ids))
    assert token_files.read(token_files.write(df.limit(0), PATH, end_id=2)).collect() == []


def test_rows_equal_in_id_and_text_are_spread(spark):
    """A third of the rows are one document said again and again: no file holds them all, and the ids are right."""
    settings = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = [(7, "the same text")] * 3000 + [(None, "no key")] * 600 + [(100 + k, f"text {k}") for k in range(5400)]
        listing = token_files.write(spark.createDataFrame(rows, "doc_id BIGINT, text STRING").repartition(4), PATH, end_id=2)
        assert max(r.documents for r in listing.collect()) < 2 * 9000 / 8
        found = token_files.read(listing).collect()
        assert sorted((r.doc_id, r.ids) for r in found if r.doc_id is not None) == sorted((k, wanted_ids(t) + [2]) for k, t in rows if k is not None)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    start = 0
    found = {r.doc_id: r for r in queries.op8_token_files(spark, folder).collect()}
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    assert len(found) == len(rows)
    for row in rows:
        ids = np.array(wanted_ids(row.text) + [2], dtype="<u4")
        assert tuple(found[row.doc_id])[1:] == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
