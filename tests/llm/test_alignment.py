"""Groups, links and counts equal a plain merge of the libraries' tokens."""

import hashlib
import json
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from lorebase.llm import alignment, queries
from lorebase.llm.token_files import BYTE_LETTERS

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A, B = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
A.encode_special_tokens = True
LETTERS = {letter: byte for byte, letter in BYTE_LETTERS.items()}


def bytes_a(number):
    return bytes(map(LETTERS.__getitem__, A.id_to_token(number)))


def bytes_b(number):
    piece = B.id_to_piece(number)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(number) else piece.replace("▁", " ").encode()


def plain(text):
    """(tokens of A, of B, groups, links) of a text; links as id pairs."""
    if not text:
        return [], [], [], []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    if b"".join(map(bytes_a, a)) != (" " + text).encode() or b"".join(map(bytes_b, b)) != (" " + text).encode():
        return [], [], [], []

    def ranges(ids, surface):
        at = 0
        for number in ids:
            yield number, at, (at := at + len(surface(number)))

    left, right = list(ranges(a, bytes_a)), list(ranges(b, bytes_b))
    links, first = [], 0
    for number, start, end in left:
        while right[first][2] <= start:
            first += 1
        place = first
        while place < len(right) and right[place][1] < end:
            links.append((number, right[place][0]))
            place += 1
    ends = sorted({end for _, _, end in left} & {end for _, _, end in right})
    groups = [
        [",".join(str(n) for n, start, end in side if low <= start and end <= high) for side in (left, right)]
        for low, high in zip([0, *ends], ends)
    ]
    return a, b, groups, links


def expected(texts):
    found = [plain(text) for text in texts]
    docs = Counter(pair for *_, links in found for pair in set(links))
    highest = {}
    for (a, _), count in docs.items():
        highest[a] = max(highest.get(a, 0), count)
    for a, b, groups, links in found:
        text = ";".join("|".join(group) for group in groups)
        best = sum(docs[pair] == highest[pair[0]] for pair in links)
        yield len(a), len(b), len(groups), len(links), best, sum(docs[pair] for pair in links), text


ODD = [
    None, "", " ", "a", " a", "a ", "a  b", "  ", "it's don't", "<|endoftext|> <s> </s><unk> <0x41>", "x<|endoftext|>y", "a▁b", "▁",
    "tab\tand\nline \n next", "日本語のテキスト、です。", "Ünïcödé naïve 😀😀 é", "\0 a\0b", "word " * 700, "x" * 3000, "a b　c", "\r\n\r\n  x", "1234567 12,5",
]


def table(found):
    return sorted((r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups) for r in found)


def made(seed, number):
    draw = random.Random(seed)
    words = ["the", "antidisestablishment", "Straße", "naïve,", "don't", "x1", "日本", "\n", "", "(see", "foo.bar", "2024-01-02", "ééé", "▁"]
    return [" ".join(draw.choices(words, k=draw.randrange(60))) for _ in range(number)]


@pytest.mark.parametrize("strip, size", [(alignment.STRIP, alignment.BATCH_BYTES), (3, 200)])
def test_alignment(spark, monkeypatch, strip, size):
    monkeypatch.setattr(alignment, "STRIP", strip)
    monkeypatch.setattr(alignment, "BATCH_BYTES", size)
    texts = [*ODD, *ODD[3:6], *made(strip, 150)]
    df = spark.createDataFrame([(n % 7 or None, t, "x", 1) for n, t in enumerate(texts)], "doc_id INT, text STRING, pairs STRING, n_a INT")
    found = alignment.alignment(df.repartition(3), A_PATH, B_PATH).collect()
    assert table(found) == sorted(expected(texts))


def test_counts_in_many_files(spark, monkeypatch):
    """Counts that a worker doesn't hold pass by file for file; tasks hand on counts early."""
    for name, value in (("TABLE_ROWS", 50), ("HELD_ROWS", 10), ("TASK_PAIRS", 20), ("LOOK_UP", 30)):
        monkeypatch.setattr(alignment, name, value)
    texts = [*ODD, *made(9, 60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id BIGINT, text STRING")
    assert table(alignment.alignment(df, A_PATH, B_PATH).collect()) == sorted(expected(texts))


def test_no_documents(spark):
    df = spark.createDataFrame([], "doc_id BIGINT, text STRING")
    assert alignment.alignment(df, A_PATH, B_PATH).collect() == []
    nothing = alignment.alignment(spark.createDataFrame([(1, None), (2, "")], df.schema), A_PATH, B_PATH)
    assert table(nothing.collect()) == [(0, 0, 0, 0, 0, 0, "")] * 2


def test_digits():
    rows = alignment.digits(32000)
    for number in (0, 1, 9, 10, 99, 100, 1005, 32000):
        assert bytes(rows[number][rows[number] != 0]) == str(number).encode()


def test_other_vocabularies_keep_their_ids():
    with open(A_PATH, encoding="utf-8") as file:
        definition = json.load(file)
    surfaces = alignment.Tokenizers(A_PATH, B_PATH).surfaces
    draw = np.random.default_rng(0)
    for number in draw.integers(0, len(definition["model"]["vocab"]) - 1, 200).tolist():
        assert bytes(surfaces[0].joined(np.array([number]))) == bytes_a(number)
    for number in draw.integers(3, B.vocab_size(), 200).tolist():
        assert bytes(surfaces[1].joined(np.array([number]))) == bytes_b(number)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").orderBy("doc_id").collect()
    found = queries.op11_alignment(spark, folder).orderBy("doc_id").collect()
    assert [r.doc_id for r in found] == [r.doc_id for r in rows]
    for row, want in zip(found, expected([r.text for r in rows])):
        digest = hashlib.sha256(want[6].encode()).hexdigest() if want[6] else ""
        assert (row.n_a, row.n_b, row.n_groups, row.n_links, row.n_best, row.count_sum, row.groups_sha256) == (*want[:6], digest)
