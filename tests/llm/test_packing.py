"""Every id lies in one piece, sequences have no gaps and no padding, and classes keep little."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lorebase.llm import packing, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def wanted_ids(text):
    return [*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0]


def check_sequences(rows, capacity=packing.CAPACITY):
    """Offsets without gaps; every sequence is full or a power of two long. The number of sequences that aren't full."""
    sequences = defaultdict(list)
    for row in rows:
        assert row.length > 0
        sequences[row.sequence_id].append((row.offset, row.length))
    short = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at == capacity or (at < capacity and at & (at - 1) == 0)
        short += at < capacity
    return short


@pytest.mark.parametrize("capacity", [1024, 64, 8, 1])
def test_packer(capacity):
    draw = random.Random(capacity)
    for lengths in ([], [1], [capacity], [capacity + 1] * 5, [draw.randrange(1, 3 * capacity + 2) for _ in range(900)], [1] * 2000):
        packer = packing.HarmonicPacker(capacity, 7)
        found, most = [], 0
        for key, length in enumerate(lengths):
            found += packer.add(key, np.arange(length) + 10_000 * key)
            most = max(most, sum(packer.held.values()))
        found += packer.close()
        assert most <= capacity * 2 * capacity**0.5
        documents, used = defaultdict(list), defaultdict(int)
        for key, start, length, total, sequence, offset, ids in found:
            assert total == lengths[key] and length == len(ids) and used[sequence] == offset
            documents[key].append((start, ids.tolist()))
            used[sequence] += length
        for key, length in enumerate(lengths):
            whole = [one for _, ids in sorted(documents[key]) for one in ids]
            assert whole == list(range(10_000 * key, 10_000 * key + length))
        assert sorted(used) == list(range(7, 7 + len(used)))
        assert all(size == capacity or size & (size - 1) == 0 for size in used.values())


def test_bins_of_a_class_hold_a_fixed_number():
    """Rests of 300 ids are of class 3: three whole ones and the head of a fourth, whose tail goes to a class of its own."""
    packer = packing.HarmonicPacker(1024, 0)
    found = [piece for key in range(4) for piece in packer.add(key, np.arange(300))]
    assert [(key, start, length) for key, start, length, *_ in found] == [(0, 0, 300), (1, 0, 300), (2, 0, 300), (3, 0, 124)]
    assert packer.held == {3: 0, 1024 // 176: 176}


def test_pieces(spark):
    draw = random.Random(3)
    texts = [None, "", "", "a", "a <|endoftext|> b", "word " * 5000, *(" ".join(["tree", "Ünï", "x1"] * draw.randrange(300)) for _ in range(200))]
    rows = [(key if key % 50 else None, text, "mine", 5) for key, text in enumerate(texts, 1)]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, ids STRING, start INT").repartition(3)
    found = packing.pack(df, PATH).collect()
    assert check_sequences(found) <= 3 * 10
    documents = defaultdict(list)
    for row in found:
        if row.doc_id is not None:
            documents[row.doc_id].append((row.start, row.length, row.doc_tokens, row.ids))
    for key, text, *_ in rows:
        if key is not None:
            whole, at = [], 0
            for start, length, total, ids in sorted(documents.pop(key)):
                assert (start, length, total) == (at, len(ids), len(wanted_ids(text)))
                whole, at = whole + ids, at + length
            assert whole == wanted_ids(text)
    assert not documents
    assert sum(row.length for row in found) == sum(len(wanted_ids(text)) for _, text, *_ in rows)
    assert packing.pack(df.limit(0), PATH).collect() == []


def test_rows_that_share_an_id(spark):
    df = spark.createDataFrame([(1, "a b c")] * 2000 + [(None, "d")] * 2000, "doc_id BIGINT, text STRING").repartition(4)
    found = packing.pack(df, PATH).collect()
    check_sequences(found)
    assert sum(r.length for r in found) == 2000 * (len(wanted_ids("a b c")) + len(wanted_ids("d")))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    found = queries.op12_packing(spark, folder).collect()
    check_sequences(found)
    documents = defaultdict(list)
    for row in found:
        documents[row.doc_id].append(row)
    rows = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(documents) == len(rows)
    for row in rows:
        ids, at = wanted_ids(row.text), 0
        for piece in sorted(documents[row.doc_id], key=lambda p: p.start):
            part = np.array(ids[at : at + piece.length], dtype="<u4")
            assert (piece.start, piece.doc_tokens, piece.ids_crc32) == (at, len(ids), zlib.crc32(part.tobytes()))
            at += piece.length
        assert at == len(ids)
