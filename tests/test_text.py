import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lorebase.functions import text


@pytest.fixture(scope="module")
def texts(spark):
    dice = random.Random(3)
    alphabet = "ab é𝄞.!?\n "
    made = ["", "x", "no end", "One. Two.", "." * 1201, "a" * 1201, "a\nb\r\n"]
    made += ["".join(dice.choice(alphabet) for _ in range(dice.randrange(1, 900))) for _ in range(40)]
    return spark.createDataFrame(list(enumerate(made)), "id BIGINT, t STRING").cache()


def by_id(chunks):
    found = {}
    for row in chunks.collect():
        found.setdefault(row.id, []).append((row.chunk_no, row.chunk))
    return {k: [c for _, c in sorted(v)] for k, v in found.items()}


@pytest.mark.parametrize("size,overlap", [(500, 100), (50, 0), (10, 7), (7, 3)])
def test_fixed_chunks(texts, size, overlap):
    found = by_id(text.fixed_chunks(texts, "t", size, overlap))
    step = size - overlap
    for row in texts.collect():
        n = max(1, -(-(len(row.t) - overlap) // step)) if row.t else 0
        assert found.get(row.id, []) == [row.t[i * step : i * step + size] for i in range(n)]


def test_fixed_chunks_of_equal_copies_and_bad_sizes(spark, texts):
    with pytest.raises(ValueError):
        text.fixed_chunks(texts, "t", 100, 100)


@pytest.mark.parametrize("size", [500, 20])
def test_packed_chunks(texts, size):
    found = by_id(text.packed_chunks(texts, "t", size))
    for row in texts.collect():
        chunks = found.get(row.id, [])
        assert "".join(chunks) == row.t
        assert all(0 < len(c) <= size for c in chunks)
        for chunk, after in zip(chunks, chunks[1:]):
            assert chunk[-1] in ".!?\n" or len(chunk) == size
            assert len(chunk) + len(after) > size or after is chunks[-1] or after[-1] in ".!?\n"


def test_semantic_chunks(spark, texts):
    df = spark.createDataFrame([(1, "The red ring. A red ring! Blue sky? Blue sky\nand sea. ... tail")], "id BIGINT, t STRING")
    assert by_id(text.semantic_chunks(df, "t", 0.3)) == {
        1: ["The red ring. A red ring!", " Blue sky? Blue sky\n", "and sea.", " ...", " tail"]
    }
    found = by_id(text.semantic_chunks(texts, "t"))
    assert all("".join(found.get(r.id, [])) == r.t for r in texts.collect())


def test_chunkers_stay_in_the_row(texts):
    for chunks in (text.fixed_chunks(texts, "t"), text.packed_chunks(texts, "t"), text.semantic_chunks(texts, "t")):
        shown = plan(chunks, "simple")
        assert "Exchange" not in shown and "Python" not in shown


def test_scalars(spark):
    df = spark.createDataFrame([("\t x\n ", "/v/a.pdf.pdf"), (None, "a.pdf")], "t STRING, p STRING")
    made = df.select(text.strip(F.col("t")).alias("s"), text.document_key(F.col("p"), ".pdf").alias("k"))
    assert rows(made) == [("x", "a"), (None, "a")]
    shown = spark.range(1).select(text.preview(F.lit("é" * 600)).alias("p"), text.preview(F.lit("ab")).alias("q")).first()
    assert shown.p == "é" * 500 + "..." and shown.q == "ab..."
    assert spark.range(1).select(text.tokens(F.lit("Hé, 2 x-Y_z!")).alias("t")).first().t == ["hé", "2", "x", "y", "z"]


def test_strip_removes_unicode_white_space(spark):
    texts = ["\u00a0a\u3000", "\u2028a b\u2028\n", "\x1ca\x1f", "\u200ba", " \t\n\x0b\x0c\r\x85"]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    assert [r.s for r in df.select(text.strip(F.col("t")).alias("s")).collect()] == [t.strip() for t in texts]
