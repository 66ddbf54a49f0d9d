"""Passages equal those found by comparing every item with every stretch of every document."""

import random
import re

import numpy as np
import pytest

from lorebase.llm import decontaminate, queries


def least_distance(item, text):
    """Smallest edit distance between the item and any stretch of the text, by the textbook table."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        before, row = row, [i] + [0] * len(text)
        for j, other in enumerate(text, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (word != other))
    return min(row)


def words_of(text):
    return [w.lower() for w in re.findall(r"\w+", text or "")]


def edited(words, edits, draw):
    words = list(words)
    for _ in range(edits):
        place = draw.randrange(len(words))
        kind = draw.randrange(3)
        if kind == 0:
            words[place] = "zz"
        elif kind == 1:
            words.insert(place, "yy")
        elif len(words) > 1:
            del words[place]
    return words


def test_distances_equal_the_table():
    draw = random.Random(1)
    for _ in range(300):
        item = [draw.randrange(4) for _ in range(draw.randint(1, 90))]
        text = [draw.randrange(4) for _ in range(draw.randint(1, 60))]
        assert min([len(item), *decontaminate.Pattern(item).distances(text)]) == least_distance(item, text)


def test_pieces_cover_items():
    for size in range(1, 200):
        parts = decontaminate.pieces(size)
        assert sum(length for _, length in parts) == size and len(parts) == decontaminate.budget(size) + 1
        assert min(length for _, length in parts) >= min(size, 4)


@pytest.mark.parametrize("block_chars", [decontaminate.BLOCK_CHARS, 400])
def test_passages(spark, block_chars):
    draw = random.Random(6)
    vocabulary = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(draw.choices(vocabulary, k=draw.randint(1, 60)))) for k in range(25)]
    items += [(90, None), (91, "..."), (92, items[3][1]), (None, items[4][1].upper())]
    docs = []
    for k in range(120):
        words = draw.choices(vocabulary, k=draw.randint(0, 80))
        if k % 2:
            item = words_of(draw.choice(items[:25])[1])
            place = draw.randint(0, len(words))
            words[place:place] = edited(item, draw.randint(0, len(item) // 4 + 1), draw)
        docs.append((k, draw.choice([" ", ", ", "\n"]).join(words), "x"))
    docs += [(200, None, "x"), (201, "", "x"), (1, items[7][1] + " " + items[7][1], "x"), (None, items[8][1], "x")]
    found = decontaminate.passages(
        spark.createDataFrame(docs, "doc_id BIGINT, text STRING, item_id STRING"),
        spark.createDataFrame(items, "item_id BIGINT, text STRING"),
        block_chars=block_chars,
    ).collect()
    wanted = set()
    for doc_id, text, _ in docs:
        for item_id, item in items:
            size = len(words_of(item))
            if size and text and least_distance(words_of(item), words_of(text)) <= decontaminate.budget(size):
                wanted.add((doc_id, item_id))
    assert {(r.doc_id, r.item_id) for r in found} == wanted
    texts = {(k, i): (t, x) for k, t, _ in docs for i, x in items}
    for row in found:
        if row.doc_id != 1 and row.doc_id is not None:
            text, item = texts[row.doc_id, row.item_id]
            span = words_of(text[row.start : row.end])
            assert least_distance(words_of(item), span) <= row.distance <= decontaminate.budget(row.n_words)
    assert sum(r.doc_id == 1 and r.item_id == 7 for r in found) >= 2


def test_a_repeated_passage_is_one_stretch():
    words = [f"w{k}" for k in range(20)]
    items = decontaminate.Items([(1, " ".join(words))])
    ids = np.array([items.vocabulary[w] for w in words] * 500, dtype=np.uint64)
    assert [len(s) for s in items.hits(ids).values()] == [1]
    assert len(list(items.matches(ids))) == 500


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id BIGINT, text STRING")
    items = spark.createDataFrame([(1, "a b c")], "item_id BIGINT, text STRING")
    assert decontaminate.passages(docs.limit(0), items).collect() == []
    assert decontaminate.passages(docs, items.limit(0)).collect() == []
    assert [tuple(r) for r in decontaminate.passages(docs, items).collect()] == [(1, 1, 0, 3, 0, 5)]


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    found = {(r.doc_id, r.item_id) for r in queries.op6_decontaminate(spark, folder).collect()}
    whole = {(d.doc_id, i.item_id) for d in docs for i in items if i.text.lower() in (d.text or "").lower()}
    assert whole and whole <= found
    for doc_id, item_id in found - whole:
        text, item = (next(r.text for r in t if r[0] == k) for t, k in ((docs, doc_id), (items, item_id)))
        assert least_distance(words_of(item), words_of(text)) <= decontaminate.budget(len(words_of(item)))


def test_scripts_without_blanks(spark):
    item = "机器学习模型的评测集不应该出现在训练语料之中否则结果没有意义"
    changed = item[:15] + "坏" + item[16:]
    docs = [(1, f"前面的文字{item}后面的文字"), (2, f"前面{changed}后面"), (3, "完全不同的一段中文文字没有任何相同之处"), (4, "mixed 日本 words " + item[:10])]
    found = decontaminate.passages(
        spark.createDataFrame(docs, "doc_id BIGINT, text STRING"), spark.createDataFrame([(7, item)], "item_id BIGINT, text STRING")
    ).collect()
    assert sorted((r.doc_id, r.item_id, r.distance) for r in found) == [(1, 7, 0), (2, 7, 1)]
    assert next(docs[0][1][r.start : r.end] for r in found if r.doc_id == 1) == item
    assert decontaminate.WORD.findall("ab日本c ไทย é_1") == ["ab", "日", "本", "c", "ไ", "ท", "ย", "é_1"]


def test_items_that_share_a_text(spark):
    """A third of the items have one text: it is looked for once, in one block, and reported for each."""
    text = "one two three four five six seven eight"
    items = [(k, text) for k in range(300)] + [(300, "nine ten eleven twelve")] * 2
    docs = spark.createDataFrame([(1, f"x {text} y"), (2, "nine ten eleven twelve")], "doc_id BIGINT, text STRING")
    found = decontaminate.passages(docs, spark.createDataFrame(items, "item_id BIGINT, text STRING"), block_chars=30).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, k) for k in range(300)] + [(2, 300)] * 2


def test_null_and_hot_texts_stay_or_go(spark):
    docs = spark.createDataFrame([(k, None) for k in range(50)] + [(k, "a b c d e") for k in range(50)] + [(99, "other")], "doc_id BIGINT, text STRING")
    kept = decontaminate.without_passages(docs, spark.createDataFrame([(1, "b c d")], "item_id BIGINT, text STRING"))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(k, None) for k in range(50)] + [(99, "other")])
