"""Repairs cost what the cheapest one does; the rendering is legal and keeps every text."""

import heapq
import random
import re

import pytest
from conftest import plan

from lorebase.llm import chat, queries

NEXT = {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}


def cheapest(roles):
    """Shortest way through (turns read, last role), by Dijkstra's algorithm."""
    queue, done = [(0, 0, "")], set()
    while queue:
        cost, read, last = heapq.heappop(queue)
        if (read, last) in done:
            continue
        done.add((read, last))
        if read == len(roles) and last == "assistant":
            return cost
        for role in NEXT[last or None]:
            heapq.heappush(queue, (cost + chat.INSERT, read, role))
            if read < len(roles):
                heapq.heappush(queue, (cost + chat.RELABEL * (role != roles[read]), read + 1, role))
        if last and read < len(roles):
            heapq.heappush(queue, (cost + chat.MERGE + chat.RELABEL * (last != roles[read]), read + 1, last))


def glued(rows):
    ordered = sorted(rows, key=lambda r: (r.block is not None, r.block or 0, r.place))
    return ordered, "".join(r.piece for r in ordered)


def check(rows, found):
    """`rows`: distinct (turn, role, text) of a conversation in their order."""
    ordered, text = glued(found)
    assert [(r.turn, r.role) for r in ordered] == [(turn, role) for turn, role, _ in rows]
    assert sum(r.cost for r in ordered) == cheapest([role for _, role, _ in rows])
    turns = re.findall(r"<\|im_start\|>(\w+)\n(.*?)<\|im_end\|>\n", text, re.DOTALL)
    assert "".join(f"<|im_start|>{role}\n{body}<|im_end|>\n" for role, body in turns) == text
    last = None
    for role, _ in turns:
        assert role in NEXT[last]
        last = role
    assert last == "assistant"
    assert [t for t in re.split(r"\n", "\n".join(body for _, body in turns)) if t] == [t for _, _, t in rows if t]
    inserted = sum(r.inserted for r in ordered)
    merged = sum(r.action == "merge" for r in ordered)
    assert len(turns) == len(rows) + inserted - merged


@pytest.mark.parametrize("block, group", [(chat.BLOCK, chat.GROUP), (3, 2)])
def test_repairs(spark, monkeypatch, block, group):
    monkeypatch.setattr(chat, "BLOCK", block)
    monkeypatch.setattr(chat, "GROUP", group)
    draw = random.Random(block)
    names = ["system", "user", "assistant", "tool", None]
    conversations = {}
    for conv in range(60):
        size = draw.choice([1, 2, 3, 5, 8, 30, 60])
        conversations[conv] = [(turn, draw.choice(names[: draw.choice([3, 5])]), f"t{conv}x{turn}") for turn in range(size)]
    conversations[100] = [(turn, ("user", "assistant")[turn % 2], f"long{turn}") for turn in range(700)]
    rows = [(c, t, r, x, 1) for c, turns in conversations.items() for t, r, x in turns]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING, block INT")
    found = {}
    for row in chat.repaired(df).collect():
        found.setdefault(row.conv_id, []).append(row)
    assert set(found) == set(conversations)
    for conv, turns in conversations.items():
        check(turns, found[conv])
    assert {r.action for r in found[100]} == {"keep"}


def test_known_repairs(spark):
    made = {1: ["user", "user"], 2: ["assistant"], 3: ["system"], 4: ["user", "assistant", "assistant"], 5: ["user", "system", "assistant"]}
    rows = [(c, t, r, f"{c}{t}") for c, roles in made.items() for t, r in enumerate(roles)]
    found = {}
    for row in chat.repaired(spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")).collect():
        found.setdefault(row.conv_id, []).append(row)
    texts = {conv: glued(rows)[1] for conv, rows in found.items()}
    u, a, s, end = "<|im_start|>user\n", "<|im_start|>assistant\n", "<|im_start|>system\n", "<|im_end|>\n"
    assert texts[1] == f"{u}10\n11{end}{a}{end}"
    assert texts[2] == f"{u}{end}{a}20{end}"
    assert texts[3] == f"{s}30{end}{u}{end}{a}{end}"
    assert texts[4] == f"{u}40{end}{a}41\n42{end}"


@pytest.mark.parametrize("block", [chat.BLOCK, 2])
def test_defined_cases(spark, monkeypatch, block):
    monkeypatch.setattr(chat, "BLOCK", block)
    rows = [(1, 5, "user", "a")] * 3 + [(1, 5, "user", "b"), (1, 5, "assistant", "c"), (1, None, "user", "first"), (1, -7, "user", None)]
    rows += [(None, 1, None, None), (None, 2, "", "")] + [(2, 9, "user", f"tie{k}") for k in range(7)]
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    found = {}
    for row in chat.repaired(df).collect():
        found.setdefault(row.conv_id, []).append(row)
    ordered, text = glued(found[1])
    assert [(r.turn, r.role) for r in ordered] == [(None, "user"), (-7, "user"), (5, "user"), (5, "user"), (5, "assistant")]
    assert sorted(r.copies for r in ordered) == [1, 1, 1, 1, 3] and sum(r.cost for r in ordered) == 3 * chat.MERGE
    assert "first\n\n" in text
    assert sum(r.cost for r in found[None]) == cheapest([None, ""])
    assert len(found[2]) == 7 and sum(r.cost for r in found[2]) == 6 * chat.MERGE + chat.INSERT
    assert chat.repaired(df.limit(0)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    result = queries.op3_chat(spark, folder)
    found = {}
    for row in result.collect():
        found.setdefault(row.conv_id, []).append(row)
    by_conv = {}
    for row in sorted(set(rows), key=lambda r: (r.conv_id, r.turn, chat.ROLES.index(r.role))):
        by_conv.setdefault(row.conv_id, []).append((row.turn, row.role, row.text))
    assert {c: len(r) for c, r in found.items()} == {c: len(r) for c, r in by_conv.items()}
    assert sum(r.copies for group in found.values() for r in group) == len(rows)
    for conv, group in found.items():
        assert sum(r.cost for r in group) == cheapest([role for _, role, _ in by_conv[conv]])
    assert "CartesianProduct" not in plan(result, "simple")
