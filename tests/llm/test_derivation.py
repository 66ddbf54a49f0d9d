"""Repairs equal the best of all edit strings on short conversations, and a plain table over turns on long ones."""

import hashlib
import random
import re
import zlib
from itertools import product

import pytest

from lorebase.llm import derivation, queries

LEGAL = re.compile(r"(s?(ua)+)?")
BLANK = re.compile(r"[\x20\x09-\x0D]*")


def plain_damage(rows):
    """Rows (conv, turn, role, text) after damage, by conversation, in their order."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        role, text = (" " if value is None else value for value in (role, text))
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        kept += [(turn, "user" if fate == 4 else role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    return {conv: ordered(kept) for conv, kept in out.items()}


def ordered(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def faults(rows):
    found, seen = [], set()
    for _, role, text in rows:
        last = text.rstrip(" \t\n\x0b\f\r")[-1:]
        found.append("blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last not in ".!?" else "")
        seen.add((role, text))
    return found


def best(rows, wrong):
    """(cost, audit, repaired lines): a table over (turns read, last initial), the least by (cost, audit)."""
    table = {"": (0, "", ())}
    expected = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def with_insertions(found):
        found = dict(found)
        for _ in range(4):
            for state, (cost, audit, lines) in list(found.items()):
                role = expected[state]
                new = (cost + 5, audit + "I", (*lines, f"{role}:"))
                found[role[0]] = min(found.get(role[0], new), new)
        return found

    table = with_insertions(table)
    for (_, role, text), fault in zip(rows, wrong):
        after = {}
        for state, (cost, audit, lines) in table.items():
            options = [(state, (cost + 2, audit + "D", lines))]
            if fault not in ("blank", "duplicate"):
                extra = 5 * (fault == "truncated")
                wanted = expected[state]
                options.append((wanted[0], (cost + 1 + extra, audit + "R", (*lines, f"{wanted}:{text}"))))
                if role[:1] == wanted[0] or (role[:1] == "s" and state == ""):
                    options.append((role[:1], (cost + extra, audit + "K", (*lines, f"{role}:{text}"))))
            for to, new in options:
                after[to] = min(after.get(to, new), new)
        table = with_insertions(after)
    return min(table[state] for state in ("", "a") if state in table)


def expected_row(rows):
    wrong = faults(rows)
    cost, audit, lines = best(rows, wrong)
    turns = [turn for turn, _, _ in rows if turn is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [role[:1] for _, role, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    counts = [wrong.count(fault) for fault in ("blank", "duplicate", "truncated")]
    return gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


CODES = [(initial, fault, 1) for initial in range(4) for fault in range(4)]


@pytest.mark.parametrize("length", [0, 1, 2, 3])
def test_agenda_finds_the_best_of_all_edit_strings(length):
    draw = random.Random(length)
    for codes in draw.sample(list(product(CODES, repeat=length)), min(40, len(CODES) ** length)):
        found = []
        for size in range(length, length + 4):
            for audit in map("".join, product("DIKR", repeat=size)):
                if sum(letter != "I" for letter in audit) != length:
                    continue
                costs, roles, turns, ok = 0, "", iter(codes), True
                for letter in audit:
                    nxt = "u" if not roles or roles[-1] in "sa" else "a"
                    if letter == "I":
                        costs, roles = costs + 5, roles + nxt
                        continue
                    initial, fault, _ = next(turns)
                    if letter == "D":
                        costs += 2
                        continue
                    ok = ok and fault in (derivation.FINE, derivation.TRUNCATED)
                    costs += 5 * (fault == derivation.TRUNCATED) + (letter == "R")
                    roles += nxt if letter == "R" else "?sua"[initial]
                if ok and LEGAL.fullmatch(roles):
                    found.append((costs, audit))
        assert list(derivation.finalised(tuple(codes), derivation.START, True).values()) == [min(found)]


def made(seed, conversations, longest):
    draw = random.Random(seed)
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "", "\t", "日本。", "Yes.", "a" * 40 + ".", "a" * 40 + "!", None]
    rows = []
    for conv in range(conversations):
        for turn in range(draw.randrange(longest)):
            role = draw.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None])
            turn = draw.choice([turn, turn, turn, turn + 3, 2, None])
            rows.append((None if conv == 3 else conv, turn, role, draw.choice(texts)))
    return rows + rows[:5] * 3


def check(found, rows):
    wanted = plain_damage(rows)
    assert sorted((r.conv_id for r in found), key=str) == sorted(wanted, key=str)
    for row in found:
        assert tuple(row)[1:9] == expected_row(wanted[row.conv_id]), row.conv_id


@pytest.mark.parametrize("block", [derivation.BLOCK, 3])
def test_repairs(spark, monkeypatch, block):
    monkeypatch.setattr(derivation, "BLOCK", block)
    rows = made(block, 60, 12)
    df = spark.createDataFrame([(*row, 1, "x") for row in rows], "conv_id INT, turn INT, role STRING, text STRING, cost INT, audit STRING")
    check(derivation.repairs(derivation.damaged(df), copies="copies").collect(), rows)
    empty = derivation.damaged(df.limit(0))
    assert derivation.repairs(empty, copies="copies").collect() == []


def test_a_hot_conversation(spark, monkeypatch):
    """A third of all rows in one conversation, many copies of one row, and one turn with many rows."""
    monkeypatch.setattr(derivation, "BLOCK", 16)
    draw = random.Random(4)
    rows = [(7, turn // 3, draw.choice(["user", "assistant"]), f"{draw.randrange(500)}" + draw.choice(["", ".", "!"])) for turn in range(700)]
    rows += [(7, 5, "user", "Yes.")] * 400 + [(8, 1, "user", f"{n}.") for n in range(300)] + made(1, 40, 9)
    df = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    check(derivation.repairs(derivation.damaged(df), copies="copies").collect(), rows)


def test_turns_of_a_repair(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "assistant", "Yes."), (1, 2, "assistant", "Yes."), (1, 3, "user", "cut"), (2, 1, "tool", " ")]
    found = derivation.repaired_turns(spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")).collect()
    one = sorted((r for r in found if r.conv_id == 1), key=lambda r: r.place)
    cost, audit, lines = best([r[1:] for r in rows[:4]], faults([r[1:] for r in rows[:4]]))
    assert "".join(r.edit for r in one) == audit and [r.place for r in one] == list(range(len(audit)))
    assert tuple(f"{r.repaired_role}:{r.text}" for r in one if r.repaired_role) == lines
    assert [(r.turn, r.role, r.text) for r in one if r.edit != "I"] == [r[1:] for r in rows[:4]]
    assert [tuple(r)[2:] for r in found if r.conv_id == 2] == [("D", 1, "tool", None, " ")]


def test_no_rows_left(spark):
    dropped = next(turn for turn in range(100) if zlib.crc32(f"9:{turn}".encode()) % 20 == 0)
    df = spark.createDataFrame([(9, dropped, "user", "Yes.")], "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    row = derivation.repairs(derivation.damaged(df), copies="copies").collect()[0]
    assert tuple(row) == (9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, folder):
    table = spark.read.parquet(f"{folder}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    check(queries.op13_conversation_repair(spark, folder).collect(), rows)
