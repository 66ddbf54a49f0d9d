"""Conversation structure repair: Knuth's lightest derivation over edits of turns.

Method: a repaired conversation is empty, or an optional system turn and then user and assistant turns in alternation, user first,
assistant last. Items of the deduction system are `(i, q)`: the first i turns are read and the repaired ones end in state q. From
an item lead the edits Keep, Rerole, Delete (they read a turn) and Insert (it doesn't). The weight of an item is the pair (cost,
audit), audit being the initials of the edits so far; an edit adds to both. Such functions are superior (a result isn't below
its antecedent) and monotone (two derivations of one item of equal cost are never a prefix of each other, as each further letter on
the same turns is a paid insertion), so an agenda that pops the lightest item first finalises every item at once with its least cost
and, among equals, its ASCII-least audit, until the goal is popped.

A conversation of any length: rows equal in conversation, turn, role and text are one row with a number of copies, and a run
of rows that must be deleted is one hyperedge. The rows (without texts) are dealt by range of (conversation, turn, role, text), so
a hot conversation goes to many tasks; each task reads its sorted rows in stretches of at most BLOCK. A stretch that isn't a whole
conversation yields the lightest derivation from every state to every other; these are hyperedges with two antecedents (what came before,
the stretch), and a second agenda finalises the borders of a conversation stretch by stretch. What all its states have in common of their
audits is put aside, so the comparison sees only where they differ. At the end the texts meet the audit in their order and stream
past it: the audit of a conversation is held, its texts never are. A digest over a conversation is sequential, so its texts stream through
one task.

Cases: null roles and texts count as one space; a null turn comes first; rows of one turn are ordered by role and then text (its first 32
characters, then its digest); repeated rows are duplicates; rows with a null conversation id are one conversation; a row with 0 copies
only names its conversation, and a conversation without rows has zeros, an empty audit and the digest of the empty string; other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import chain, groupby, islice
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import Batches, Written, in_batches, map_batches, rows_of

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The role that must come next, by state; a system turn may only be kept, as the first one.
EXPECTED = (USER, USER, ASSISTANT, USER)
GOALS = (START, ASSISTANT)
INITIALS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
REROLE, DELETE, INSERT, UNFINISHED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\f\r"
#: Rows of a stretch; runs up to which the repair of a whole conversation is remembered, and how many are.
BLOCK, SHORT, MEMO = 1024, 64, 1 << 14

#: A run of turns: (initial as a state, 0 for any other one; fault; how many).
Code = tuple[int, int, int]
Weight = tuple[int, str]


def finalised(codes: tuple[Code, ...], start: int, to_goal: bool = False) -> dict[int, Weight]:
    """The lightest derivations from state `start` over all turns, by the state they end in; with `to_goal` only the first goal."""
    end, done, agenda = len(codes), set(), [(0, "", 0, start)]
    found: dict[int, Weight] = {}
    while agenda:
        cost, audit, read, state = heappop(agenda)
        if (read, state) in done:
            continue
        done.add((read, state))
        if read == end:
            if not to_goal or state in GOALS:
                found[state] = (cost, audit)
            if to_goal and found or len(found) == 4:
                break
        following = EXPECTED[state]
        if (read, following) not in done:
            heappush(agenda, (cost + INSERT, audit + "I", read, following))
        if read < end:
            initial, fault, times = codes[read]
            heappush(agenda, (cost + DELETE * times, audit + "D" * times, read + 1, state))
            if fault in (FINE, TRUNCATED):
                paid = cost + (UNFINISHED if fault == TRUNCATED else 0)
                if initial == following or (initial == SYSTEM and state == START):
                    heappush(agenda, (paid, audit + "K", read + 1, initial))
                heappush(agenda, (paid + REROLE, audit + "R", read + 1, following))
    return found


def expanded(initial: int, fault: int, copies: int) -> Iterator[Code]:
    """A row and its copies as runs: every copy of a row is a duplicate, unless it is blank."""
    if fault in (BLANK, DUPLICATE):
        yield initial, fault, copies
        return
    yield initial, fault, 1
    if copies > 1:
        yield initial, DUPLICATE, copies - 1


STRETCH = (
    "conv BIGINT, part INT, number BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, opening INT, closing INT, "
    "froms ARRAY<INT>, states ARRAY<INT>, costs ARRAY<BIGINT>, audits ARRAY<STRING>"
)
SUMMARY = "conv BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, cost BIGINT, audit STRING"
ARROW = {"BIGINT": pa.int64(), "INT": pa.int32(), "STRING": pa.string()}


def arrow_schema(fields: str) -> pa.Schema:
    def kind(name: str) -> pa.DataType:
        return pa.list_(kind(name[6:-1])) if name.startswith("ARRAY<") else ARROW[name]

    return pa.schema([(name, kind(sort)) for name, sort in (field.split() for field in fields.split(", "))])


def mapped(df: DataFrame, fields: str, rows) -> DataFrame:
    """`df` through a generator of tuples over its batches."""
    schema = arrow_schema(fields)
    return map_batches(df, fields, lambda batches: in_batches(rows(batches), schema))


def pieces_of(rows: Iterator, size: int) -> Iterator[list]:
    while some := list(islice(rows, size)):
        yield some


def stretch(codes: list[Code], whole: bool, memo: dict) -> tuple:
    """Counts, border roles and lightest derivations of a stretch; of a whole conversation only the goal's.

    Short conversations of the same roles and faults are repaired once (`memo`).
    """
    counts = [sum(times for _, fault, times in codes if fault == one) for one in (BLANK, DUPLICATE, TRUNCATED)]
    # Neighbours of the same role are never legal, so a run has one illegal pair less than turns.
    illegal = sum(times - 1 for _, _, times in codes)
    illegal += sum((a[0], b[0]) not in LEGAL for a, b in zip(codes, codes[1:]))
    if whole:
        key = tuple(codes)
        if (lightest := memo.get(key)) is None:
            lightest = finalised(key, START, True)
            if len(key) <= SHORT and len(memo) < MEMO:
                memo[key] = lightest
        ways = [(START, to, *weight) for to, weight in lightest.items()]
    else:
        ways = [(state, to, *weight) for state in range(4) for to, weight in finalised(tuple(codes), state).items()]
    return *counts, illegal, codes[0][0], codes[-1][0], *map(list, zip(*ways))


def stretches(batches: Batches) -> Iterator[tuple]:
    """Sorted rows (conv, initial, fault, copies) to stretches. A conversation at a border of the task may go on in another."""
    part = TaskContext.get().partitionId()
    conversations = groupby(rows_of(batches), key=lambda row: row[0])
    number, first, waiting, memo = 0, True, None, {}
    for conv, rows in conversations:
        codes = chain.from_iterable(expanded(*row[1:]) for row in rows)
        # The conversation before is known not to be the task's last one only now.
        if waiting:
            yield waiting[0], part, number, *stretch(*waiting[1:], memo)
            number, first, waiting = number + 1, False, None
        some = list(islice(codes, BLOCK))
        rest = list(islice(codes, BLOCK))
        if rest:
            for piece in chain([some, rest], pieces_of(codes, BLOCK)):
                yield conv, part, number, *stretch(piece, False, memo)
                number += 1
            first = False
        else:
            waiting = (conv, some, not first)
    if waiting:
        yield waiting[0], part, number, *stretch(waiting[1], False, memo)


def chained(before: dict[int, Weight], ways: Iterator[tuple]) -> dict[int, Weight]:
    """The lightest derivations after a stretch, from those before it: the agenda over hyperedges (before, way)."""
    agenda: list[tuple] = []
    for state, to, cost, audit in ways:
        if state in before:
            heappush(agenda, (before[state][0] + cost, before[state][1] + audit, to))
    after: dict[int, Weight] = {}
    while agenda:
        cost, audit, to = heappop(agenda)
        after.setdefault(to, (cost, audit))
    return after


def summaries(batches: Batches) -> Iterator[tuple]:
    """Sorted stretches to one row a conversation."""
    for conv, rows in groupby(rows_of(batches), key=lambda row: row[0]):
        totals, closing, settled = [0] * 4, None, []
        weights: dict[int, Weight] = {START: (0, "")}
        for _, _, _, *counts, opening, closed, froms, states, costs, audits in rows:
            totals = [a + b for a, b in zip(totals, counts)]
            if closing is not None and (closing, opening) not in LEGAL:
                totals[3] += 1
            closing = closed
            weights = chained(weights, zip(froms, states, costs, audits))
            # What all have in common decides nothing any more.
            common = commonprefix([audit for _, audit in weights.values()])
            settled.append(common)
            weights = {state: (cost, audit[len(common) :]) for state, (cost, audit) in weights.items()}
        cost, audit = min(weights[state] for state in GOALS if state in weights)
        yield conv, *totals, cost, "".join([*settled, audit])


def folded(df: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """Equal rows as one, with their number; `head` and `digest` stand for the text."""

    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    many = F.lit(1) if copies is None else F.coalesce(F.col(copies), F.lit(0))
    named = df.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        told(role).alias("role"),
        told(text).alias("text"),
        many.cast("long").alias("copies"),
    )
    rows = named.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    return rows.withColumns({"head": F.substring("text", 1, 32), "digest": F.unhex(F.sha2("text", 256))})


ORDER = ["turn", "role", "head", "digest"]


def coded(rows: DataFrame) -> DataFrame:
    """(conv, order columns, initial, fault, copies) of the folded rows that occur."""
    stripped = F.rtrim(F.col("text"), F.lit(BLANKS))
    initial = F.lit(0)
    for letter, state in INITIALS.items():
        initial = F.when(F.substring("role", 1, 1) == letter, state).otherwise(initial)
    own = F.when(stripped == "", BLANK).when(F.right(stripped, F.lit(1)).isin(*".!?"), FINE).otherwise(TRUNCATED)
    rows = rows.where("copies > 0").select("conv", *ORDER, "copies", initial.cast("int").alias("initial"), own.alias("own"))
    # The earliest turn of each role and text that is said in several turns; one row a key, so a hot key's rows can be split.
    said = rows.groupBy("conv", "role", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count(F.lit(1)).alias("turns"))
    said = Written(said.where("turns > 1").selectExpr("conv AS c", "role AS r", "digest AS d", "first.turn AS first"), "said").df
    same = F.col("conv").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    later = F.col("d").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first"))
    fault = F.when(later & (F.col("own") != BLANK), DUPLICATE).otherwise(F.col("own")).cast("int")
    return rows.join(said, same, "left").select("conv", *ORDER, "initial", fault.alias("fault"), "copies")


def audited(df: DataFrame, conv: str, turn: str, role: str, text: str, copies: str | None) -> DataFrame:
    """Every conversation's `kind` 0 row (gaps), 1 row (counts, cost, audit) and 2 rows (turns and texts), sorted so."""
    rows = Written(folded(df, conv, turn, role, text, copies), "folded").df
    codes = Written(coded(rows), "codes").df
    keys = ["conv", *ORDER]
    # The keys are unique, so a hot conversation is dealt out by turn, and a hot turn by role and text.
    dealt = codes.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv", "initial", "fault", "copies")
    found = Written(mapped(dealt, STRETCH, stretches), "stretches").df
    found = found.repartition("conv").sortWithinPartitions("conv", "part", "number")
    repairs = mapped(found, SUMMARY, summaries).withColumn("kind", F.lit(1))
    there = F.when(F.col("copies") > 0, F.col("turn"))
    spans = rows.groupBy("conv").agg(F.min(there).alias("low"), F.max(there).alias("high"), F.countDistinct(there).alias("turns"))
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0))
    spans = spans.select("conv", F.lit(0).alias("kind"), gaps.alias("gaps"))
    turns = rows.where("copies > 0").withColumn("kind", F.lit(2))
    every = spans.unionByName(repairs, allowMissingColumns=True).unionByName(turns, allowMissingColumns=True)
    ordered = every.repartition("conv").sortWithinPartitions("conv", "kind", *ORDER)
    return ordered.select("conv", "kind", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "turn", "role", "copies", "text")


def edits(audit: str, rows: Iterator[tuple]) -> Iterator[tuple]:
    """(edit, turn, role, repaired role, text) of every edit in order; `rows`: (turn, role, copies, text)."""
    state = START

    def inserted(letters: Iterator[str]) -> Iterator[tuple]:
        nonlocal state
        for letter in letters:
            if letter != "I":
                return letter
            state = EXPECTED[state]
            yield "I", None, None, ROLES[state], ""
        return None

    letters = iter(audit)
    for turn, role, copies, text in rows:
        for _ in range(copies):
            letter = yield from inserted(letters)
            if letter == "D":
                yield letter, turn, role, None, text
            elif letter == "K":
                state = INITIALS[role[:1]]
                yield letter, turn, role, role, text
            else:
                state = EXPECTED[state]
                yield letter, turn, role, ROLES[state], text
    yield from inserted(letters)


def conversations(batches: Batches) -> Iterator[tuple]:
    """(conv, gaps, summary or None, edits) of every conversation; the edits are to be read before the next one."""
    for conv, rows in groupby(rows_of(batches), key=lambda row: row[0]):
        gaps = next(rows)[2]
        summary = next(rows, None)
        yield conv, gaps, summary and summary[3:9], edits(summary[8], (row[9:] for row in rows)) if summary else iter(())


TURNS = "conv_id BIGINT, place BIGINT, edit STRING, turn BIGINT, role STRING, repaired_role STRING, text STRING"


def repaired_turns(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None
) -> DataFrame:
    """One row per edit, in the order of `place`: (conv_id, place, edit, turn, role, repaired_role, text).

    `copies` names a column that says how often a row occurs. A deleted turn has no repaired role.
    """

    def rows(batches: Batches) -> Iterator[tuple]:
        for key, _, _, made in conversations(batches):
            for place, edit in enumerate(made):
                yield key, place, *edit

    return mapped(audited(df, conv, turn, role, text, copies), TURNS, rows)


REPAIRS = (
    "conv_id BIGINT, gaps BIGINT, blank BIGINT, duplicate BIGINT, truncated BIGINT, illegal BIGINT, cost BIGINT, audit STRING, "
    "repaired_sha256 STRING"
)


def repairs(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", copies: str | None = None
) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of its repair, and the digest of what it becomes."""

    def rows(batches: Batches) -> Iterator[tuple]:
        for key, gaps, summary, made in conversations(batches):
            digest, between = hashlib.sha256(), b""
            for _, _, _, repaired, text in made:
                if repaired is not None:
                    digest.update(between + f"{repaired}:{text}".encode())
                    between = b"\n"
            yield key, gaps, *(summary or (0, 0, 0, 0, 0, "")), digest.hexdigest()

    return mapped(audited(df, conv, turn, role, text, copies), REPAIRS, rows)


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turn, role, text, copies): faults planted by a checksum of conversation and turn, for tests and measures.

    Of 20 rows one is dropped (0 copies), one emptied, one loses its sentence marks, one is repeated and one becomes the user's.
    """

    def told(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat_ws(":", told(conv), told(turn)).cast("binary")) % 20
    return df.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.when(fate == 4, "user").otherwise(told(role)).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(told(text), "[.!?]", "")).otherwise(told(text)).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"),
    )
