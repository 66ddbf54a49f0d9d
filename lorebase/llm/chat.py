"""Chat formatting: the cheapest repair of the roles of a conversation, then its rendering.

Method: a legal conversation is an optional system turn, then user and assistant turns in alternation that start with the user and end
with the assistant. Reading its turns in order, a repair may relabel a turn (cost RELABEL), merge a turn into the one before (MERGE),
or put in an empty turn (INSERT). The automaton's states are the role of the last turn; a step from state to state has the cost of the
cheapest way to read one turn, insertions before it included. Dynamic programming over (min, +) finds the cheapest
repair; of equally cheap ones the first in a fixed order of states.

Reading a run of turns is a matrix of costs from state to state, and matrices of neighbouring runs multiply. So conversations are cut
into blocks of BLOCK turn numbers, whatever their length: each block yields its matrix, the matrices of a conversation are chained,
in groups of GROUP blocks and then over the groups, and each block is traced back from the states at its borders. Tasks read
the sorted rows of a block as they come, in stretches of at most BLOCK rows, each with a matrix of its own. Every turn becomes a piece of the rendered conversation of its own (with
the header, the text and the end mark that fall to it), so a conversation of any length is never held in one row; the pieces in
their order, glued, are the conversation.

Cases: turns are ordered by turn number, nulls first, then role, then a hash of the text; rows that are equal in all four columns are
one turn that was delivered several times (`copies`); a role that isn't system, user or assistant, null included, is relabelled at the same cost
whatever it becomes; a null text counts as empty; rows with a null conversation id are one conversation; other columns are
ignored; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lorebase.llm.common import Batches, Written, in_batches, map_batches, rows_of

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
MERGE, INSERT, RELABEL = 2, 3, 7
#: More than any repair costs, with room for sums.
NEVER = 1 << 52
BLOCK, GROUP = 1024, 1024
#: Roles that may follow a state, in the order in which ties are decided.
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
# The marks of the rendered text.
HEADER, END = "<|im_start|>{}\n", "<|im_end|>\n"


def ways() -> list[tuple[int, int, tuple[int, ...], bool]]:
    """(from, to, roles inserted, merged): every way to read a turn that ends in state `to`."""
    found = []
    for state in range(STATES):
        if state != START:
            found.append((state, state, (), True))
        paths = [((), state)]
        # Three insertions lead from any state to any other one.
        for _ in range(3):
            paths += [((*made, role), role) for made, last in paths for role in FOLLOWS[last] if len(made) < 3]
        seen = set()
        for made, last in sorted(set(paths), key=lambda path: (len(path[0]), path)):
            for role in FOLLOWS[last]:
                if role not in seen:
                    seen.add(role)
                    found.append((state, role, made, False))
    return found


WAYS = ways()


def step_costs() -> np.ndarray:
    """[role, from, to]: least cost of reading a turn; role 0 is any unknown one."""
    costs = np.full((STATES, STATES, STATES), NEVER, dtype=np.int64)
    for role in range(STATES):
        for state, to, made, merged in WAYS:
            cost = INSERT * len(made) + MERGE * merged + RELABEL * (role != to)
            costs[role, state, to] = min(costs[role, state, to], cost)
    return costs


STEP = step_costs()


def best_way(role: int, state: int, to: int) -> tuple[tuple[int, ...], bool]:
    """(roles inserted, merged) of the cheapest way; merging goes before inserting."""
    options = [
        (INSERT * len(made) + MERGE * merged, not merged, made, merged) for a, b, made, merged in WAYS if (a, b) == (state, to)
    ]
    _, _, made, merged = min(options)
    return made, merged


BEST = {
    (role, state, to): best_way(role, state, to)
    for role in range(STATES)
    for state in range(STATES)
    for to in range(STATES)
    if STEP[role, state, to] < NEVER
}
#: Insertions that end a conversation, by its last state: after a user's turn an empty answer; a system turn alone needs both.
ENDINGS = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
END_COST = np.array([INSERT * len(ENDINGS[state]) for state in range(STATES)], dtype=np.int64)


def chained(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """(min, +) product of cost matrices, for stacks of them as well."""
    return np.minimum((first[..., :, :, None] + second[..., None, :, :]).min(axis=-2), NEVER)


def run_matrix(roles: np.ndarray) -> np.ndarray:
    """Costs of reading a run of turns: neighbours are multiplied in pairs, all pairs at once."""
    steps = STEP[roles]
    while len(steps) > 1:
        half = len(steps) // 2
        pairs = chained(steps[0 : 2 * half : 2], steps[1 : 2 * half : 2])
        steps = np.concatenate([pairs, steps[2 * half :]])
    return steps[0]


def path(matrices: np.ndarray, first: int, last: int) -> list[int]:
    """The states after each matrix on the cheapest way from `first` to `last`; of equal ones the smallest, from the end."""
    costs = [np.where(np.arange(STATES) == first, 0, NEVER)]
    for matrix in matrices:
        costs.append(np.minimum((costs[-1][:, None] + matrix).min(axis=0), NEVER))
    states = [last]
    for cost, matrix in zip(costs[-2::-1], matrices[::-1]):
        states.append(int(np.argmin(cost + matrix[:, states[-1]])))
    return states[-2::-1] + [last] if len(matrices) else []


def role_number(role: Column) -> Column:
    number = F.lit(0)
    for place, name in enumerate(ROLES, 1):
        number = F.when(role == name, place).otherwise(number)
    return number.cast("int")


COSTS = [f"m{place}" for place in range(STATES * STATES)]
MATRIX = ", ".join(f"{name} BIGINT" for name in COSTS)
BORDER = ["first", "last", "final"]


def groups(batches: Batches, keys: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Runs of rows with the same first `keys` values, each as (values, rest of its rows); nothing is held."""
    for values, rows in groupby(rows_of(batches), key=lambda row: row[:keys]):
        yield values, (row[keys:] for row in rows)


def pieces_of(rows: Iterator[tuple], size: int) -> Iterator[list[tuple]]:
    while some := list(islice(rows, size)):
        yield some


def dealt(df: DataFrame, keys: list[str], order: list[str], columns: list[str]) -> DataFrame:
    """Rows of a key in one task, sorted by key and order."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).select(*columns)


def mapped(df: DataFrame, fields: str, rows) -> DataFrame:
    """`df` through a generator of tuples over its batches."""
    schema = pa.schema([(name, ARROW[kind]) for name, kind in (field.split() for field in fields.split(", "))])
    return map_batches(df, fields, lambda batches: in_batches(rows(batches), schema))


ARROW = {"BIGINT": pa.int64(), "INT": pa.int32(), "STRING": pa.string(), "BOOLEAN": pa.bool_()}


def block_matrices(batches: Batches) -> Iterator[tuple]:
    """The matrix of each stretch of at most BLOCK turns of a block."""
    for key, rows in groups(batches, 2):
        for number, some in enumerate(pieces_of(rows, BLOCK)):
            yield *key, number, *run_matrix(np.array([role for (role,) in some])).ravel().tolist()


def group_matrices(batches: Batches) -> Iterator[tuple]:
    """The product of the matrices of a group of blocks."""
    for key, rows in groups(batches, 2):
        total = None
        for some in pieces_of(rows, BLOCK):
            for matrix in np.array(some, dtype=np.int64).reshape(-1, STATES, STATES):
                total = matrix if total is None else chained(total, matrix)
        yield *key, *total.ravel().tolist()


def group_borders(batches: Batches) -> Iterator[tuple]:
    """States before and after each group of blocks of a conversation: one row for up to GROUP * BLOCK turn numbers."""
    for key, rows in groups(batches, 1):
        held = list(rows)
        matrices = np.array([row[1:] for row in held], dtype=np.int64).reshape(-1, STATES, STATES)
        cost = np.where(np.arange(STATES) == START, 0, NEVER)
        for matrix in matrices:
            cost = np.minimum((cost[:, None] + matrix).min(axis=0), NEVER)
        states = path(matrices, START, int(np.argmin(cost + END_COST)))
        for number, (row, first, last) in enumerate(zip(held, [START, *states], states), 1):
            yield *key, row[0], first, last, number == len(held)


def block_borders(batches: Batches) -> Iterator[tuple]:
    """States before and after each stretch of a group of blocks; its border row comes first."""
    for (conv, _), rows in groups(batches, 2):
        _, _, first, last, final, *_ = next(rows)
        held = list(rows)
        states = path(np.array([row[5:] for row in held], dtype=np.int64).reshape(-1, STATES, STATES), first, last)
        for number, (row, before, after) in enumerate(zip(held, [first, *states], states), 1):
            yield conv, row[0], row[1], before, after, final and number == len(held)


def rendered(batches: Batches) -> Iterator[tuple]:
    """The piece of every turn. The border rows of a block come before its turns, one for each stretch of BLOCK turns.

    A turn is closed by the piece that opens the next one, so no block needs to see its neighbour.
    """
    for (conv, block), rows in groups(batches, 2):
        borders: list[tuple] = []
        turns = None
        for row in rows:
            if row[0] is None:
                turns = chain([row], rows)
                break
            borders.append(row[1:4])
        place = 0
        for (state, last, final), some in zip(borders, pieces_of(turns, BLOCK)):
            numbers = [row[4] for row in some]
            for number, (row, to) in enumerate(zip(some, path(STEP[numbers], state, last)), 1):
                turn, role, copies, text = row[5:]
                ending = ENDINGS[to] if final and number == len(some) else None
                yield conv, turn, block, place, role, *piece(row[4], state, to, text or "", ending), copies
                state, place = to, place + 1


def piece(number: int, state: int, to: int, text: str, ending: tuple[int, ...] | None) -> tuple:
    """(repaired role, action, empty turns put in, cost, rendered piece) of a turn; `ending`: what follows the last one."""
    made, merged = BEST[number, state, to]
    relabelled = number != to
    parts = ["\n"] if merged else [END] if state != START else []
    if not merged:
        parts += [HEADER.format(ROLES[role - 1]) + END for role in made]
        parts.append(HEADER.format(ROLES[to - 1]))
    parts.append(text)
    if ending is not None:
        parts.append(END)
        parts += [HEADER.format(ROLES[role - 1]) + END for role in ending]
    inserted = len(made) + len(ending or ())
    action = "merge" if merged else "relabel" if relabelled else "insert" if inserted else "keep"
    return ROLES[to - 1], action, inserted, INSERT * inserted + MERGE * merged + RELABEL * relabelled, "".join(parts)


PIECES = (
    "conv_id BIGINT, turn BIGINT, block BIGINT, place BIGINT, role STRING, repaired STRING, action STRING, "
    "inserted INT, cost INT, piece STRING, copies BIGINT"
)


def repaired(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per turn: (conv_id, turn, block, place, role, repaired, action, inserted, cost, piece, copies).

    The pieces of a conversation in the order of (block, place), nulls first, are its rendering; the costs add up to its
    repair's.
    """
    named = df.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.col(role).cast("string").alias("role"),
        F.col(text).cast("string").alias("text"),
    )
    turns = Written(named.groupBy("conv", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")), "turns").df
    turns = (
        turns.withColumn("block", F.floor(F.col("turn") / BLOCK).cast("long"))
        .withColumn("number", role_number(F.col("role")))
        .withColumn("tie", F.xxhash64("role", "text"))
    )
    order = ["turn", "number", "tie"]
    numbers = turns.select("conv", "block", *order)
    blocks = mapped(
        dealt(numbers, ["conv", "block"], order, ["conv", "block", "number"]),
        f"conv BIGINT, block BIGINT, stretch BIGINT, {MATRIX}",
        block_matrices,
    )
    blocks = Written(blocks, "blocks").df.withColumn("part", F.floor(F.col("block") / GROUP).cast("long"))
    parts = mapped(
        dealt(blocks, ["conv", "part"], ["block", "stretch"], ["conv", "part", *COSTS]), f"conv BIGINT, part BIGINT, {MATRIX}", group_matrices
    )
    part_borders = mapped(
        dealt(parts, ["conv"], ["part"], ["conv", "part", *COSTS]),
        "conv BIGINT, part BIGINT, first INT, last INT, final BOOLEAN",
        group_borders,
    )
    marked = part_borders.withColumn("kind", F.lit(0)).unionByName(blocks.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    borders = mapped(
        dealt(marked, ["conv", "part"], ["kind", "block", "stretch"], ["conv", "part", "block", "stretch", *BORDER, *COSTS]),
        "conv BIGINT, block BIGINT, stretch BIGINT, first INT, last INT, final BOOLEAN",
        block_borders,
    )
    # Turns have no stretch; the border rows of a block, which have, come first.
    every = borders.unionByName(turns, allowMissingColumns=True)
    columns = ["conv", "block", "stretch", *BORDER, "number", "turn", "role", "copies", "text"]
    keys, placed = ["conv", "block"], [F.col("stretch").asc_nulls_last(), *(F.col(name) for name in order)]
    ordered = every.repartition(*keys).sortWithinPartitions(*(F.col(key) for key in keys), *placed).select(*columns)
    return mapped(ordered, PIECES, rendered)
