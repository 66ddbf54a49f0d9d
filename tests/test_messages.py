import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lorebase.operators import messages as ops

CHAT = f"conv_id BIGINT, seq BIGINT, role STRING, content STRING, call_id STRING, tool_calls {ops.TOOL_CALLS}"
ITEMS = "conv_id BIGINT, seq BIGINT, type STRING, role STRING, content STRING, call_id STRING, name STRING, arguments STRING"


def random_chat(seed, conversations=60, longest=40):
    dice = random.Random(seed)
    chat = []
    for conv in range(conversations):
        seq = 0
        talkative = dice.random()
        for _ in range(dice.randrange(1, longest)):
            seq += dice.choice([1, 1, 1, 2, 5])
            role = "assistant" if dice.random() < talkative else dice.choice(["user", "tool", "system", None])
            calls = [(f"c{seq}.{i}", "f", "{}") for i in range(dice.choice([0, 0, 1, 2]))] or dice.choice([None, []])
            chat.append((conv, seq, role, dice.choice([None, "", "tool call", "x", f"t{seq}"]), f"i{seq}", calls))
    return chat


def sequential(chat):
    """Walk over each conversation and glue neighbours, as a person would by hand."""
    out = {}
    for conv, seq, role, content, call_id, calls in sorted(chat, key=lambda m: m[:2]):
        done = out.setdefault(conv, [])
        if role == "assistant" and done and done[-1]["role"] == "assistant":
            last = done[-1]
            texts = [t for t in (last["content"], content) if t not in (None, "", "tool call")]
            last["content"] = "\n".join(texts) if texts else last["content"]
            last["calls"] = last["calls"] + [c[0] for c in calls or []]
            last["n"] += 1
        else:
            done.append({"seq": seq, "role": role, "content": content, "call_id": call_id, "n": 1, "calls": [c[0] for c in calls or []]})
    return sorted(
        (conv, run, m["seq"], m["n"], m["role"], m["content"], m["call_id"], m["calls"])
        for conv, done in out.items()
        for run, m in enumerate(done)
    )


def folded(df):
    return sorted(
        (r.conv_id, r.run_no, r.seq, r.n_messages, r.role, r.content, r.call_id, [c.call_id for c in r.tool_calls or []])
        for r in df.collect()
    )


@pytest.mark.parametrize("seed,block", [(1, 1_024), (2, 1), (3, 3), (4, 7)])
def test_runs_equal_a_walk(spark, seed, block):
    chat = random_chat(seed)
    merged = ops.merge_assistant_runs(spark.createDataFrame(chat, CHAT).repartition(3), block)
    assert folded(merged) == sequential(chat)


@pytest.mark.parametrize("start", [0, 3])
def test_a_run_over_many_blocks_is_one_message(spark, start):
    chat = [(1, start + n, "assistant", f"t{n}", None, []) for n in range(40)]
    merged = ops.merge_assistant_runs(spark.createDataFrame(chat, CHAT), 4).collect()
    assert [(r.n_messages, r.content) for r in merged] == [(40, "\n".join(f"t{n}" for n in range(40)))]


def test_a_single_message_is_left_as_it_is(spark):
    chat = [(1, 0, "assistant", "a", None, []), (1, 1, "user", "b", None, None), (1, 2, "assistant", "", None, None)]
    merged = ops.merge_assistant_runs(spark.createDataFrame(chat, CHAT), 2)
    assert rows(merged, "seq", "content", "tool_calls") == [(0, "a", []), (1, "b", None), (2, "", None)]


def test_a_missing_call_id_is_an_id(spark):
    schema = "conv_id BIGINT, seq BIGINT, type STRING, call_id STRING"
    items = [(1, 0, "function_call", None), (1, 1, "function_call_output", None), (2, 0, "function_call", None), (2, 1, "function_call", "")]
    items += [(2, 2, "function_call_output", "=")]
    assert rows(ops.pending_calls(spark.createDataFrame(items, schema)), "conv_id", "seq") == [(2, 0), (2, 1)]


@pytest.mark.parametrize("block", [1, 4, 1_024])
def test_role_changes(spark, block):
    chat = random_chat(9)
    last, expected = {}, []
    for conv, seq, role, *_ in sorted(chat, key=lambda m: m[:2]):
        expected.append((conv, seq, role, last.get(conv), role != last.get(conv)))
        last[conv] = role
    found = ops.role_changes(spark.createDataFrame(chat, CHAT), block)
    assert sorted(tuple(r) for r in found.collect()) == sorted(expected)


def test_folding_goldens(spark):
    def one(contents, role="assistant"):
        chat = [(1, i, role, c, None, None) for i, c in enumerate(contents)]
        return [r.content for r in ops.merge_assistant_runs(spark.createDataFrame(chat, CHAT)).orderBy("run_no").collect()]

    assert one(["", "x"]) == ["x"]
    assert one(["tool call", None]) == ["tool call"]
    assert one(["x", "tool call", "y"]) == ["x\ny"]
    assert one([None, ""]) == [None]
    assert one(["a", "b"], "user") == ["a", "b"]


def items(spark, *made):
    return spark.createDataFrame([(c, s, t, r, x, i, n, a) for c, s, t, r, x, i, n, a in made], ITEMS)


@pytest.fixture
def history(spark):
    return items(
        spark,
        (1, 0, "message", "user", "hi", None, None, None),
        (1, 1, "function_call", None, None, "a", "f", "{}"),
        (1, 2, "function_call", None, None, "b", "g", "{}"),
        (1, 3, "function_call_output", None, "done", "a", None, None),
        (2, 0, "function_call", None, None, "b", "f", "{}"),
        (2, 1, "function_call_output", None, "done", "b", None, None),
        (3, 0, "message", "user", "hi", None, None, None),
        (3, 1, "message", "assistant", "ho", None, None, None),
    )


def test_pending_calls_are_per_conversation(history):
    assert rows(ops.pending_calls(history), "conv_id", "call_id") == [(1, "b")]
    assert rows(ops.pending_calls(history, rows=1), "conv_id", "call_id") == [(1, "b")]


def test_next_action(history):
    assert rows(ops.next_action(history)) == [(1, 1, "run_tools"), (2, 0, "call_model"), (3, 0, "done")]


def test_append_outputs(spark, history):
    outputs = spark.createDataFrame([(1, "b", 2, "late"), (1, "z", 9, "later")], "conv_id BIGINT, call_id STRING, call_seq BIGINT, output STRING")
    added = ops.append_outputs(history, outputs)
    assert rows(added.filter("conv_id = 1 AND seq > 3"), "seq", "type", "content", "call_id") == [
        (4, "function_call_output", "late", "b"),
        (5, "function_call_output", "later", "z"),
    ]
    assert ops.pending_calls(added).count() == 0


def test_items_to_messages(history):
    shaped = ops.items_to_messages(history).filter("conv_id = 1")
    assert [
        (r.role, r.content, r.call_id, [tuple(c) for c in r.tool_calls or []]) for r in shaped.orderBy("seq").collect()
    ] == [
        ("user", "hi", None, []),
        ("assistant", "tool call", None, [("a", "f", "{}")]),
        ("assistant", "tool call", None, [("b", "g", "{}")]),
        ("tool", "done", "a", []),
    ]


def test_system_prompt(history):
    with_prompt = ops.prepend_system(history, "Be kind.")
    assert rows(with_prompt.filter("seq = -1"), "conv_id", "role", "content") == [(i, "system", "Be kind.") for i in (1, 2, 3)]
    assert ops.prepend_system(history, "") is history


def test_session(spark):
    requests = spark.createDataFrame(
        [
            (1, {"session_id": "s"}, "c"),
            (2, {"session_id": None}, "c"),
            (3, {"session_id": ""}, "c"),
            (4, {}, "c"),
            (5, {"other": "x"}, "c"),
            (6, None, "c"),
            (7, None, ""),
            (8, None, None),
        ],
        "id INT, custom_inputs MAP<STRING,STRING>, conversation_id STRING",
    )
    found = dict(rows(ops.resolve_session(requests), "id", "session_id"))
    assert found == {1: "s", 2: None, 3: None, 4: "c", 5: "c", 6: "c", 7: None, 8: None}


def test_iteration_budget(spark):
    rounds = spark.createDataFrame([(1, 0), (2, 4), (3, 5)], "conv_id BIGINT, tool_rounds BIGINT")
    budget = ops.iteration_budget(rounds)
    assert [len(r.closing_id or "") for r in budget.orderBy("conv_id").collect()] == [0, 0, 32]
    assert rows(budget.drop("closing_id")) == [
        (1, 0, 2, False, None),
        (2, 4, 10, False, None),
        (3, 5, 10, True, "Max iterations reached. Stopping."),
    ]


def test_chunks_and_items(spark):
    chunks = spark.createDataFrame([(1, []), (2, None), (3, ["x"])], "id INT, choices ARRAY<STRING>")
    assert rows(ops.nonempty_chunks(chunks), "id") == [(3,)]
    events = spark.createDataFrame([("response.output_item.done", "a"), ("response.created", "b"), (None, "c")], "type STRING, item STRING")
    assert rows(ops.done_items(events)) == [("a",)]
    assert spark.range(1).select(F.lit(1).alias("a"), F.lit(None).cast("string").alias("b")).select(ops.event_json("a", "b")).first()[0] == '{"a":1}'


def test_deltas(spark):
    words = [(1, 1, i, f"{i} ") for i in range(25)] + [(1, 2, 0, "x")]
    df = spark.createDataFrame(words, "conv_id BIGINT, item_id BIGINT, seq BIGINT, delta STRING").repartition(3)
    assert rows(ops.assemble_deltas(df, ["conv_id", "item_id"], 5)) == [
        (1, 1, "".join(f"{i} " for i in range(25)), 25),
        (1, 2, "x", 1),
    ]
    assert rows(ops.assemble_deltas(df, ["conv_id", "item_id"], 2)) == rows(ops.assemble_deltas(df, ["conv_id", "item_id"]))


def test_requests_and_replies(spark):
    requests = spark.createDataFrame(
        [(1, [("user", "a"), ("assistant", None)], {"session_id": "s"}), (2, [], None)],
        "conv_id BIGINT, input ARRAY<STRUCT<role:STRING,content:STRING>>, custom_inputs MAP<STRING,STRING>",
    )
    assert rows(ops.request_messages(requests)) == [(1, 0, "user", "a"), (1, 1, "assistant", None)]
    events = spark.createDataFrame(
        [(1, 0, "response.output_item.done", "x"), (1, 1, "other", "y"), (2, 0, "response.output_item.done", "z")],
        "conv_id BIGINT, seq BIGINT, type STRING, item STRING",
    )
    assert rows(ops.replies(events, requests)) == [(1, 0, "x", {"session_id": "s"}), (2, 0, "z", None)]
