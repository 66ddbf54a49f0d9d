"""Names are found as a plain search finds them, by automaton and by join; tools are called with what was asked about."""

import json
import random

import pytest
from conftest import rows

from lorebase.functions.tables import create_get_policy
from lorebase.operators import naming, tools
from lorebase.operators.tools import Tool

NAMES = ["Policy 1", "policy 12", "POLICY 12", "a@b.c", "b.c", "C++", "x", "Straße", "日本", "İz", "--", "", None, "Policy 1 of 2"]
TEXTS = [
    "Policy 1 and policy 12, Policy 123", "a@b.c, xa@b.c a@b.cd b.c", "c++ C++x xC++ C+", "STRASSE straße Straße.", "日本 日本語 x日本",
    "İz iz İİz", "policy 1 of 2 of 2", "x" * 30, "x " * 20, "", None, "--", "Policy  1", "policy\n1 Policy 1Policy 1",
]


def plain(text):
    """All whole mentions that aren't inside longer ones, by trying every place."""
    kept = {}
    for name in sorted((n for n in NAMES if n and any(map(str.isalnum, n))), reverse=True):
        kept[naming.folded(name)] = name
    low, found = naming.folded(text or ""), []
    for key, name in kept.items():
        for start in range(len(low)):
            end = start + len(key)
            if low[start:end] == key:
                left = start and low[start].isalnum() and low[start - 1].isalnum()
                right = end < len(low) and low[end].isalnum() and low[end - 1].isalnum()
                if not left and not right:
                    found.append((start, end, name))
    return [f for f in found if not any(o != f and o[0] <= f[0] and f[1] <= o[1] for o in found)]


@pytest.mark.parametrize("block, scans", [(1 << 20, 4), (8, 100), (8, 0)])
def test_mentions(spark, block, scans):
    draw = random.Random(block)
    texts = TEXTS + [" ".join(draw.choices([n for n in NAMES if n] + [",", "12", "of"], k=8)) for _ in range(40)]
    df = spark.createDataFrame([(i, t, "mine") for i, t in enumerate(texts)], "id INT, t STRING, name STRING").repartition(3)
    names = spark.createDataFrame([(n,) for n in [*NAMES, *NAMES]], "label STRING")
    found = naming.mentions(df, ["id"], "t", names, "label", block, scans).collect()
    assert sorted(map(tuple, found)) == sorted((i, *f) for i, t in enumerate(texts) for f in plain(t))
    assert naming.mentions(df.limit(0), ["id"], "t", names, "label", block, scans).count() == 0
    assert naming.mentions(df, ["id"], "t", names.limit(0), "label", block, scans).count() == 0


def test_calls_take_the_first_name_of_each_kind(spark):
    questions = spark.createDataFrame([(1, "q1"), (2, "q2"), (3, "q3")], "id INT, q STRING")
    found = spark.createDataFrame(
        [(1, 9, "late", "who"), (1, 2, "soon", "who"), (1, 5, "p", "what"), (2, 0, "p", "what")], "id INT, start INT, name STRING, kind STRING"
    )
    every = [Tool("both", "", "a, b"), Tool("one", "", "b")]
    calls = naming.asked_calls(questions, ["id"], "q", found, every, {"a": "who", "b": "what"}, Tool("other", "", "query"))
    assert {(r.id, r.name): json.loads(r.arguments) for r in calls.collect()} == {
        (1, "both"): {"a": "soon", "b": "p"},
        (1, "one"): {"b": "p"},
        (2, "one"): {"b": "p"},
        (3, "other"): {"query": "q3"},
    }


def test_tools_with_several_arguments(spark):
    answers = spark.createDataFrame([("x", "1", "found"), ('y"', "2,3", "odd")], "a STRING, b STRING, value STRING")
    answers = answers.select(tools.joint_key(answers.a, answers.b).alias("key"), "value")
    made = [("x", "1"), ('y"', "2,3"), ("x", "2"), ("x", None), (None, "1"), (None, None)]
    calls = spark.createDataFrame(
        [(1, i, str(i), "t", json.dumps({k: v for k, v in zip("ab", values) if v})) for i, values in enumerate(made)],
        "conv_id INT, seq INT, call_id STRING, name STRING, arguments STRING",
    )
    found = dict(rows(tools.dispatch(calls, [Tool("t", "", "a, b", answers=answers)]), "seq", "output"))
    assert found == {0: "found", 1: "odd", 2: "[]", 3: "missing argument: b", 4: "missing argument: a", 5: "missing argument: a"}


def test_a_tool_described_by_its_function(spark):
    spark.createDataFrame([], "policy STRING, policy_details STRING, last_updated DATE").createOrReplaceTempView("no_policies")
    create_get_policy(spark, "no_policies", "described_policy")
    tool = tools.function_tool(spark, "described_policy", "kb__policy")
    assert (tool.name, tool.description, tool.needs) == ("kb__policy", "Returns the details of a company policy", ["policy_name"])
