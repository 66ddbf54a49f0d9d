import pytest
from conftest import rows
from pyspark.sql import functions as F

from lorebase.operators import tools
from lorebase.operators.tools import Tool

CALLS = "conv_id BIGINT, seq BIGINT, call_id STRING, name STRING, arguments STRING"


@pytest.fixture
def calls(spark):
    return spark.createDataFrame(
        [
            (1, 0, "a", "look", '{"k": 1}'),
            (1, 1, "b", "look", '{"k": "2", "x": {"y": [1]}}'),
            (1, 2, "c", "look", "{bad"),
            (1, 3, "d", "look", None),
            (1, 4, "e", "look", "[1]"),
            (1, 5, "f", "nobody", "{}"),
            (1, 6, "g", "own", '{"n": 5}'),
            (1, 7, "h", None, "{}"),
        ],
        CALLS,
    )


def test_only_whole_json_objects_are_arguments(spark):
    texts = ['{"k": 1}', ' {"k": 1} ', "{'k': 1}", '{"k": 1} trailing', '{"k": 1}, {"k": 2}', '{"k": 1}] x', '{"k": 1}} x', '[1]', "", None, '{"k": 1}, "b": 2', "{}"]
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n INT, arguments STRING")
    found = dict(rows(df.select("n", F.to_json(tools.parsed_arguments(F.col("arguments"))))))
    assert found == {n: '{"k":"1"}' if n < 2 else "{}" for n in range(len(texts))}


def test_arguments(calls):
    args = calls.select("call_id", tools.parsed_arguments(F.col("arguments")).alias("m"))
    found = {r.call_id: r.m for r in args.collect()}
    assert found["a"] == {"k": "1"}
    assert found["b"] == {"k": "2", "x": '{"y":[1]}'}
    assert found["c"] == found["d"] == found["e"] == {}


@pytest.mark.parametrize("limit", [1, 1_000])
def test_dispatch(spark, calls, limit):
    answers = spark.createDataFrame([("1", "one")], "key STRING, value STRING")

    def doubled(asked):
        n = F.try_element_at("args", F.lit("n")).cast("int")
        return asked.withColumn("value", (n * 2).cast("string")).withColumn("error", F.lit(None).cast("string"))

    registry = [Tool("look", "old", "other"), Tool("own", "", run=doubled), Tool("look", "new", "k", answers=answers)]
    done = dict(rows(tools.dispatch(calls, registry, limit), "call_id", "output"))
    assert done == {
        "a": "one",
        "b": "[]",
        "c": "missing argument: k",
        "d": "missing argument: k",
        "e": "missing argument: k",
        "f": "unknown tool: nobody",
        "g": "10",
        "h": "unknown tool: null",
    }


def test_registry(spark, calls):
    registry = [Tool("a__b__c", "first"), Tool("look", "x", "k", "retriever"), Tool("a__b__c", "second", "p")]
    assert rows(tools.tool_rows(spark, registry)) == [
        ("a__b__c", "a.b.c", "function", "p", "second"),
        ("look", "look", "retriever", "k", "x"),
    ]
    assert rows(tools.allowed_calls(calls, registry), "call_id") == [(c,) for c in "abcde"]
    assert rows(tools.unknown_calls(calls, registry), "call_id", "error") == [
        ("f", "unknown tool: nobody"),
        ("g", "unknown tool: own"),
        ("h", "unknown tool: null"),
    ]
    assert [tuple(r) for r in tools.dependencies(calls, registry, "m").orderBy("position").collect()] == [
        (0, "endpoint", "m", 8),
        (1, "retriever", "look", 5),
        (2, "function", "a.b.c", 0),
    ]


def test_scalars(spark):
    spec = spark.sql("SELECT named_struct('name', 'f', 'strict', true) AS spec")
    assert spec.select(tools.without_strict(F.col("spec")).alias("s")).first().s.asDict() == {"name": "f"}
    got = spark.sql("SELECT 'v' AS v, CAST(NULL AS STRING) AS n, 'e' AS e")
    made = got.select(tools.tool_result(F.col("v"), F.col("n")), tools.tool_result(F.col("v"), F.col("e")), tools.function_name(F.lit("a__b")))
    assert tuple(made.first()) == ("v", "e", "a.b")


def test_routing(spark):
    registry = [Tool("z", "refund policy details"), Tool("b", "service cases"), Tool("a", "service cases")]
    asked = spark.createDataFrame([(1, "show the refund policy"), (2, "cases of service"), (3, "weather"), (4, "")], "id BIGINT, q STRING")
    assert rows(tools.route(asked, ["id"], "q", registry), "id", "tool_name") == [(1, "z"), (2, "a"), (3, "none"), (4, "none")]
