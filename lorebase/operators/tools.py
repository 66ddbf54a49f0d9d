"""Tools as functions over sets of calls: registry, argument parsing, dispatch, routing."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from lorebase.functions.vectors import as_array, dot, embed, literal_vector
from lorebase.operators.skew import HOT_ROWS, split_join


@dataclass(frozen=True)
class Tool:
    """A named tool. It answers all calls at once, in one of two ways.

    `answers` has one row (key, value) per value of the argument `param`; calls are joined to it. Of a tool with several
    arguments, `param` lists them with commas between, and the key is what `joint_key` makes of their values. `run` maps call
    rows (conv_id, seq, call_id, name, args) to the same rows with `value` and `error`; it takes precedence.
    """

    name: str
    description: str
    param: str = ""
    kind: str = "function"
    answers: DataFrame | None = None
    run: Callable[[DataFrame], DataFrame] | None = None

    @property
    def needs(self) -> list[str]:
        """The names of its arguments."""
        return [name.strip() for name in self.param.split(",") if name.strip()]


def joint_key(*values: Column) -> Column:
    """One key for several arguments, told apart whatever they hold; null if one is null."""
    every = reduce(lambda a, b: a & b, [value.isNotNull() for value in values])
    return F.when(every, F.to_json(F.array(*(value.cast("string") for value in values))))


def function_tool(spark: SparkSession, function: str, name: str = "", **bound) -> Tool:
    """A tool described by the comments of an SQL function: its own is the description, its parameters are the arguments."""
    lines = [row[0] for row in spark.sql(f"DESCRIBE FUNCTION EXTENDED {function}").collect()]
    usage = next((json.loads(line[len("Usage: ") :]) for line in lines if line.startswith("Usage: {")), {})
    params = T.StructType.fromDDL(usage.get("sqlFunction.inputParam", ""))
    return Tool(name or function, usage.get("sqlFunction.comment", ""), ",".join(params.names), **bound)


def registered(tools: list[Tool]) -> dict[str, Tool]:
    """Tools by name; of two with one name the later counts."""
    return {tool.name: tool for tool in tools}


def tool_rows(spark: SparkSession, tools: list[Tool]) -> DataFrame:
    """The registry as a table: one row per tool in force."""
    rows = [(t.name, t.name.replace("__", "."), t.kind, t.param, t.description) for t in registered(tools).values()]
    return spark.createDataFrame(rows, "tool_name STRING, function_name STRING, kind STRING, param STRING, description STRING")


def without_strict(spec: Column) -> Column:
    """A tool's function record without its `strict` field."""
    return spec.dropFields("strict")


def function_name(tool_name: Column) -> Column:
    return F.replace(tool_name, F.lit("__"), F.lit("."))


def parsed_arguments(arguments: Column) -> Column:
    """JSON object as a map of strings; an empty map for anything else.

    The parser stops after the first value, so the text is parsed inside a list and inside an object: what follows an
    object may close one of the two, but not both.
    """
    strict = {"allowSingleQuotes": "false"}
    listed = F.from_json(F.concat(F.lit("["), arguments, F.lit("]")), "array<map<string,string>>", strict)
    inside = F.from_json(F.concat(F.lit('{"a":'), arguments, F.lit("}")), "map<string,map<string,string>>", strict)
    whole = (F.size(listed) == 1) & (F.size(inside) == 1)
    return F.coalesce(F.when(whole, listed[0]), F.create_map().cast("map<string,string>"))


def tool_result(value: Column, error: Column) -> Column:
    """The text handed back for a call: its error if there is one, else its value."""
    return F.coalesce(error, value)


def allowed_calls(calls: DataFrame, tools: list[Tool]) -> DataFrame:
    """Calls of registered tools. The names are code, so the filter is pushed to the scan."""
    return calls.filter(F.col("name").isin(list(registered(tools))))


def unknown_calls(calls: DataFrame, tools: list[Tool]) -> DataFrame:
    """Calls of tools nobody registered, with the error they get."""
    known = F.coalesce(F.col("name").isin(list(registered(tools))), F.lit(False))
    return calls.filter(~known).withColumn("error", F.concat(F.lit("unknown tool: "), F.coalesce("name", F.lit("null"))))


def dispatch(calls: DataFrame, tools: list[Tool], rows: int = HOT_ROWS) -> DataFrame:
    """All calls (conv_id, seq, call_id, name, arguments) run, one output row each: (conv_id, seq, call_id, name, output).

    The answers of all keyed tools are one relation, so the calls are joined once whatever the number of tools. A
    call of an unknown tool or without its argument yields an error as output and stops nothing else; an argument
    nothing is found for yields "[]".
    """
    keep = ["conv_id", "seq", "call_id", "name"]
    known = registered(tools)
    own = [t for t in known.values() if t.run is not None]
    keyed = [t for t in known.values() if t.run is None and t.answers is not None]
    asked = calls.select(*keep, parsed_arguments(F.col("arguments")).alias("args"))

    def argument(param: str) -> Column:
        return F.try_element_at("args", F.lit(param))

    def key_of(tool: Tool) -> Column:
        return argument(tool.param) if len(tool.needs) < 2 else joint_key(*map(argument, tool.needs))

    key, error = F.lit(None).cast("string"), F.concat(F.lit("unknown tool: "), F.coalesce("name", F.lit("null")))
    for tool in keyed:
        key = F.when(F.col("name") == tool.name, key_of(tool)).otherwise(key)
        missing = F.coalesce(*(F.when(argument(param).isNull(), f"missing argument: {param}") for param in tool.needs or [tool.param]))
        error = F.when(F.col("name") == tool.name, missing).otherwise(error)
    shared = asked.filter(~F.coalesce(F.col("name").isin([t.name for t in own]), F.lit(False)))
    shared = shared.select(*keep, key.alias("_key"), error.alias("error"))
    if keyed:
        answers = reduce(
            DataFrame.unionByName,
            [t.answers.select(F.lit(t.name).alias("name"), F.col("key").alias("_key"), "value") for t in keyed],
        )
        shared = split_join(shared, answers, ["name", "_key"], "left", rows)
    else:
        shared = shared.withColumn("value", F.lit(None).cast("string"))
    done = shared.select(*keep, F.coalesce("value", F.lit("[]")).alias("value"), "error")
    for tool in own:
        done = done.unionByName(tool.run(asked.filter(F.col("name") == tool.name)).select(*keep, "value", "error"))
    return done.select(*keep, tool_result(F.col("value"), F.col("error")).alias("output"))


def dependencies(calls: DataFrame, tools: list[Tool], endpoint: str) -> DataFrame:
    """What a deployment needs, with the calls that use it: the endpoint, then retrievers, then functions.

    One row per tool in force, also for tools that were never called.
    """
    names = registered(tools)
    total, per_tool = F.count(F.lit(1)).alias("n0"), [
        F.count_if(F.col("name") == name).alias(f"n{i}") for i, name in enumerate(names, start=1)
    ]
    ordered = sorted(enumerate(names.values(), start=1), key=lambda pair: pair[1].kind != "retriever")
    rows = [F.struct(F.lit("endpoint").alias("kind"), F.lit(endpoint).alias("resource"), F.col("n0").alias("calls"))]
    for i, tool in ordered:
        rows.append(
            F.struct(
                F.lit(tool.kind).alias("kind"),
                F.lit(tool.name.replace("__", ".")).alias("resource"),
                F.col(f"n{i}").alias("calls"),
            )
        )
    return calls.agg(total, *per_tool).select(F.posexplode(F.array(*rows)).alias("position", "_r")).select("position", "_r.*")


def route(questions: DataFrame, ids: list[str], text: str, tools: list[Tool], threshold: float = 0.1) -> DataFrame:
    """The tool whose description is most like each question: (ids, tool_name, score).

    The first by name wins a tie; below `threshold` the tool is `none`. Descriptions are constants of the plan.
    """
    offers = [
        F.struct(
            F.round(dot(F.col("embedding"), as_array(literal_vector(tool.description))), 6).alias("score"),
            F.lit(-place).alias("place"),
            F.lit(tool.name).alias("tool_name"),
        )
        for place, tool in enumerate(sorted(registered(tools).values(), key=lambda t: t.name))
    ]
    best = F.array_max(F.array(*offers))
    scored = embed(questions, ids, text).withColumn("_best", best)
    return scored.select(
        *ids,
        F.when(F.col("_best.score") >= threshold, F.col("_best.tool_name")).otherwise("none").alias("tool_name"),
        F.col("_best.score").alias("score"),
    )
