"""Conversations as message tables.

A message table has one row per message: conv_id, seq (whole number, unique within the conversation and rising
with it), type, role, content, call_id, name, arguments and tool_calls. Steps that depend on the neighbours of a
message work on blocks of BLOCK positions, so the largest group any task sees has BLOCK rows however long the
conversation is; one small row per block carries the state from block to block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from lorebase.operators.skew import HOT_ROWS, positions, split_join, whole

BLOCK = 8_192
PIECE = 1_024
MAX_ITERATIONS = 10

# Contents that count as no text, and the closing message.
EMPTY_CONTENTS = ["", "tool call"]
STOP_TEXT = "Max iterations reached. Stopping."

TOOL_CALLS = "array<struct<call_id:string,name:string,arguments:string>>"


def real_text(content: Column) -> Column:
    """The content, or null where it stands for no text."""
    return F.when(~content.isin(EMPTY_CONTENTS), content)


def generated_id(*keys: str) -> Column:
    """An id made from the keys of a row: running the job again gives the same one."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def request_messages(requests: DataFrame) -> DataFrame:
    """Requests (conv_id, input ARRAY<STRUCT<role, content>>) as messages: (conv_id, seq, role, content)."""
    listed = requests.select("conv_id", F.posexplode("input").alias("seq", "_message"))
    return listed.select("conv_id", F.col("seq").cast("long").alias("seq"), "_message.role", "_message.content")


def items_to_messages(items: DataFrame) -> DataFrame:
    """Response items as chat messages (conv_id, seq, role, content, call_id, tool_calls).

    A call becomes an assistant message with one tool call, an output a tool message, anything else stays.
    """
    is_call, is_output = F.col("type") == "function_call", F.col("type") == "function_call_output"
    call = F.array(F.struct("call_id", "name", "arguments")).cast(TOOL_CALLS)
    return items.select(
        "conv_id",
        "seq",
        F.when(is_call, "assistant").when(is_output, "tool").otherwise(F.col("role")).alias("role"),
        F.when(is_call, "tool call").otherwise(F.col("content")).alias("content"),
        F.when(is_output, F.col("call_id")).alias("call_id"),
        F.when(is_call, call).alias("tool_calls"),
    )


def prepend_system(messages: DataFrame, prompt: str) -> DataFrame:
    """A system message at seq -1 of every conversation; nothing for an empty prompt."""
    if not prompt:
        return messages
    opening = messages.select("conv_id").distinct().select(
        "conv_id", F.lit(-1).cast("long").alias("seq"), F.lit("system").alias("role"), F.lit(prompt).alias("content")
    )
    return messages.unionByName(opening, allowMissingColumns=True)


def with_neighbours(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Each message with the role before it and the run it belongs to.

    Only consecutive assistant messages share a run. Adds prev_role, run_no (0-based within the conversation),
    _block and _edge (the run crosses a block border).
    """
    joins = F.coalesce((F.col("role") == "assistant") & (F.col("_prev") == "assistant"), F.lit(False))
    within = Window.partitionBy("conv_id", "_block").orderBy("seq")
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = (
        messages.withColumn("_block", whole(F.col("seq"), block))
        .withColumn("_prev", F.lag("role").over(within))
        .withColumn("_first", F.row_number().over(within) == 1)
        .withColumn("_opens", F.when(F.col("_first") | joins, 0).otherwise(1))
        .withColumn("_opened", F.sum("_opens").over(upto))
    )
    # One row per block; whether its first message opens a run depends on the block before.
    blocks = rows.groupBy("conv_id", "_block").agg(
        F.min_by("role", "seq").alias("_first_role"),
        F.max_by("role", "seq").alias("_last_role"),
        F.sum("_opens").alias("_inner"),
    )
    chain = Window.partitionBy("conv_id").orderBy("_block")
    earlier = chain.rowsBetween(Window.unboundedPreceding, -1)
    continues = F.coalesce((F.col("_first_role") == "assistant") & (F.col("_carried") == "assistant"), F.lit(False))
    state = (
        blocks.withColumn("_carried", F.lag("_last_role").over(chain))
        .withColumn("_continues", continues)
        .withColumn("_total", F.col("_inner") + F.when(F.col("_continues"), 0).otherwise(1))
        .withColumn("_before", F.coalesce(F.sum("_total").over(earlier), F.lit(0)))
        .withColumn("_goes_on", F.coalesce(F.lead("_continues").over(chain), F.lit(False)))
        .drop("_first_role", "_last_role")
    )
    carried = F.col("_continues") & (F.col("_opened") == 0)
    return (
        rows.join(state, ["conv_id", "_block"])
        .withColumn("prev_role", F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_prev")))
        .withColumn("run_no", (F.col("_before") + F.when(F.col("_continues"), -1).otherwise(0) + F.col("_opened")).cast("long"))
        .withColumn("_edge", carried | (F.col("_goes_on") & (F.col("_opened") == F.col("_inner"))))
        .drop("_prev", "_first", "_opens", "_opened", "_inner", "_carried", "_continues", "_total", "_before", "_goes_on")
    )


def role_changes(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, seq, role, prev_role, changed)."""
    return with_neighbours(messages.select("conv_id", "seq", "role"), block).select(
        "conv_id", "seq", "role", "prev_role", (~F.col("role").eqNullSafe(F.col("prev_role"))).alias("changed")
    )


def _folded() -> list[Column]:
    """Aggregates that fold messages of one run into one message, in order of seq.

    Real texts are joined by line breaks; without any, the first content stays as it is. Tool calls are strung
    together, every other field comes from the first message.
    """
    text = real_text(F.col("content"))
    texts = F.collect_list(F.when(text.isNotNull(), F.struct("seq", "content")))
    calls = F.collect_list(F.when(F.size("tool_calls") > 0, F.struct("seq", "tool_calls")))
    joined = F.array_join(F.transform(F.array_sort(texts), lambda m: m["content"]), "\n")
    strung = F.flatten(F.transform(F.array_sort(calls), lambda m: m["tool_calls"]))
    return [
        F.min("seq").alias("_seq"),
        F.sum("n_messages").alias("n_messages"),
        F.min_by("role", "seq").alias("role"),
        F.when(F.count(text) > 0, joined).otherwise(F.min_by("content", "seq")).alias("content"),
        F.min_by("call_id", "seq").alias("call_id"),
        F.when(F.size(strung) > 0, strung).otherwise(F.min_by("tool_calls", "seq")).alias("tool_calls"),
    ]


def merge_assistant_runs(messages: DataFrame, block: int = BLOCK) -> DataFrame:
    """Consecutive assistant messages folded into one (conv_id, run_no, seq, n_messages, role, ...).

    Runs are folded inside their block first, without moving the texts again; of runs that cross a border only the
    folded pieces, one a block, are folded a second time. A run is one row whatever its length, so its text must fit
    into a row (2 GB); Spark stops with an error otherwise.
    """
    rows = with_neighbours(messages, block).withColumn("n_messages", F.lit(1).cast("long"))
    inner = rows.filter(~F.col("_edge")).groupBy("conv_id", "_block", "run_no").agg(*_folded())
    border = rows.filter("_edge").groupBy("conv_id", "_block", "run_no").agg(*_folded()).withColumnRenamed("_seq", "seq")
    columns = ["conv_id", "run_no", "seq", "n_messages", "role", "content", "call_id", "tool_calls"]
    contained = inner.withColumnRenamed("_seq", "seq")
    crossing = border.groupBy("conv_id", "run_no").agg(*_folded()).withColumnRenamed("_seq", "seq")
    return contained.select(*columns).unionByName(crossing.select(*columns))


def last_message(messages: DataFrame) -> DataFrame:
    """The last message of every conversation."""
    fields = [c for c in messages.columns if c != "conv_id"]
    return messages.groupBy("conv_id").agg(F.max_by(F.struct(*fields), "seq").alias("_last")).select("conv_id", "_last.*")


def pending_calls(messages: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """Function calls without an output of the same call_id in their conversation; a missing call_id is an id as well."""
    named = F.coalesce(F.concat(F.lit("="), "call_id"), F.lit("")).alias("_call")
    calls = messages.filter(F.col("type") == "function_call").select("*", named)
    handled = messages.filter(F.col("type") == "function_call_output").select("conv_id", named).distinct()
    return split_join(calls, handled, ["conv_id", "_call"], "left_anti", rows).drop("_call")


def next_action(messages: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """What each conversation needs next: run_tools, done or call_model, with its number of pending calls."""
    waiting = pending_calls(messages.select("conv_id", "seq", "type", "call_id"), rows)
    counted = waiting.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_pending"))
    last = last_message(messages.select("conv_id", "seq", "type", "role"))
    answered = F.coalesce((F.col("type") == "message") & (F.col("role") == "assistant"), F.lit(False))
    return last.join(counted, "conv_id", "left").select(
        "conv_id",
        F.coalesce("n_pending", F.lit(0)).cast("long").alias("n_pending"),
        F.when(F.col("n_pending") > 0, "run_tools").when(answered, "done").otherwise("call_model").alias("action"),
    )


def iteration_budget(rounds: DataFrame, max_iterations: int = MAX_ITERATIONS) -> DataFrame:
    """(conv_id, tool_rounds) to the iterations a finished answer takes and whether the budget ends first.

    Every tool round costs one iteration for the model and one for the tools; the answer and the check that
    recognises it cost one each.
    """
    used = F.col("tool_rounds") * 2 + 2
    return rounds.select(
        "conv_id",
        "tool_rounds",
        F.least(used, F.lit(max_iterations)).cast("long").alias("iterations"),
        (used > max_iterations).alias("exhausted"),
        F.when(used > max_iterations, STOP_TEXT).alias("closing_text"),
        F.when(used > max_iterations, generated_id("conv_id", "tool_rounds")).alias("closing_id"),
    )


def append_outputs(messages: DataFrame, outputs: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """Tool outputs (conv_id, call_id, call_seq, output) put after the last message of their conversation.

    They keep the order of their calls and get the next free positions.
    """
    last = messages.groupBy("conv_id").agg(F.max("seq").alias("_last"))
    numbered = positions(outputs, ["conv_id"], ["call_seq"], "_n", rows)
    appended = split_join(numbered, last, ["conv_id"], rows=rows).select(
        "conv_id",
        (F.col("_last") + F.col("_n")).alias("seq"),
        F.lit("function_call_output").alias("type"),
        F.col("output").alias("content"),
        "call_id",
    )
    return messages.unionByName(appended, allowMissingColumns=True)


def resolve_session(requests: DataFrame) -> DataFrame:
    """Adds session_id to (custom_inputs, conversation_id).

    A session_id key in the inputs decides, even with an empty value; otherwise the conversation does. An empty
    result is no session.
    """
    named = F.coalesce(F.map_contains_key("custom_inputs", F.lit("session_id")), F.lit(False))
    chosen = F.when(named, F.try_element_at("custom_inputs", F.lit("session_id"))).otherwise(F.col("conversation_id"))
    return requests.withColumn("session_id", F.nullif(chosen, F.lit("")))


def session_rollup(messages: DataFrame) -> DataFrame:
    """Messages, calls, outputs, errors and other items per session, with the first and last time."""
    kind = F.col("type")
    return messages.groupBy("session_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(kind == "message").alias("messages"),
        F.count_if(kind == "function_call").alias("calls"),
        F.count_if(kind == "function_call_output").alias("outputs"),
        F.count_if(kind == "error").alias("errors"),
        F.count_if(~kind.isin("message", "function_call", "function_call_output", "error")).alias("others"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )


def nonempty_chunks(chunks: DataFrame) -> DataFrame:
    """Response chunks that carry at least one choice."""
    return chunks.filter(F.coalesce(F.size("choices"), F.lit(0)) > 0)


def done_items(events: DataFrame) -> DataFrame:
    """The completed items of a response."""
    return events.filter(F.col("type") == "response.output_item.done").drop("type")


def replies(events: DataFrame, requests: DataFrame, rows: int = HOT_ROWS) -> DataFrame:
    """The completed items of every request's response, with the request's custom inputs handed back unchanged.

    `events` has conv_id, seq, type and item, `requests` conv_id and custom_inputs, one row per conversation.
    """
    handed_back = requests.select("conv_id", F.col("custom_inputs").alias("custom_outputs"))
    return split_join(done_items(events), handed_back, ["conv_id"], rows=rows)


def event_json(*columns: str) -> Column:
    """An event as JSON without its null fields."""
    return F.to_json(F.struct(*columns))


def assemble_deltas(deltas: DataFrame, keys: list[str], piece: int = PIECE) -> DataFrame:
    """Text deltas (keys, seq, delta) put together into one text per item: (keys, text, n_deltas).

    Deltas are joined to pieces of `piece` positions first, so no task lists all deltas of an item, only its pieces.
    """

    def glued(order: str, text: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda d: d[text]), "")

    pieces = deltas.groupBy(*keys, whole(F.col("seq"), piece).alias("_piece")).agg(
        glued("seq", "delta").alias("_text"), F.count(F.lit(1)).alias("_n")
    )
    return pieces.groupBy(*keys).agg(
        glued("_piece", "_text").alias("text"), F.sum("_n").alias("n_deltas")
    )
