"""Queries over conversations and tool calls, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lorebase.functions.runs import create_fold_runs
from lorebase.operators import messages as ops
from lorebase.operators import naming, tools
from lorebase.plans import roles
from lorebase.plans.lookups import HISTORY, POLICIES
from lorebase.session import stored
from lorebase.plans.roles import CASES_TOOL, ENDPOINT, HISTORY_TOOL, POLICY_TOOL, SEARCH_TOOL, TOOLS

PROMPT = "Answer from the knowledge base."
#: Small sizes for the queries that show what happens to long conversations and hot keys.
BLOCK, SMALL = 3, 1


def _call_list(calls: Column) -> Column:
    """Tool calls as text: name(call_id) joined by commas."""
    return F.array_join(F.transform(calls, lambda c: F.concat(c["name"], F.lit("("), c["call_id"], F.lit(")"))), ",")


def items_to_messages(spark: SparkSession, sf: str) -> DataFrame:
    shaped = ops.items_to_messages(roles.messages(spark, sf))
    return shaped.withColumn("tool_calls", _call_list(F.col("tool_calls")))


def role_changes(spark: SparkSession, sf: str) -> DataFrame:
    return ops.role_changes(ops.items_to_messages(_history(spark, sf)))


def _history(spark: SparkSession, sf: str) -> DataFrame:
    """The message table, stored because the steps on it read it several times."""
    return stored(roles.messages(spark, sf).drop("tool_calls"), "messages")


def _merged(spark: SparkSession, sf: str) -> DataFrame:
    return ops.merge_assistant_runs(ops.items_to_messages(_history(spark, sf)))


def merge_assistant_runs(spark: SparkSession, sf: str) -> DataFrame:
    return _merged(spark, sf).select("conv_id", "run_no", "seq", "n_messages", "role", "content")


def fold_runs_sql(spark: SparkSession, sf: str) -> DataFrame:
    """The same fold by a table function in SQL."""
    create_fold_runs(spark)
    ops.items_to_messages(_history(spark, sf)).select("conv_id", "seq", "role", "content").createOrReplaceTempView("shaped_messages")
    return spark.sql("SELECT * FROM fold_runs(TABLE(SELECT conv_id, seq, role, content FROM shaped_messages) PARTITION BY conv_id ORDER BY seq)")


def merge_in_small_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The same in blocks of BLOCK positions, so that runs cross borders as they do in long conversations."""
    merged = ops.merge_assistant_runs(ops.items_to_messages(_history(spark, sf)), BLOCK)
    return merged.select("conv_id", "run_no", "seq", "n_messages", "role", "content")


def pending_calls_salted(spark: SparkSession, sf: str) -> DataFrame:
    """Pending calls with every call id of more than SMALL calls dealt to salts, as hot ones are at full size."""
    return ops.pending_calls(_history(spark, sf), SMALL).select("conv_id", "seq", "call_id", "name")


def merge_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    merged = _merged(spark, sf).filter(F.col("tool_calls").isNotNull())
    return merged.select(
        "conv_id", "run_no", F.size("tool_calls").cast("long").alias("n_calls"), _call_list(F.col("tool_calls")).alias("calls")
    )


def merge_chat(spark: SparkSession, sf: str) -> DataFrame:
    chat = roles.chat(spark, sf).select(
        "*", F.lit(None).cast("string").alias("call_id"), F.lit(None).cast(ops.TOOL_CALLS).alias("tool_calls")
    )
    return ops.merge_assistant_runs(chat).select("conv_id", "run_no", "seq", "role", "content")


def prepend_system(spark: SparkSession, sf: str) -> DataFrame:
    return ops.prepend_system(roles.chat(spark, sf), PROMPT)


def last_message(spark: SparkSession, sf: str) -> DataFrame:
    return ops.last_message(roles.chat(spark, sf))


def pending_tool_calls(spark: SparkSession, sf: str) -> DataFrame:
    return ops.pending_calls(_history(spark, sf)).select("conv_id", "seq", "call_id", "name")


def next_action(spark: SparkSession, sf: str) -> DataFrame:
    return ops.next_action(_history(spark, sf))


def iteration_budget(spark: SparkSession, sf: str) -> DataFrame:
    """A tool round is a run of calls that other messages separate from the next."""
    runs = _merged(spark, sf).groupBy("conv_id", "run_no").agg(F.max(F.size("tool_calls")).alias("_calls"))
    rounds = runs.groupBy("conv_id").agg(F.count_if(F.col("_calls") > 0).alias("tool_rounds"))
    return ops.iteration_budget(rounds)


def resolve_session(spark: SparkSession, sf: str) -> DataFrame:
    return ops.resolve_session(roles.requests(spark, sf)).select("event_id", "session_id")


def session_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Items per resolved session; times as text with all their digits."""
    rolled = ops.session_rollup(roles.session_items(spark, sf))
    return rolled.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS") for c in ("first_ts", "last_ts")})


def tool_specs(spark: SparkSession, sf: str) -> DataFrame:
    """The function record of every call without its `strict` field, as JSON."""
    spec = F.struct("name", F.lit(True).alias("strict"), "call_id")
    return roles.calls(spark, sf).select("conv_id", "seq", F.to_json(tools.without_strict(spec)).alias("spec"))


def event_json(spark: SparkSession, sf: str) -> DataFrame:
    """Every message as an event without null fields."""
    return roles.messages(spark, sf).select("conv_id", "seq", ops.event_json("conv_id", "seq", "role").alias("event"))


def nonempty_chunks(spark: SparkSession, sf: str) -> DataFrame:
    kept = ops.nonempty_chunks(roles.response_chunks(spark, sf))
    return kept.select("event_id", F.get("choices", F.lit(0))["content"].alias("content"))


def done_items(spark: SparkSession, sf: str) -> DataFrame:
    return ops.done_items(roles.response_events(spark, sf))


def replies(spark: SparkSession, sf: str) -> DataFrame:
    answered = ops.replies(roles.response_events(spark, sf), roles.customer_requests(spark, sf))
    return answered.select("conv_id", "seq", "item", F.try_element_at("custom_outputs", F.lit("session_id")).alias("session_id"))


def request_messages(spark: SparkSession, sf: str) -> DataFrame:
    return ops.request_messages(roles.turn_requests(spark, sf))


def assemble_deltas(spark: SparkSession, sf: str) -> DataFrame:
    return ops.assemble_deltas(roles.deltas(spark, sf), ["conv_id", "item_id"])


def tool_registry(spark: SparkSession, sf: str) -> DataFrame:
    """The tools in force and how often each was called."""
    used = roles.calls(spark, sf).groupBy(F.col("name").alias("tool_name")).agg(F.count(F.lit(1)).alias("n"))
    return (
        tools.tool_rows(spark, TOOLS)
        .join(used, "tool_name", "left")
        .select("tool_name", "function_name", "kind", "param", "description", F.coalesce("n", F.lit(0)).cast("long").alias("calls"))
    )


def tool_to_function_name(spark: SparkSession, sf: str) -> DataFrame:
    return roles.calls(spark, sf).select("conv_id", "seq", tools.function_name(F.col("name")).alias("function_name"))


def tool_args(spark: SparkSession, sf: str) -> DataFrame:
    args = tools.parsed_arguments(F.col("arguments"))
    return roles.calls(spark, sf).select(
        "conv_id", "seq", F.size(args).cast("long").alias("n_args"), F.try_element_at(args, F.lit("k")).alias("k")
    )


def allowed_calls(spark: SparkSession, sf: str) -> DataFrame:
    return tools.allowed_calls(roles.calls(spark, sf), TOOLS).select("conv_id", "seq", "name")


def unknown_tools(spark: SparkSession, sf: str) -> DataFrame:
    return tools.unknown_calls(roles.calls(spark, sf), TOOLS).select("conv_id", "seq", "name", "error")


def dependency_list(spark: SparkSession, sf: str) -> DataFrame:
    return tools.dependencies(roles.calls(spark, sf), TOOLS, ENDPOINT)


def dispatch_tools(spark: SparkSession, sf: str) -> DataFrame:
    waiting = stored(ops.pending_calls(_history(spark, sf)), "pending")
    return tools.dispatch(waiting, roles.tools(spark, sf))


def tool_result(spark: SparkSession, sf: str) -> DataFrame:
    """Outputs per tool: how many calls, how many ended in an error."""
    failed = F.col("output").startswith("unknown tool: ") | F.col("output").startswith("missing argument: ")
    calls = _history(spark, sf).filter(F.col("type") == "function_call")
    done = tools.dispatch(calls, roles.tools(spark, sf))
    return done.groupBy("name").agg(F.count(F.lit(1)).alias("calls"), F.count_if(failed).alias("errors"))


def answer_questions(spark: SparkSession, sf: str) -> DataFrame:
    """Every user turn routed to a tool, the tool run with the turn's text and the conversation's number, its output the answer.

    A turn that no tool fits has no output.
    """
    asked = roles.chat(spark, sf).filter(F.col("role") == "user")
    # Stored before the filter, which would otherwise be worked out before the scores and so make them twice.
    routed = stored(tools.route(asked, ["conv_id", "seq", "content"], "content", TOOLS), "routed").filter(F.col("tool_name") != "none")
    argument = F.to_json(F.struct(F.col("conv_id").alias("k"), F.col("content").alias("query")))
    calls = routed.select("conv_id", "seq", ops.generated_id("conv_id", "seq").alias("call_id"), F.col("tool_name").alias("name"), argument.alias("arguments"))
    answers = tools.dispatch(calls, roles.tools(spark, sf))
    return asked.select("conv_id", "seq").join(answers.select("conv_id", "seq", "name", "output"), ["conv_id", "seq"], "left")


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    """The names in the questions, with their kind."""
    names = roles.known_names(spark, sf)
    found = naming.mentions(roles.asked(spark, sf), ["conv_id", "seq"], "content", names)
    return found.join(names.distinct(), "name")


def question_names(spark: SparkSession, sf: str) -> DataFrame:
    """What every question mentions, and how often."""
    return _mentions(spark, sf).groupBy("conv_id", "kind", "name").agg(F.count(F.lit(1)).alias("n"))


def answer_by_name(spark: SparkSession, sf: str) -> DataFrame:
    """Questions answered by the tools that fit what they mention, with arguments read from the question; all others by the retriever."""
    bound = roles.named_tools(spark, sf)
    calls = naming.asked_calls(
        roles.asked(spark, sf), ["conv_id", "seq"], "content", _mentions(spark, sf), bound[:-1], roles.NAME_KINDS, bound[-1]
    )
    calls = stored(calls.withColumn("call_id", ops.generated_id("conv_id", "name")), "asked-calls")
    done = tools.dispatch(calls, bound)
    return done.join(calls.select("call_id", "arguments"), "call_id").select("conv_id", "name", "arguments", "output")


def append_tool_outputs(spark: SparkSession, sf: str) -> DataFrame:
    history = _history(spark, sf)
    waiting = stored(ops.pending_calls(history).select("conv_id", "call_id", "seq", "name"), "pending")
    outputs = waiting.select(
        "conv_id", "call_id", F.col("seq").alias("call_seq"), F.concat(F.lit("ran "), F.col("name")).alias("output")
    )
    return ops.append_outputs(history, outputs).select("conv_id", "seq", "type", "role", "content", "call_id")


QUERIES = {
    f.__name__: f
    for f in (
        items_to_messages,
        role_changes,
        merge_assistant_runs,
        fold_runs_sql,
        merge_in_small_blocks,
        pending_calls_salted,
        merge_tool_calls,
        merge_chat,
        prepend_system,
        last_message,
        pending_tool_calls,
        next_action,
        iteration_budget,
        resolve_session,
        session_rollup,
        tool_specs,
        event_json,
        nonempty_chunks,
        done_items,
        replies,
        request_messages,
        assemble_deltas,
        tool_registry,
        tool_to_function_name,
        tool_args,
        allowed_calls,
        unknown_tools,
        dependency_list,
        dispatch_tools,
        tool_result,
        answer_questions,
        question_names,
        answer_by_name,
        append_tool_outputs,
    )
}

CHAT = "SELECT conv_id, turn AS seq, role, text AS content FROM conversations"
MESSAGES = f"""
    SELECT conv_id, seq, ts,
           CASE WHEN kind IN ('view', 'signup') THEN 'message' WHEN kind = 'click' THEN 'function_call'
                WHEN kind = 'purchase' THEN 'function_call_output' ELSE 'reasoning' END AS type,
           CASE kind WHEN 'view' THEN 'assistant' WHEN 'signup' THEN 'user' END AS role,
           CASE kind WHEN 'view' THEN CASE WHEN k < 10 THEN '' WHEN k < 20 THEN 'tool call' WHEN k >= 30 THEN 'answer ' || k END
                     WHEN 'signup' THEN 'question ' || k WHEN 'purchase' THEN 'output ' || k END AS content,
           CASE WHEN kind IN ('click', 'purchase') THEN CAST(k AS VARCHAR) END AS call_id,
           CASE WHEN kind = 'click' THEN CASE WHEN k < 40 THEN '{POLICY_TOOL}' WHEN k < 75 THEN '{HISTORY_TOOL}'
                WHEN k < 92 THEN '{SEARCH_TOOL}' ELSE 'kb__support__close_case' END END AS name,
           CASE WHEN kind = 'click' THEN CASE WHEN k BETWEEN 75 AND 91 THEN '{{"query":"question ' || k || '"}}' ELSE props END END AS arguments
    FROM (SELECT user_id AS conv_id, ts, event_type AS kind, props, CAST(json_extract(props, '$.k') AS INT) AS k,
                 row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS seq FROM events)"""
SHAPED = f"""
    SELECT conv_id, seq,
           CASE type WHEN 'function_call' THEN 'assistant' WHEN 'function_call_output' THEN 'tool' ELSE role END AS role,
           CASE WHEN type = 'function_call' THEN 'tool call' ELSE content END AS content,
           CASE WHEN type = 'function_call_output' THEN call_id END AS call_id,
           CASE WHEN type = 'function_call' THEN name || '(' || call_id || ')' END AS tool_calls
    FROM ({MESSAGES})"""


def runs(messages: str) -> str:
    return f"""
    SELECT *, sum(CASE WHEN role = 'assistant' AND prev_role = 'assistant' THEN 0 ELSE 1 END)
                OVER (PARTITION BY conv_id ORDER BY seq) - 1 AS run_no
    FROM (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY seq) AS prev_role FROM ({messages}))"""


def merged(messages: str) -> str:
    return f"""
    SELECT conv_id, CAST(run_no AS BIGINT) AS run_no, min(seq) AS seq, count(*) AS n_messages,
           arg_min(coalesce(role, '~'), seq) AS role_or_none,
           CASE WHEN count(*) FILTER (content NOT IN ('', 'tool call')) > 0
                THEN string_agg(content, chr(10) ORDER BY seq) FILTER (content NOT IN ('', 'tool call'))
                ELSE CASE count(content) FILTER (seq = run_start) WHEN 0 THEN NULL ELSE min(content) FILTER (seq = run_start) END
           END AS content,
           count(tool_calls) AS n_calls,
           string_agg(tool_calls, ',' ORDER BY seq) AS calls
    FROM (SELECT *, min(seq) OVER (PARTITION BY conv_id, run_no) AS run_start FROM ({runs(messages)}))
    GROUP BY 1, 2"""


# The chat table has no tool calls.
CHAT_SHAPED = f"SELECT *, CAST(NULL AS VARCHAR) AS tool_calls FROM ({CHAT})"
CALLS = f"SELECT * FROM ({MESSAGES}) WHERE type = 'function_call'"
PENDING = f"""
    SELECT c.* FROM ({CALLS}) c WHERE NOT EXISTS (
      SELECT 1 FROM ({MESSAGES}) o WHERE o.type = 'function_call_output' AND o.conv_id = c.conv_id AND o.call_id = c.call_id)"""
KNOWN = ", ".join(f"'{t.name}'" for t in TOOLS)


def embedded(source: str, ident: str) -> str:
    """SQL for the default embedding, sparse: (ident, bucket, weight) of a relation (ident, text)."""
    return f"""
    SELECT {ident}, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY {ident})) AS weight
    FROM (SELECT {ident}, CAST(('0x' || substring(md5(token), 1, 8)) AS BIGINT) % 64 AS bucket, CAST(count(*) AS DOUBLE) AS n
          FROM (SELECT {ident}, unnest(regexp_split_to_array(lower(text), '[^\\p{{L}}\\p{{N}}]+')) AS token FROM ({source}))
          WHERE token <> '' GROUP BY 1, 2)"""


def dispatched(calls: str) -> str:
    return f"""
    WITH c AS (SELECT *, CASE WHEN json_valid(arguments) THEN json_extract_string(arguments, '$.k') END AS k,
                      CASE WHEN json_valid(arguments) THEN json_extract_string(arguments, '$.query') END AS query FROM ({calls})),
    asked AS (SELECT DISTINCT query FROM c WHERE name = '{SEARCH_TOOL}'),
    best AS (SELECT query, 'doc-' || doc_id AS document
             FROM (SELECT query, doc_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS n
                   FROM (SELECT query, doc_id, round(sum(q.weight * d.weight), 6) AS score
                         FROM ({embedded("SELECT query, query AS text FROM asked", "query")}) q
                         JOIN ({embedded("SELECT doc_id, text FROM documents", "doc_id")}) d USING (bucket) GROUP BY 1, 2))
             WHERE n = 1)
    SELECT conv_id, seq, call_id, name,
           CASE WHEN name NOT IN ({KNOWN}) THEN 'unknown tool: ' || name
                WHEN name = '{SEARCH_TOOL}' THEN CASE WHEN query IS NULL THEN 'missing argument: query' ELSE coalesce(document, '[]') END
                WHEN k IS NULL THEN 'missing argument: k'
                WHEN name = '{POLICY_TOOL}' THEN coalesce(p.value, '[]')
                ELSE coalesce(h.value, '[]') END AS output
    FROM c
    LEFT JOIN (SELECT CAST(regexp_extract(policy, '[0-9]+$') AS VARCHAR) AS k,
                      CAST(json_object('policy', policy, 'policy_details', policy_details, 'last_updated', last_updated) AS VARCHAR) AS value
               FROM ({POLICIES})) p USING (k)
    LEFT JOIN (SELECT regexp_extract(email, '[0-9]+') AS k, '[' || string_agg(CAST(json_object('issue_category', issue_category,
                      'returns_last_12_months', returns_last_12_months) AS VARCHAR), ',' ORDER BY issue_category) || ']' AS value
               FROM ({HISTORY}) GROUP BY 1) h USING (k)
    LEFT JOIN best USING (query)"""


OFFERS = ", ".join(f"('{t.name}', '{t.description}')" for t in TOOLS)
ROUTED = f"""
    WITH u AS (SELECT conv_id, seq, conv_id || '-' || seq AS id, content AS text FROM ({CHAT}) WHERE role = 'user'),
    o AS (SELECT * FROM (VALUES {OFFERS}) t(tool, text)),
    s AS (SELECT conv_id, seq, tool, round(coalesce(sum(q.weight * t.weight), 0), 6) AS score
          FROM (SELECT u.*, o.tool FROM u, o)
          LEFT JOIN ({embedded("SELECT id, text FROM u", "id")}) q USING (id)
          LEFT JOIN ({embedded("SELECT tool, text FROM o", "tool")}) t USING (tool, bucket) GROUP BY 1, 2, 3)
    SELECT conv_id, seq, CASE WHEN score >= 0.1 THEN tool ELSE 'none' END AS tool_name, score
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, seq ORDER BY score DESC, tool) AS n FROM s) WHERE n = 1"""
ROUTED_CALLS = f"""
    SELECT r.conv_id, r.seq, md5(r.conv_id || '|' || r.seq) AS call_id, tool_name AS name,
           CAST(json_object('k', r.conv_id, 'query', t.content) AS VARCHAR) AS arguments
    FROM ({ROUTED}) r JOIN ({CHAT}) t ON t.conv_id = r.conv_id AND t.seq = r.seq WHERE tool_name <> 'none'"""


ASKED = """
    SELECT event_id AS conv_id, CASE k % 5
        WHEN 0 THEN 'What does Policy ' || event_id % 60 || ' say? And policy ' || (event_id * 7) % 60 || '?'
        WHEN 1 THEN 'How often did user' || user_id || '@example.com write?'
        WHEN 2 THEN 'Count the ' || event_type || ' cases of <USER' || user_id || '@EXAMPLE.COM>.'
        WHEN 3 THEN 'user' || user_id || '@example.com asks for Policy ' || event_id % 60 || '0, not xuser' || user_id || '@example.com'
        ELSE 'question ' || k END AS content
    FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)"""
NAMED = f"""
    SELECT policy AS name, 'policy' AS kind FROM ({POLICIES})
    UNION SELECT 'user' || user_id || '@example.com', 'email' FROM events UNION SELECT event_type, 'category' FROM events"""
# Every question with every name of its text; names end at the edges of words, in either case.
MENTIONED = f"""
    SELECT conv_id, kind, name, len(regexp_extract_all(low, pattern)) AS n, length(regexp_extract(low, '^(.*?)' || pattern, 1)) AS place
    FROM (SELECT conv_id, lower(content) AS low FROM ({ASKED})),
         (SELECT *, lower(name) AS key, '\\b' || replace(lower(name), '.', '\\.') || '\\b' AS pattern FROM ({NAMED}))
    WHERE contains(low, key) AND regexp_matches(low, pattern)"""
BY_NAME = f"""
    WITH m AS ({MENTIONED}),
    first AS (SELECT conv_id, arg_min(name, place) FILTER (kind = 'policy') AS policy, arg_min(name, place) FILTER (kind = 'email') AS email,
                     arg_min(name, place) FILTER (kind = 'category') AS category FROM m GROUP BY 1),
    history AS (SELECT * FROM ({HISTORY})),
    texts AS (SELECT DISTINCT content AS query FROM ({ASKED}) a WHERE NOT EXISTS (SELECT 1 FROM first f WHERE f.conv_id = a.conv_id
              AND (policy IS NOT NULL OR email IS NOT NULL))),
    best AS (SELECT query, 'doc-' || doc_id AS document
             FROM (SELECT query, doc_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS n
                   FROM (SELECT query, doc_id, round(sum(q.weight * d.weight), 6) AS score
                         FROM ({embedded("SELECT query, query AS text FROM texts", "query")}) q
                         JOIN ({embedded("SELECT doc_id, text FROM documents", "doc_id")}) d USING (bucket) GROUP BY 1, 2))
             WHERE n = 1)
    SELECT conv_id, '{POLICY_TOOL}' AS name, CAST(json_object('policy_name', f.policy) AS VARCHAR) AS arguments,
           CAST(json_object('policy', p.policy, 'policy_details', policy_details, 'last_updated', last_updated) AS VARCHAR) AS output
    FROM first f JOIN ({POLICIES}) p ON p.policy = f.policy
    UNION ALL
    SELECT conv_id, '{HISTORY_TOOL}', CAST(json_object('user_email', f.email) AS VARCHAR), value
    FROM first f JOIN (SELECT email, '[' || string_agg(CAST(json_object('issue_category', issue_category,
                      'returns_last_12_months', returns_last_12_months) AS VARCHAR), ',' ORDER BY issue_category) || ']' AS value
                      FROM history GROUP BY 1) h ON h.email = f.email
    UNION ALL
    SELECT conv_id, '{CASES_TOOL}', CAST(json_object('user_email', f.email, 'issue_category', category) AS VARCHAR),
           coalesce(CAST(h.returns_last_12_months AS VARCHAR), '[]')
    FROM first f LEFT JOIN history h ON h.email = f.email AND h.issue_category = category WHERE f.email IS NOT NULL AND category IS NOT NULL
    UNION ALL
    SELECT conv_id, '{SEARCH_TOOL}', CAST(json_object('query', content) AS VARCHAR), coalesce(document, '[]')
    FROM ({ASKED}) JOIN texts ON query = content LEFT JOIN best USING (query)"""


def _registry_values() -> str:
    return ", ".join(
        f"('{t.name}', '{t.name.replace('__', '.')}', '{t.kind}', '{t.param}', '{t.description}')" for t in TOOLS
    )


SESSIONS = """
        SELECT event_id, nullif(CASE event_type WHEN 'view' THEN 's' || k WHEN 'click' THEN NULL
                 ELSE CASE WHEN k < 50 THEN 'c' || user_id WHEN k < 75 THEN '' END END, '') AS session_id
        FROM (SELECT *, CAST(json_extract(props, '$.k') AS INT) AS k FROM events)"""
ORACLES = {
    "items_to_messages": SHAPED,
    "role_changes": f"SELECT conv_id, seq, role, prev_role, role IS DISTINCT FROM prev_role AS changed FROM ({runs(SHAPED)})",
    "merge_assistant_runs": f"SELECT conv_id, run_no, seq, n_messages, nullif(role_or_none, '~') AS role, content "
    f"FROM ({merged(SHAPED)})",
    "fold_runs_sql": f"SELECT conv_id, run_no, seq, n_messages, nullif(role_or_none, '~') AS role, content "
    f"FROM ({merged(SHAPED)})",
    "merge_in_small_blocks": f"SELECT conv_id, run_no, seq, n_messages, nullif(role_or_none, '~') AS role, content "
    f"FROM ({merged(SHAPED)})",
    "pending_calls_salted": f"SELECT conv_id, seq, call_id, name FROM ({PENDING})",
    "merge_tool_calls": f"SELECT conv_id, run_no, n_calls, calls FROM ({merged(SHAPED)}) WHERE n_calls > 0",
    "merge_chat": f"SELECT conv_id, run_no, seq, role_or_none AS role, content FROM ({merged(CHAT_SHAPED)})",
    "prepend_system": f"{CHAT} UNION ALL SELECT DISTINCT conv_id, -1, 'system', '{PROMPT}' FROM conversations",
    "last_message": f"SELECT conv_id, seq, role, content FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY seq DESC) "
    f"AS n FROM ({CHAT})) WHERE n = 1",
    "pending_tool_calls": f"SELECT conv_id, seq, call_id, name FROM ({PENDING})",
    "next_action": f"""
        SELECT conv_id, coalesce(n, 0) AS n_pending,
               CASE WHEN n > 0 THEN 'run_tools' WHEN type = 'message' AND role = 'assistant' THEN 'done' ELSE 'call_model' END AS action
        FROM (SELECT conv_id, type, role, row_number() OVER (PARTITION BY conv_id ORDER BY seq DESC) AS r FROM ({MESSAGES})) m
        LEFT JOIN (SELECT conv_id, count(*) AS n FROM ({PENDING}) GROUP BY 1) p USING (conv_id) WHERE r = 1""",
    "iteration_budget": f"""
        SELECT conv_id, tool_rounds, least(2 * tool_rounds + 2, 10) AS iterations, 2 * tool_rounds + 2 > 10 AS exhausted,
               CASE WHEN 2 * tool_rounds + 2 > 10 THEN 'Max iterations reached. Stopping.' END AS closing_text,
               CASE WHEN 2 * tool_rounds + 2 > 10 THEN md5(conv_id || '|' || tool_rounds) END AS closing_id
        FROM (SELECT conv_id, count(*) FILTER (n_calls > 0) AS tool_rounds FROM ({merged(SHAPED)}) GROUP BY 1)""",
    "resolve_session": SESSIONS,
    "session_rollup": f"""
        SELECT session_id, count(*) AS items, count(*) FILTER (event_type IN ('view', 'signup')) AS messages,
               count(*) FILTER (event_type = 'click') AS calls, count(*) FILTER (event_type = 'purchase') AS outputs,
               count(*) FILTER (event_type = 'error') AS errors,
               count(*) FILTER (event_type NOT IN ('view', 'signup', 'click', 'purchase', 'error')) AS others,
               strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts
        FROM events JOIN ({SESSIONS}) USING (event_id) GROUP BY 1""",
    "tool_specs": f"SELECT conv_id, seq, '{{\"name\":\"' || name || '\",\"call_id\":\"' || call_id || '\"}}' AS spec FROM ({CALLS})",
    "event_json": f"SELECT conv_id, seq, '{{\"conv_id\":' || conv_id || ',\"seq\":' || seq || "
    f"CASE WHEN role IS NULL THEN '' ELSE ',\"role\":\"' || role || '\"' END || '}}' AS event FROM ({MESSAGES})",
    "nonempty_chunks": "SELECT event_id, 'k' || CAST(json_extract(props, '$.k') AS INT) AS content FROM events "
    "WHERE event_type NOT IN ('error', 'signup')",
    "done_items": "SELECT user_id AS conv_id, event_id AS seq, props AS item FROM events WHERE event_type = 'purchase'",
    "replies": "SELECT user_id AS conv_id, event_id AS seq, props AS item, 's' || c_custkey AS session_id "
    "FROM events JOIN customer ON c_custkey = user_id WHERE event_type = 'purchase'",
    "request_messages": "SELECT conv_id, CAST(0 AS BIGINT) AS seq, role, text AS content FROM conversations",
    "assemble_deltas": "SELECT conv_id, turn AS item_id, text, "
    "CAST(length(text) - length(replace(text, ' ', '')) + 1 AS BIGINT) AS n_deltas FROM conversations",
    "tool_registry": f"SELECT t.*, coalesce(n, 0) AS calls FROM (VALUES {_registry_values()}) "
    f"t(tool_name, function_name, kind, param, description) "
    f"LEFT JOIN (SELECT name, count(*) AS n FROM ({CALLS}) GROUP BY 1) ON name = tool_name",
    "tool_to_function_name": f"SELECT conv_id, seq, replace(name, '__', '.') AS function_name FROM ({CALLS})",
    "tool_args": f"SELECT conv_id, seq, CASE WHEN json_valid(arguments) THEN len(json_keys(arguments)) ELSE 0 END AS n_args, "
    f"CASE WHEN json_valid(arguments) THEN json_extract_string(arguments, '$.k') END AS k FROM ({CALLS})",
    "allowed_calls": f"SELECT conv_id, seq, name FROM ({CALLS}) WHERE name IN ({KNOWN})",
    "unknown_tools": f"SELECT conv_id, seq, name, 'unknown tool: ' || name AS error FROM ({CALLS}) WHERE name NOT IN ({KNOWN})",
    "dependency_list": f"""
        SELECT 0 AS position, 'endpoint' AS kind, '{ENDPOINT}' AS resource, count(*) AS calls FROM ({CALLS})
        UNION ALL SELECT 1, 'retriever', replace('{SEARCH_TOOL}', '__', '.'), count(*) FILTER (name = '{SEARCH_TOOL}') FROM ({CALLS})
        UNION ALL SELECT 2, 'function', replace('{POLICY_TOOL}', '__', '.'), count(*) FILTER (name = '{POLICY_TOOL}') FROM ({CALLS})
        UNION ALL SELECT 3, 'function', replace('{HISTORY_TOOL}', '__', '.'), count(*) FILTER (name = '{HISTORY_TOOL}') FROM ({CALLS})""",
    "dispatch_tools": dispatched(PENDING),
    "tool_result": f"SELECT name, count(*) AS calls, count(*) FILTER (output LIKE 'unknown tool: %' OR output LIKE 'missing argument: %') "
    f"AS errors FROM ({dispatched(CALLS)}) GROUP BY 1",
    "answer_questions": f"""
        SELECT c.conv_id, c.seq, name, output FROM ({CHAT}) c
        LEFT JOIN ({dispatched(ROUTED_CALLS)}) d ON d.conv_id = c.conv_id AND d.seq = c.seq WHERE c.role = 'user'""",
    "question_names": f"SELECT conv_id, kind, name, n FROM ({MENTIONED})",
    "answer_by_name": BY_NAME,
    "append_tool_outputs": f"""
        SELECT conv_id, seq, type, role, content, call_id FROM ({MESSAGES})
        UNION ALL
        SELECT conv_id, top + row_number() OVER (PARTITION BY conv_id ORDER BY seq), 'function_call_output', NULL, 'ran ' || name, call_id
        FROM ({PENDING}) JOIN (SELECT conv_id, max(seq) AS top FROM ({MESSAGES}) GROUP BY 1) USING (conv_id)""",
}
