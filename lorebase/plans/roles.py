"""The tables the queries work on, built from the given parquet tables (see FIXTURES.md)."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lorebase.functions.text import html_text, strip
from lorebase.functions.vectors import embed
from lorebase.operators.messages import TOOL_CALLS, resolve_session
from lorebase.operators.search import top_k
from lorebase.operators.service import newest_policies, service_history
from lorebase.operators.skew import positions, split_join
from lorebase.operators.tools import Tool, joint_key
from lorebase.sources.extract import extract_pages
from lorebase.session import fresh_path, stored
from lorebase.sources.files import write_files
from lorebase.sources.readers import read_table, read_texts

AS_OF = "2024-02-01"
ENDPOINT = "answer-model"
CATEGORIES = ["click", "error", "purchase", "signup", "view"]

POLICY_TOOL = "kb__support__get_policy"
HISTORY_TOOL = "kb__support__get_service_history"
SEARCH_TOOL = "kb__support__find_document"


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def products(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("doc-"), F.col("p_partkey").cast("string")).alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("p_brand").alias("product_sub_category"),
    )


def product_docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("product_name"), F.col("text").alias("product_doc")
    )


def named_products(spark: SparkSession, sf: str) -> DataFrame:
    """Products under their trade name, which many of them share."""
    return read_table(spark, sf, "part").select(F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"))


def named_docs(spark: SparkSession, sf: str) -> DataFrame:
    """One document per trade name: that of its first product."""
    first = named_products(spark, sf).groupBy("product_name").agg(F.min("product_id").alias("doc_id"))
    return first.join(read_table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id")


def policies(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "benchmark").select(
        F.concat(F.lit("Policy "), F.col("item_id").cast("string")).alias("policy"),
        F.col("text").alias("policy_details"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(F.col("item_id"), F.lit(365)).cast("int")).alias("last_updated"),
    )


def brand_policies(spark: SparkSession, sf: str) -> DataFrame:
    """Policies whose names repeat."""
    return read_table(spark, sf, "part").select(
        F.col("p_brand").alias("policy"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("policy_details"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.col("p_size")).alias("last_updated"),
    )


def email(user: Column) -> Column:
    return F.concat(F.lit("user"), user.cast("string"), F.lit("@example.com"))


def service(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "events").select(
        email(F.col("user_id")).alias("email"), F.col("event_type").alias("issue_category"), "ts"
    )


def returns(spark: SparkSession, sf: str) -> DataFrame:
    """Returned order lines with their customer; lines sent back for exchange carry another flag."""
    lines = read_table(spark, sf, "lineitem").filter(F.col("l_returnflag") == "R")
    orders = read_table(spark, sf, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    joined = split_join(lines.select("l_orderkey", "l_linenumber", "l_shipdate"), orders, ["l_orderkey"])
    return joined.select(
        F.col("o_custkey").alias("customer"),
        F.col("o_orderdate").alias("purchased"),
        F.col("l_shipdate").alias("returned"),
        "l_orderkey",
        "l_linenumber",
    )


def _k() -> Column:
    return F.get_json_object("props", "$.k").cast("int")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Events as response items; a user's events in order of arrival are one conversation."""
    kind, k = F.col("event_type"), F.col("k")
    events = read_table(spark, sf, "events").withColumnRenamed("user_id", "conv_id")
    numbered = positions(events, ["conv_id"], ["event_id"], "_position").withColumn("k", _k())
    answer = F.when(k < 10, "").when(k < 20, "tool call").when(k >= 30, F.concat(F.lit("answer "), k.cast("string")))
    asked = F.concat(F.lit("question "), k.cast("string"))
    tool = F.when(k < 40, POLICY_TOOL).when(k < 75, HISTORY_TOOL).when(k < 92, SEARCH_TOOL).otherwise("kb__support__close_case")
    return numbered.select(
        "conv_id",
        (F.col("_position") - 1).alias("seq"),
        "ts",
        F.when(kind.isin("view", "signup"), "message")
        .when(kind == "click", "function_call")
        .when(kind == "purchase", "function_call_output")
        .otherwise("reasoning")
        .alias("type"),
        F.when(kind == "view", "assistant").when(kind == "signup", "user").alias("role"),
        F.when(kind == "view", answer)
        .when(kind == "signup", F.concat(F.lit("question "), k.cast("string")))
        .when(kind == "purchase", F.concat(F.lit("output "), k.cast("string")))
        .alias("content"),
        F.when(kind.isin("click", "purchase"), k.cast("string")).alias("call_id"),
        F.when(kind == "click", tool).alias("name"),
        F.when(kind == "click", F.when(k.between(75, 91), F.to_json(F.struct(asked.alias("query")))).otherwise(F.col("props"))).alias("arguments"),
        F.lit(None).cast(TOOL_CALLS).alias("tool_calls"),
    )


def calls(spark: SparkSession, sf: str) -> DataFrame:
    return messages(spark, sf).filter(F.col("type") == "function_call")


def chat(spark: SparkSession, sf: str) -> DataFrame:
    turns = read_texts(spark, sf, "conversations", ["conv_id", "turn"], "role", "text")
    return turns.select("conv_id", F.col("turn").alias("seq"), "role", F.col("text").alias("content"))


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def asked(spark: SparkSession, sf: str) -> DataFrame:
    """Questions that name policies, customers and kinds of cases, or none of them; one per event."""
    number, k = F.col("event_id"), _k()
    policy = F.concat(F.lit("Policy "), F.pmod(number, F.lit(60)).cast("string"))
    other = F.concat(F.lit("policy "), F.pmod(number * 7, F.lit(60)).cast("string"))
    who = email(F.col("user_id"))
    text = (
        F.when(k % 5 == 0, F.concat(F.lit("What does "), policy, F.lit(" say? And "), other, F.lit("?")))
        .when(k % 5 == 1, F.concat(F.lit("How often did "), who, F.lit(" write?")))
        .when(k % 5 == 2, F.concat(F.lit("Count the "), F.col("event_type"), F.lit(" cases of <"), F.upper(who), F.lit(">.")))
        .when(k % 5 == 3, F.concat(who, F.lit(" asks for "), policy, F.lit("0, not x"), who))
        .otherwise(F.concat(F.lit("question "), k.cast("string")))
    )
    return read_table(spark, sf, "events").select(number.alias("conv_id"), F.lit(0).cast("long").alias("seq"), text.alias("content"))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Requests whose session is named in every way a request can name it."""
    kind, k = F.col("event_type"), F.col("k")
    pair = F.when(kind == "view", F.create_map(F.lit("session_id"), F.concat(F.lit("s"), k.cast("string"))))
    pair = pair.when(kind == "click", F.create_map(F.lit("session_id"), F.lit(None).cast("string")))
    pair = pair.when(kind == "signup", F.create_map(F.lit("locale"), F.lit("en")))
    pair = pair.when(kind == "purchase", F.create_map().cast("map<string,string>"))
    conversation = F.when(k < 50, F.concat(F.lit("c"), F.col("user_id").cast("string"))).when(k < 75, "")
    return (
        read_table(spark, sf, "events")
        .withColumn("k", _k())
        .select("event_id", pair.alias("custom_inputs"), conversation.alias("conversation_id"))
    )


def customer_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One open request per customer, with the inputs that came along."""
    session = F.concat(F.lit("s"), F.col("c_custkey").cast("string"))
    return read_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("conv_id"), F.create_map(F.lit("session_id"), session).alias("custom_inputs")
    )


def turn_requests(spark: SparkSession, sf: str) -> DataFrame:
    """Every conversation turn as a request of one message."""
    message = F.struct("role", F.col("text").alias("content"))
    return read_table(spark, sf, "conversations").select("conv_id", F.array(message).alias("input"))


def response_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Response chunks: some with a choice, some with an empty list, some without the list."""
    choice = F.array(F.struct(F.concat(F.lit("k"), _k().cast("string")).alias("content")))
    kind = F.col("event_type")
    return read_table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "error", F.slice(choice, 1, 0)).when(kind != "signup", choice).alias("choices"),
    )


def as_response_events(events: DataFrame) -> DataFrame:
    done = F.when(F.col("event_type") == "purchase", "response.output_item.done").otherwise("response.output_text.delta")
    return events.select(
        F.col("user_id").alias("conv_id"), F.col("event_id").alias("seq"), done.alias("type"), F.col("props").alias("item")
    )


def response_events(spark: SparkSession, sf: str) -> DataFrame:
    return as_response_events(read_table(spark, sf, "events"))


def as_deltas(turns: DataFrame, done: Column) -> DataFrame:
    """Turns with their list `_words` as one row per word; `done` marks the last."""
    words = turns.select("conv_id", F.col("turn").alias("item_id"), "_words", F.posexplode("_words").alias("seq", "_word"))
    delta = F.when(F.col("seq") > 0, F.concat(F.lit(" "), "_word")).otherwise(F.col("_word"))
    return words.select("conv_id", "item_id", "seq", delta.alias("delta"), done.alias("done"))


def deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Conversation turns broken into the words a model would stream."""
    turns = read_table(spark, sf, "conversations").withColumn("_words", F.split("text", " "))
    return as_deltas(turns, F.col("seq") == F.size("_words") - 1)


def extracted_pages(spark: SparkSession, sf: str) -> DataFrame:
    return extract_pages(read_texts(spark, sf, "pages", ["page_id"], "url", "html"), "url", "html")


def page_files(spark: SparkSession, sf: str) -> str:
    """The pages written out as files, one each, for the document jobs; the folder they are in."""
    folder = fresh_path(spark, "page-files")
    pages = read_table(spark, sf, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string"), F.lit(".pdf")).alias("name"), F.encode("html", "UTF-8").alias("content")
    )
    write_files(pages, folder)
    return folder


def paged_files(spark: SparkSession, sf: str) -> str:
    """The documents written out as files with a page per line; the folder they are in."""
    folder = fresh_path(spark, "paged-files")
    paged = F.encode(F.translate("text", "\n", "\f"), "UTF-8")
    docs = read_table(spark, sf, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("name"), paged.alias("content")
    )
    write_files(docs, folder)
    return folder


def session_items(spark: SparkSession, sf: str) -> DataFrame:
    """Events as the items of the session that their request resolves to: (session_id, type, ts)."""
    kind = F.col("event_type")
    types = F.when(kind.isin("view", "signup"), "message").when(kind == "click", "function_call")
    types = types.when(kind == "purchase", "function_call_output").when(kind == "error", "error").otherwise("reasoning")
    events = read_table(spark, sf, "events").select("event_id", types.alias("type"), "ts")
    return events.join(resolve_session(requests(spark, sf)).select("event_id", "session_id"), "event_id")


def first_version(spark: SparkSession, sf: str) -> DataFrame:
    return product_docs(spark, sf)


def second_version(spark: SparkSession, sf: str) -> DataFrame:
    """The documents after cleaning: toxic ones gone, poor ones squeezed, the text of web pages added."""
    labels = read_table(spark, sf, "labels")
    text = F.when(F.col("quality") == 0, F.trim(F.regexp_replace("text", r"\s+", " "))).otherwise(F.col("text"))
    kept = (
        read_table(spark, sf, "documents")
        .join(labels, "doc_id", "left")
        .filter(F.coalesce("toxic", F.lit(0)) == 0)
        .select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("product_name"), text.alias("product_doc"))
    )
    added = read_table(spark, sf, "pages").select(
        F.concat(F.lit("page-"), F.col("page_id").cast("string")).alias("product_name"),
        strip(html_text(F.col("html"))).alias("product_doc"),
    )
    return kept.unionByName(added)


def document_vectors(spark: SparkSession, sf: str) -> DataFrame:
    texts = read_texts(spark, sf, "documents", ["doc_id"], "text")
    return embed(texts, ["doc_id"], "text").withColumnRenamed("doc_id", "vec_id")


def question_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return embed(questions(spark, sf), ["query_id"], "text")


TOOLS = [
    Tool(POLICY_TOOL, "the details of a company policy by its exact name", "k"),
    Tool(HISTORY_TOOL, "the number of service cases of a customer per issue category", "k"),
    Tool(SEARCH_TOOL, "documents that tell about the products in the question", "query", "retriever"),
]


def tools(spark: SparkSession, sf: str) -> list[Tool]:
    """The tools bound to the given tables. An argument `k` names a policy or a customer, `query` is a text to search for."""
    found_policies = newest_policies(policies(spark, sf))
    policy_json = F.to_json(F.struct("policy", "policy_details", F.col("last_updated").cast("string").alias("last_updated")))
    per_customer = (
        service_history(service(spark, sf), as_of())
        .groupBy("email")
        .agg(F.array_sort(F.collect_list(F.struct("issue_category", "returns_last_12_months"))).alias("cases"))
    )
    answers = {
        POLICY_TOOL: found_policies.select(F.regexp_extract("policy", r"(\d+)$", 1).alias("key"), policy_json.alias("value")),
        HISTORY_TOOL: per_customer.select(
            F.regexp_extract("email", r"^user(\d+)@", 1).alias("key"), F.to_json("cases").alias("value")
        ),
    }
    bound = {SEARCH_TOOL: lambda calls: find_document(calls, document_vectors(spark, sf))}
    return [replace(tool, answers=answers.get(tool.name), run=bound.get(tool.name)) for tool in TOOLS]


CASES_TOOL = "kb__support__count_cases"
#: Tools whose arguments are the names in a question, and what kind of name each argument is.
NAMED_TOOLS = [
    Tool(POLICY_TOOL, "the details of a company policy by its exact name", "policy_name"),
    Tool(HISTORY_TOOL, "the number of service cases of a customer per issue category", "user_email"),
    Tool(CASES_TOOL, "the number of service cases of a customer in one issue category", "user_email, issue_category"),
]
NAME_KINDS = {"policy_name": "policy", "user_email": "email", "issue_category": "category"}


def known_names(spark: SparkSession, sf: str) -> DataFrame:
    """(name, kind): what a question may be about."""
    policies_, cases = policies(spark, sf).select(F.col("policy").alias("name")), service(spark, sf)
    named = [policies_.withColumn("kind", F.lit("policy"))]
    named.append(cases.select(F.col("email").alias("name")).distinct().withColumn("kind", F.lit("email")))
    named.append(cases.select(F.col("issue_category").alias("name")).distinct().withColumn("kind", F.lit("category")))
    return reduce(DataFrame.unionByName, named)


def named_tools(spark: SparkSession, sf: str) -> list[Tool]:
    """The tools bound to the given tables, by whole names, and the retriever."""
    policy_json = F.to_json(F.struct("policy", "policy_details", F.col("last_updated").cast("string").alias("last_updated")))
    counted = stored(service_history(service(spark, sf), as_of()), "history")
    per_customer = counted.groupBy("email").agg(F.array_sort(F.collect_list(F.struct("issue_category", "returns_last_12_months"))).alias("cases"))
    answers = {
        POLICY_TOOL: newest_policies(policies(spark, sf)).select(F.col("policy").alias("key"), policy_json.alias("value")),
        HISTORY_TOOL: per_customer.select(F.col("email").alias("key"), F.to_json("cases").alias("value")),
        CASES_TOOL: counted.select(joint_key(F.col("email"), F.col("issue_category")).alias("key"), F.col("returns_last_12_months").cast("string").alias("value")),
    }
    retriever = replace(TOOLS[-1], run=lambda calls: find_document(calls, document_vectors(spark, sf)))
    return [*(replace(tool, answers=answers[tool.name]) for tool in NAMED_TOOLS), retriever]


def find_document(calls: DataFrame, documents: DataFrame) -> DataFrame:
    """The retriever: for every call the document most like its `query`, or "[]" where none shares a word with it."""
    asked = calls.withColumn("_query", F.try_element_at("args", F.lit("query")))
    texts = asked.select("_query").filter(F.col("_query").isNotNull()).distinct()
    # Stored, so that the numbers stay with their texts.
    texts = stored(texts.withColumn("query_id", F.monotonically_increasing_id()), "asked")
    best = top_k(documents, embed(texts, ["query_id"], "_query"), 1).filter(F.col("score") > 0)
    found = texts.join(best, "query_id").select("_query", F.concat(F.lit("doc-"), F.col("vec_id").cast("string")).alias("_found"))
    return split_join(asked, found, ["_query"], "left").select(
        *calls.columns,
        F.coalesce("_found", F.lit("[]")).alias("value"),
        F.when(F.col("_query").isNull(), "missing argument: query").alias("error"),
    )
