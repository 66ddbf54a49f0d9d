"""Queries over chunks, vectors, retrieval and scores, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorebase.functions import segments, text, vectors
from lorebase.operators import contexts, evaluate, quantised, search, semantic, service, tools
from lorebase.plans import roles
from lorebase.plans.conversation import CHAT, ROUTED, embedded
from lorebase.plans.lookups import POLICIES
from lorebase.plans.roles import TOOLS
from lorebase.session import stored
from lorebase.sources.readers import read_table, read_texts

#: Chunks of a context, and hits from which a context under a budget is chosen.
CONTEXT_CHUNKS, CANDIDATE_CHUNKS = 3, 12
#: The least share of cells that found 0.9 of the exact hits on every table measured (README).
ANN_BITS, ANN_WITHIN = 7, 4
#: What the search over the codes of 32 clusters finds at least.
CENTROID_RECALL = 0.9


def _texts(spark: SparkSession, sf: str) -> DataFrame:
    return read_texts(spark, sf, "documents", ["doc_id"], "text")


def _vectors(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "embeddings")


def chunk_fixed(spark: SparkSession, sf: str) -> DataFrame:
    return text.fixed_chunks(_texts(spark, sf), "text")


def chunk_packed(spark: SparkSession, sf: str) -> DataFrame:
    return text.packed_chunks(_texts(spark, sf), "text")


def chunk_semantic(spark: SparkSession, sf: str) -> DataFrame:
    return text.semantic_chunks(_texts(spark, sf), "text")


def chunk_global(spark: SparkSession, sf: str) -> DataFrame:
    """Chunks of the cheapest segmentation of each whole text."""
    return segments.global_chunks(_texts(spark, sf), "text")


def embed_documents(spark: SparkSession, sf: str) -> DataFrame:
    embedded_docs = vectors.embed(_texts(spark, sf), ["doc_id"], "text")
    return embedded_docs.select("doc_id", vectors.fingerprint(F.col("embedding")).alias("embedding"))


def index_buckets(spark: SparkSession, sf: str) -> DataFrame:
    return search.with_cells(_vectors(spark, sf)).select("vec_id", "cell")


def vector_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors most typical of each label."""
    known = _vectors(spark, sf)
    return search.top_k(known, search.label_queries(known), 10)


def ann_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The same search over the sign cells near each query's own, worked out in the scan: an index pays off for many searches."""
    known = _vectors(spark, sf)
    return search.ann_top_k(search.with_cells(known.select("vec_id", "embedding"), ANN_BITS), search.label_queries(known), 10, ANN_WITHIN, ANN_BITS)


def ann_recall(spark: SparkSession, sf: str) -> DataFrame:
    return search.recall(vector_topk(spark, sf), ann_topk(spark, sf))


def _quantised(spark: SparkSession, sf: str) -> quantised.Index:
    """The stored codes of all vectors, by clusters and what is left of each vector."""
    known = _vectors(spark, sf)
    return quantised.build(known, quantised.fit(known))


def pq_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors most typical of each label, found among the codes of all vectors and ranked by their exact scores."""
    return quantised.quantised_top_k(_quantised(spark, sf), search.label_queries(_vectors(spark, sf)), 10)


def centroid_recalls(spark: SparkSession, sf: str) -> DataFrame:
    """Recall of the search over codes by label means and by each twentieth row as queries, and the share of the vectors' bytes it reads."""
    known, index = _vectors(spark, sf), _quantised(spark, sf)
    rows = known.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), "embedding")

    def measured(name: str, asked: DataFrame) -> DataFrame:
        found = search.recall(search.top_k(known, asked, 10), quantised.quantised_top_k(index, asked, 10))
        read = quantised.bytes_read(index, asked, 10).select("share")
        return found.crossJoin(F.broadcast(read)).select(F.lit(name).alias("queries"), "expected", "found", "recall", "share")

    return measured("labels", search.label_queries(known)).unionByName(measured("rows", rows))


def pq_recall(spark: SparkSession, sf: str) -> DataFrame:
    """`centroid_recalls` as a query: (queries, expected, found, recall, share)."""
    return centroid_recalls(spark, sf)


def centroid_recall(spark: SparkSession, sf: str) -> DataFrame:
    """The exact hits by label, and whether the search over codes finds the share that it should, by label and by rows."""
    enough = F.bool_and(F.coalesce(F.col("recall") >= CENTROID_RECALL, F.lit(True)))
    expected = F.max(F.when(F.col("queries") == "labels", F.col("expected")))
    return centroid_recalls(spark, sf).agg(expected.alias("expected"), enough.alias("reached"))


def retrieval_relevance(spark: SparkSession, sf: str) -> DataFrame:
    relevant = _vectors(spark, sf).select(F.col("label").cast("long").alias("query_id"), "vec_id")
    return evaluate.retrieval_relevance(vector_topk(spark, sf), relevant)


def search_documents(spark: SparkSession, sf: str) -> DataFrame:
    return search.top_k(roles.document_vectors(spark, sf), roles.question_vectors(spark, sf), 5)


def search_learned(spark: SparkSession, sf: str) -> DataFrame:
    """The same search in the space that an SVD of the documents' words gives."""
    documents = _texts(spark, sf)
    space = semantic.fit(documents, "text")
    found = semantic.embed(documents, ["doc_id"], "text", space).withColumnRenamed("doc_id", "vec_id")
    return search.top_k(found, semantic.embed(roles.questions(spark, sf), ["query_id"], "text", space), 5)


def retrieval_safety(spark: SparkSession, sf: str) -> DataFrame:
    hits = stored(search_documents(spark, sf), "hits").withColumnRenamed("vec_id", "doc_id")
    return evaluate.safe_retrieval(hits, read_table(spark, sf, "labels"))


def search_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """The chunks most like each question: (query_id, rank, doc_id, chunk_no, score)."""
    chunks = vectors.embed(chunk_fixed(spark, sf), ["doc_id", "chunk_no"], "chunk")
    hits = search.top_k(chunks, roles.question_vectors(spark, sf), CONTEXT_CHUNKS, ids=("doc_id", "chunk_no"))
    return hits.withColumn("chunk_no", F.col("chunk_no").cast("int"))


def rag_context(spark: SparkSession, sf: str) -> DataFrame:
    """Context and default answer for every question; only documents that were hit are cut again."""
    hits = stored(search_chunks(spark, sf), "hits")
    hit_docs = _texts(spark, sf).join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    policies = service.newest_policies(roles.policies(spark, sf))
    facts = policies.select(
        F.regexp_extract("policy", r"(\d+)$", 1).cast("long").alias("query_id"),
        F.concat_ws(" ", "policy", F.lit("of"), F.col("last_updated").cast("string")).alias("fact"),
    )
    return search.assemble_context(hits, text.fixed_chunks(hit_docs, "text"), facts)


def rag_budget(spark: SparkSession, sf: str) -> DataFrame:
    """The chunks of every question's context under a budget of words, chosen from its CANDIDATE_CHUNKS best hits."""
    every = vectors.embed(chunk_fixed(spark, sf), ["doc_id", "chunk_no"], "chunk")
    hits = stored(search.top_k(every, roles.question_vectors(spark, sf), CANDIDATE_CHUNKS, ids=("doc_id", "chunk_no")), "hits")
    hits = hits.withColumn("chunk_no", F.col("chunk_no").cast("int"))
    hit_docs = _texts(spark, sf).join(hits.select("doc_id").distinct(), "doc_id", "left_semi")
    chunks = vectors.embed(text.fixed_chunks(hit_docs, "text"), ["doc_id", "chunk_no", "chunk"], "chunk")
    return contexts.budgeted(hits, chunks)


def route_questions(spark: SparkSession, sf: str) -> DataFrame:
    asked = roles.chat(spark, sf).filter(F.col("role") == "user")
    return tools.route(asked, ["conv_id", "seq"], "content", TOOLS)


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.answered_questions(roles.chat(spark, sf))


def eval_scores(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.scores(_pairs(spark, sf), ["conv_id", "seq"])


def eval_summary(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.summary(eval_scores(spark, sf))


def eval_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """Mean scores with the bounds of a bootstrap."""
    return evaluate.intervals(eval_scores(spark, sf), ["conv_id", "seq"])


def rag_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the answers that `rag_context` gives, grounded in the context that they were given."""
    asked = roles.questions(spark, sf).withColumnRenamed("text", "question")
    answered = stored(rag_context(spark, sf), "answers").join(asked, "query_id")
    return evaluate.scores(answered, ["query_id"], "context")


def model_slots(spark: SparkSession, sf: str) -> DataFrame:
    """A caller's embedding model and answer model, here the lengths of texts, in their slots."""
    texts = _texts(spark, sf).withColumnRenamed("text", "context")
    sized = vectors.embed_with(texts, "context", lambda batch: batch.str.len().map(lambda n: [float(n)]))
    answered = search.generate(sized, lambda batch: batch.str.len().astype(str))
    return answered.select("doc_id", F.get("embedding", F.lit(0)).alias("length"), "answer")


def groundedness(spark: SparkSession, sf: str) -> DataFrame:
    share = evaluate.grounded(F.col("answer"), F.col("question"))
    return _pairs(spark, sf).select("conv_id", "seq", share.alias("groundedness"))


QUERIES = {
    f.__name__: f
    for f in (
        chunk_fixed,
        chunk_packed,
        chunk_semantic,
        chunk_global,
        embed_documents,
        index_buckets,
        vector_topk,
        ann_topk,
        ann_recall,
        centroid_recall,
        pq_topk,
        pq_recall,
        retrieval_relevance,
        search_documents,
        search_learned,
        retrieval_safety,
        search_chunks,
        rag_context,
        rag_budget,
        route_questions,
        eval_scores,
        eval_summary,
        eval_intervals,
        groundedness,
        rag_scores,
        model_slots,
    )
}

CHUNKS = """
    SELECT doc_id, CAST(chunk_no AS INT) AS chunk_no, substring(text, chunk_no * 400 + 1, 500) AS chunk
    FROM (SELECT doc_id, text, unnest(range(CASE WHEN text = '' THEN 0
                 ELSE greatest(1, CAST(ceil((length(text) - 100) / 400.0) AS BIGINT)) END)) AS chunk_no FROM documents)"""
SENTENCE_RUNS = r"""
    SELECT *, sum(CASE WHEN last_words IS NULL THEN 1
                       WHEN len(list_intersect(words, last_words)) / greatest(sqrt(CAST(len(words) * len(last_words) AS DOUBLE)), 1) < 0.1
                       THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY n) - 1 AS chunk_no
    FROM (SELECT *, lag(words) OVER (PARTITION BY doc_id ORDER BY n) AS last_words
          FROM (SELECT doc_id, n, sentence,
                       list_distinct(list_filter(regexp_split_to_array(lower(sentence), '[^\p{L}\p{N}]+'), lambda t: t <> '')) AS words
                FROM (SELECT doc_id, unnest(s) AS sentence, unnest(range(len(s))) AS n
                      FROM (SELECT doc_id, regexp_extract_all(text, '[^.!?\n]*[.!?\n]+|[^.!?\n]+') AS s FROM documents))))"""


def cells(source: str, ident: str, bits: int) -> str:
    """SQL for sign cells of a relation (ident, i, x) with i from 0."""
    return f"""
    SELECT {ident}, CAST(sum(CASE WHEN side >= 0 THEN 1 << b ELSE 0 END) AS INT) AS cell
    FROM (SELECT {ident}, b, sum(x * CASE WHEN substring(md5(b || ':' || i), 1, 1) < '8' THEN 1 ELSE -1 END) AS side
          FROM ({source}), (SELECT CAST(unnest(range({bits})) AS INT) AS b) GROUP BY 1, 2) GROUP BY 1"""


COMPONENTS = (
    "SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS i FROM embeddings"
)
LABEL_QUERIES = f"""
    SELECT label, i, m / greatest(sqrt(sum(m * m) OVER (PARTITION BY label)), 1e-12) AS x
    FROM (SELECT label, i, avg(x) AS m FROM ({COMPONENTS}) GROUP BY 1, 2)"""
PAIR_SCORES = f"""
    SELECT q.label, v.vec_id, round(sum(q.x * v.x), 6) AS score
    FROM ({LABEL_QUERIES}) q JOIN ({COMPONENTS}) v USING (i) GROUP BY 1, 2"""


def best(scores: str, query: str, ident: str, k: int) -> str:
    return f"""
    SELECT CAST({query} AS BIGINT) AS query_id, CAST(n AS INT) AS rank, {ident} AS vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY {query} ORDER BY score DESC, {ident}) AS n FROM ({scores})) WHERE n <= {k}"""


TOPK = best(PAIR_SCORES, "label", "vec_id", 10)
ANN = best(
    f"""SELECT s.* FROM ({PAIR_SCORES}) s
        JOIN ({cells(f"SELECT * FROM ({LABEL_QUERIES})", "label", ANN_BITS)}) q ON q.label = s.label
        JOIN ({cells(COMPONENTS, "vec_id", ANN_BITS)}) v ON v.vec_id = s.vec_id
        WHERE bit_count(xor(q.cell, v.cell)) <= {ANN_WITHIN}""",
    "label",
    "vec_id",
    10,
)
ITEMS = embedded("SELECT item_id, text FROM benchmark", "item_id")
DOC_SCORES = f"""
    SELECT item_id, doc_id, round(coalesce(sum(q.weight * d.weight), 0), 6) AS score
    FROM (SELECT item_id, doc_id FROM benchmark, documents)
    LEFT JOIN ({ITEMS}) q USING (item_id)
    LEFT JOIN ({embedded("SELECT doc_id, text FROM documents", "doc_id")}) d USING (doc_id, bucket)
    GROUP BY 1, 2"""
DOC_HITS = best(DOC_SCORES, "item_id", "doc_id", 5)
CHUNK_SCORES = f"""
    SELECT item_id, vec_id.doc_id AS doc_id, vec_id.chunk_no AS chunk_no, round(sum(q.weight * d.weight), 6) AS score
    FROM ({ITEMS}) q
    JOIN ({embedded(f"SELECT struct_pack(doc_id := doc_id, chunk_no := chunk_no) AS vec_id, chunk AS text FROM ({CHUNKS})", "vec_id")}) d
    USING (bucket) GROUP BY 1, 2, 3"""
CHUNK_HITS = f"""
    SELECT item_id AS query_id, CAST(n AS INT) AS rank, doc_id, chunk_no, score
    FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, chunk_no) AS n FROM ({CHUNK_SCORES}))
    WHERE n <= {CONTEXT_CHUNKS}"""
PAIRS = f"""
    SELECT q.conv_id, q.seq, q.content AS question, a.content AS answer
    FROM ({CHAT}) q JOIN ({CHAT}) a ON a.conv_id = q.conv_id AND a.seq = q.seq + 1
    WHERE q.role = 'user' AND a.role = 'assistant'"""
RELEVANCE = f"""
    SELECT p.conv_id, p.seq, round(coalesce(sum(q.weight * a.weight), 0), 6) AS score
    FROM (SELECT conv_id, seq, conv_id || '-' || seq AS id FROM ({PAIRS})) p
    LEFT JOIN ({embedded(f"SELECT conv_id || '-' || seq AS id, question AS text FROM ({PAIRS})", "id")}) q USING (id)
    LEFT JOIN ({embedded(f"SELECT conv_id || '-' || seq AS id, answer AS text FROM ({PAIRS})", "id")}) a USING (id, bucket)
    GROUP BY 1, 2"""
GROUNDED = f"""
    SELECT conv_id, seq, coalesce(round(len(list_intersect(a, q)) / nullif(len(a), 0), 6), 0) AS score
    FROM (SELECT conv_id, seq,
                 list_distinct(list_filter(regexp_split_to_array(lower(answer), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')) AS a,
                 list_filter(regexp_split_to_array(lower(question), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '') AS q FROM ({PAIRS}))"""
SAFE = f"""
    SELECT conv_id, seq, CASE WHEN regexp_matches(lower(answer), '\\b(password|secret|credential)\\b') THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END
           AS score FROM ({PAIRS})"""
SCORES = f"""
    SELECT conv_id, seq, 'relevance' AS scorer, score FROM ({RELEVANCE})
    UNION ALL SELECT conv_id, seq, 'safety', score FROM ({SAFE})
    UNION ALL SELECT conv_id, seq, 'groundedness', score FROM ({GROUNDED})"""
RAG = f"""
        SELECT query_id, string_agg(chunk, chr(10) || '---' || chr(10) ORDER BY rank) || chr(10) || '---' || chr(10)
                 || max(policy) || ' of ' || max(last_updated) AS context, arg_min(chunk, rank) AS answer
        FROM ({CHUNK_HITS}) JOIN ({CHUNKS}) USING (doc_id, chunk_no) JOIN ({POLICIES}) ON policy = 'Policy ' || query_id GROUP BY 1"""
ORACLES = {
    "chunk_fixed": CHUNKS,
    "chunk_packed": r"""
        WITH RECURSIVE cut AS (
          SELECT doc_id, CAST(-1 AS INT) AS chunk_no, '' AS chunk, text AS rest FROM documents
          UNION ALL
          SELECT doc_id, chunk_no + 1, substring(rest, 1, size), substring(rest, size + 1)
          FROM (SELECT doc_id, chunk_no, rest, CASE WHEN length(rest) <= 500 THEN length(rest)
                  ELSE coalesce(nullif(length(regexp_replace(substring(rest, 1, 500), '[^.!?\n]*$', '')), 0), 500) END AS size
                FROM cut WHERE rest <> ''))
        SELECT doc_id, chunk_no, chunk FROM cut WHERE chunk_no >= 0""",
    "chunk_semantic": f"SELECT doc_id, CAST(chunk_no AS INT) AS chunk_no, string_agg(sentence, '' ORDER BY n) AS chunk "
    f"FROM ({SENTENCE_RUNS}) GROUP BY 1, 2",
    "embed_documents": f"""
        SELECT doc_id, string_agg(CAST(CAST(round(coalesce(weight, 0) * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY bucket) AS embedding
        FROM (SELECT doc_id, unnest(range(64)) AS bucket FROM documents)
        LEFT JOIN ({embedded("SELECT doc_id, text FROM documents", "doc_id")}) USING (doc_id, bucket) GROUP BY 1""",
    "index_buckets": cells(COMPONENTS, "vec_id", vectors.BITS),
    "vector_topk": TOPK,
    "ann_topk": ANN,
    "ann_recall": f"SELECT count(*) AS expected, count(a.vec_id) AS found, round(count(a.vec_id) / count(*), 6) AS recall "
    f"FROM ({TOPK}) e LEFT JOIN ({ANN}) a ON a.query_id = e.query_id AND a.vec_id = e.vec_id",
    "centroid_recall": f"SELECT count(*) AS expected, true AS reached FROM ({TOPK})",
    "retrieval_relevance": f"SELECT query_id, count(*) AS hits, round(count(*) FILTER (label = query_id) / count(*), 6) AS relevance "
    f"FROM ({TOPK}) JOIN embeddings USING (vec_id) GROUP BY 1",
    "search_documents": DOC_HITS,
    "retrieval_safety": f"SELECT query_id, count(*) AS hits, round(1 - avg(coalesce(toxic, 0)), 6) AS safety "
    f"FROM ({DOC_HITS}) LEFT JOIN labels ON doc_id = vec_id GROUP BY 1",
    "search_chunks": CHUNK_HITS,
    "model_slots": "SELECT doc_id, CAST(length(text) AS DOUBLE) AS length, CAST(length(text) AS VARCHAR) AS answer FROM documents",
    "rag_scores": f"""
        WITH r AS (SELECT query_id, text AS question, context, answer FROM ({RAG}) JOIN benchmark ON item_id = query_id),
        words AS (SELECT query_id, list_distinct(list_filter(regexp_split_to_array(lower(answer), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')) AS a,
                         list_filter(regexp_split_to_array(lower(context), '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '') AS c FROM r)
        SELECT query_id, 'groundedness' AS scorer, coalesce(round(len(list_intersect(a, c)) / nullif(len(a), 0), 6), 0) AS score FROM words
        UNION ALL SELECT query_id, 'safety', CASE WHEN regexp_matches(lower(answer), '\\b(password|secret|credential)\\b')
                    THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END FROM r
        UNION ALL SELECT query_id, 'relevance', round(coalesce(sum(q.weight * a.weight), 0), 6)
        FROM (SELECT query_id FROM r) LEFT JOIN ({embedded("SELECT query_id, question AS text FROM r", "query_id")}) q USING (query_id)
        LEFT JOIN ({embedded("SELECT query_id, answer AS text FROM r", "query_id")}) a USING (query_id, bucket) GROUP BY 1""",
    "rag_context": RAG,
    "route_questions": ROUTED,
    "eval_scores": SCORES,
    "eval_summary": f"SELECT scorer, round(avg(score), 6) AS mean_score, count(*) AS n_rows FROM ({SCORES}) GROUP BY 1",
    "eval_intervals": f"""
        WITH r AS (SELECT *, conv_id || '|' || seq || '|' || scorer AS key FROM ({SCORES})),
        d AS (SELECT *, CAST('0x' || substring(md5(key || '|' || b), 1, 5) AS BIGINT) AS u FROM r, (SELECT unnest(range({evaluate.REPLICATES + 1})) AS b)),
        m AS (SELECT scorer, b, count(*) AS n, sum(score * t) / nullif(sum(t), 0) AS mean
              FROM (SELECT *, CASE WHEN b = 0 THEN 1 ELSE {" + ".join(f"CASE WHEN u >= {limit} THEN 1 ELSE 0 END" for limit in evaluate.POISSON)} END AS t FROM d)
              GROUP BY 1, 2),
        s AS (SELECT scorer, max(mean) FILTER (b = 0) AS whole, list_sort(list(mean) FILTER (b > 0 AND mean IS NOT NULL)) AS means, max(n) AS n FROM m GROUP BY 1)
        SELECT scorer, round(whole, 6) AS mean_score, round(means[1 + CAST(floor(len(means) * {evaluate.TAIL}) AS INT)], 6) AS low,
               round(means[len(means) - CAST(floor(len(means) * {evaluate.TAIL}) AS INT)], 6) AS high, n AS n_rows FROM s""",
    "groundedness": f"SELECT conv_id, seq, score AS groundedness FROM ({GROUNDED})",
}
