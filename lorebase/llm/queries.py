"""The registered queries of the operators, with production parameters, each over its whole table."""

from __future__ import annotations

import hashlib
import zlib

import pyarrow as pa
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lorebase.llm import alignment, chat, decontaminate, derivation, neardup, packing, pieces, quality, rules, secrets, token_files, toxicity, warc
from lorebase.llm.common import Batches
from lorebase.sources.readers import read_table

#: Tokenizer files by the place that their package gives; every operator takes the path as a parameter.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")


def _sentencepiece_digests(batches: Batches) -> Batches:
    for batch in batches:
        ids, decoded = batch.column(1), batch.column(2)
        flat, ends = ids.values.to_numpy(), ids.offsets.to_numpy()
        yield pa.record_batch(
            {
                "doc_id": batch.column(0),
                "n_tokens": pa.array((ends[1:] - ends[:-1]).astype("int64")),
                "ids_sha256": [hashlib.sha256(flat[a:b].astype("<u4").tobytes()).hexdigest() for a, b in zip(ends, ends[1:])],
                "decoded_sha256": [hashlib.sha256(text.as_py().encode()).hexdigest() for text in decoded],
            }
        )


def op1_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document and of the text that they decode to, as digests."""
    return pieces.roundtrip(
        read_table(spark, folder, "documents"),
        PIECE_MODEL,
        "doc_id BIGINT, n_tokens BIGINT, ids_sha256 STRING, decoded_sha256 STRING",
        _sentencepiece_digests,
    )


def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Expected severity, grade and verdict of every document."""
    docs = read_table(spark, folder, "documents")
    return toxicity.scored(docs, toxicity.trained(docs, read_table(spark, folder, "labels")))


def op3_chat(spark: SparkSession, folder: str) -> DataFrame:
    """Every turn with its repair and its piece of the rendered conversation."""
    return chat.repaired(read_table(spark, folder, "conversations"))


def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Rules and log-likelihood verdict of every document."""
    return rules.quality_rules(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op5_warc(spark: SparkSession, folder: str) -> DataFrame:
    """What the archives of all pages hold, read back from them."""
    listing = warc.write(read_table(spark, folder, "pages"))
    return warc.read(listing, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP5_SQL = """
WITH sized AS (
    SELECT page_id, coalesce(html, '') AS payload, octet_length(CAST(encode(coalesce(html, '')) AS BLOB)) AS payload_bytes
    FROM pages
), grouped AS (
    SELECT *, max(page_id) OVER (PARTITION BY payload) AS largest FROM sized
)
SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to
FROM grouped
"""


def op6_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every passage of a document that is a benchmark item or within its edit budget."""
    return decontaminate.passages(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and a digest of the strong findings of every document, and the spans of all."""
    findings = secrets.scan(read_table(spark, folder, "documents"))

    def listed(column: Column) -> Column:
        named = F.transform(column, lambda f: F.concat_ws(":", f.kind, f.start.cast("string"), f.end.cast("string")))
        return F.concat_ws(",", named)

    base = F.filter("findings", lambda f: f.strong)
    counts = {f"n_{kind}": F.size(F.filter("findings", lambda f: f.kind == kind)).cast("long") for kind in secrets.KINDS[:3]}
    return findings.select(
        "doc_id",
        *(column.alias(name) for name, column in counts.items()),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("findings")).alias("spans"),
    )


def op8_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Place, number and checksum of every document's ids, read back from the token files."""
    return token_files.checksums(token_files.write(read_table(spark, folder, "documents"), BYTE_MODEL, end_id=2))


def op9_neardup(spark: SparkSession, folder: str) -> DataFrame:
    """Component of every document by four-word shingles and a similarity of 0.8 or more."""
    return neardup.near_duplicates(read_table(spark, folder, "documents"), size=4)


def op10_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated probability that a document has quality 1, learned from the rows that aren't held out."""
    docs, labels = read_table(spark, folder, "documents"), read_table(spark, folder, "labels")
    vectors = spark.sparkContext.broadcast(quality.word_vectors(docs))
    remainder = F.pmod(F.crc32(F.col("labelled").cast("string").cast("binary")), F.lit(4))
    network = quality.trained(docs, labels, vectors, among=remainder != 2)
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    scores = quality.scored(docs, vectors, network)
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Groups and links of the tokens of two tokenizers in every document, and how widespread the linked ids are."""
    found = alignment.alignment(read_table(spark, folder, "documents"), BYTE_MODEL, PIECE_MODEL, digest=True)
    counts = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    return found.select("doc_id", *counts, F.col("groups").alias("groups_sha256"))


def _packing_digests(batches: Batches) -> Batches:
    """The pieces with a checksum in place of their ids."""
    for batch in batches:
        lists = batch.column("ids")
        flat, ends = lists.values.to_numpy().astype("<u4"), lists.offsets.to_numpy()
        sums = pa.array([zlib.crc32(flat[a:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())], type=pa.int64())
        yield pa.record_batch([*batch.columns[:-1], sums], names=[*batch.schema.names[:-1], "ids_crc32"])


def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every piece of every document in a sequence of 1024 ids, with a checksum of its ids."""
    fields = "doc_id BIGINT, start BIGINT, length BIGINT, doc_tokens BIGINT, sequence_id BIGINT, offset BIGINT, ids_crc32 BIGINT"
    docs = read_table(spark, folder, "documents")
    return packing.pack(docs, BYTE_MODEL, end_id=0, schema=fields, steps=(_packing_digests,))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults, cheapest repair and its digest of every damaged conversation."""
    return derivation.repairs(derivation.damaged(read_table(spark, folder, "conversations")), copies="copies")


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_toxicity": op2_toxicity,
    "op3_chat": op3_chat,
    "op4_quality_rules": op4_quality_rules,
    "op5_warc": op5_warc,
    "op6_decontaminate": op6_decontaminate,
    "op7_secrets": op7_secrets,
    "op8_token_files": op8_token_files,
    "op9_neardup": op9_neardup,
    "op10_quality": op10_quality,
    "op11_alignment": op11_alignment,
    "op12_packing": op12_packing,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op5_warc": OP5_SQL,
}
