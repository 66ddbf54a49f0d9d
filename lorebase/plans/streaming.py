"""The streaming jobs run over the given tables until their input is used up, each with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorebase.functions.vectors import fingerprint
from lorebase.operators import messages as ops
from lorebase.plans import ingest, roles
from lorebase.plans.conversation import ORACLES as CONVERSATION, embedded
from lorebase.session import fresh_path
from lorebase.sources import pages, publish
from lorebase.sources.extract import accepted
from lorebase.sources.readers import stream_table
from lorebase.streaming.streams import (
    append_stream,
    assemble_stream,
    bucket_count,
    index_rows,
    ingest_stream,
    sync_changes,
    sync_index,
    write_buckets,
)


def _finished(spark: SparkSession, stream: DataFrame, name: str) -> DataFrame:
    """What a stream writes for the input there is now."""
    target = fresh_path(spark, name)
    append_stream(stream, target, fresh_path(spark, f"{name}-state")).awaitTermination()
    return spark.read.schema(stream.schema).parquet(target)


def stream_done_items(spark: SparkSession, sf: str) -> DataFrame:
    events = roles.as_response_events(stream_table(spark, sf, "events"))
    return _finished(spark, ops.done_items(events), "done")


def stream_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """Turns streamed word by word and put together again."""
    turns = stream_table(spark, sf, "conversations").withColumn("_words", F.split("text", " "))
    words = roles.as_deltas(turns, F.col("seq") == F.size("_words") - 1).withColumn(
        "ts", F.lit("2024-01-01 00:00:00").cast("timestamp")
    )
    return _finished(spark, assemble_stream(words), "deltas")


def stream_changes(spark: SparkSession, sf: str) -> DataFrame:
    """A published table brought to the second version by a stream of its change feed."""
    root, feed = fresh_path(spark, "synced"), fresh_path(spark, "feed")
    publish.publish(roles.first_version(spark, sf), root)
    ingest.snapshot_changes(spark, sf).write.parquet(feed)
    changes = spark.readStream.schema(spark.read.parquet(feed).schema).parquet(feed)
    sync_changes(changes, root, ["product_name"], fresh_path(spark, "synced-state")).awaitTermination()
    return publish.read_version(spark, root)


def stream_index(spark: SparkSession, sf: str) -> DataFrame:
    """A vector index brought to the second version by a stream of the change feed."""
    path, feed = fresh_path(spark, "index"), fresh_path(spark, "feed")
    first = roles.first_version(spark, sf)
    buckets = bucket_count(first)
    write_buckets(index_rows(first, ["product_name"], "product_doc", buckets), path)
    ingest.snapshot_changes(spark, sf).write.parquet(feed)
    changes = spark.readStream.schema(spark.read.parquet(feed).schema).parquet(feed)
    sync_index(changes, path, ["product_name"], "product_doc", fresh_path(spark, "index-state"), buckets).awaitTermination()
    return spark.read.parquet(path).select("product_name", fingerprint(F.col("embedding")).alias("embedding"))


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """New document files read, extracted and appended by a stream."""
    target = fresh_path(spark, "ingested")
    ingest_stream(spark, roles.page_files(spark, sf), target, fresh_path(spark, "ingested-state")).awaitTermination()
    return spark.read.schema("product_name STRING, product_doc STRING").parquet(target)


def stream_pages(spark: SparkSession, sf: str) -> DataFrame:
    """The pages of new document files appended by a stream, and the documents they make."""
    arriving = pages.stream_pages(spark, roles.paged_files(spark, sf), split_bytes=ingest.PAGE_SPLIT)
    return accepted(pages.documents_of(_finished(spark, arriving, "pages")))


QUERIES = {f.__name__: f for f in (stream_done_items, stream_deltas, stream_changes, stream_index, stream_ingest, stream_pages)}

ORACLES = {
    "stream_done_items": CONVERSATION["done_items"],
    "stream_deltas": f"SELECT *, 'done' AS status FROM ({CONVERSATION['assemble_deltas']})",
    "stream_changes": ingest.SECOND,
    "stream_index": f"""
        WITH s AS ({ingest.SECOND})
        SELECT product_name, string_agg(CAST(CAST(round(coalesce(weight, 0) * 1000000) AS BIGINT) AS VARCHAR), ',' ORDER BY bucket) AS embedding
        FROM (SELECT product_name, unnest(range(64)) AS bucket FROM s)
        LEFT JOIN ({embedded("SELECT product_name, product_doc AS text FROM s", "product_name")}) USING (product_name, bucket) GROUP BY 1""",
    "stream_ingest": ingest.PAGE_FILES,
    "stream_pages": ingest.PAGED_FILES,
}
