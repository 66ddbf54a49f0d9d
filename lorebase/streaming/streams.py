"""Streams: incremental ingest, delta assembly, change sync. Filters on streams are the batch functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lorebase.functions.vectors import DIM, embed
from lorebase.session import exists, remove
from lorebase.sources.extract import accepted, extract_documents, form_feed_pages
from lorebase.sources.publish import apply_changes, latest_version, publish, read_version
from lorebase.sources.readers import stream_documents

ASSEMBLED = "conv_id BIGINT, item_id BIGINT, text STRING, n_deltas BIGINT, status STRING"
DELTA_STATE = "count BIGINT, last BIGINT, newest_ms BIGINT, timer BIGINT"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Folders of a vector index that is kept in step, at least, and the bytes of vectors that one should hold.
BUCKETS, BUCKET_BYTES = 64, 256 << 20
#: What is added to a stream's rows by its change feed.
FEED_COLUMNS = ["_change_type", "_commit_version"]


def ingest_stream(
    spark: SparkSession,
    folder: str,
    target: str,
    checkpoint: str,
    pages: Callable[[bytes], list[str]] = form_feed_pages,
    suffix: str = ".pdf",
) -> StreamingQuery:
    """Read the documents that are new since the last run, append the accepted ones to `target`, stop."""
    extracted = extract_documents(stream_documents(spark, folder, suffix), pages, suffix)
    return append_stream(accepted(extracted), target, checkpoint)


def append_stream(stream: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Append what a stream yields for the input there is now to the table at `target`, each row once, and stop."""
    return (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start(target)
    )


class Assembly(StatefulProcessor):
    """The deltas of one item: each is a row of a map state of its own, so a batch writes what it brings and nothing else."""

    def __init__(self, idle_ms: int):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.deltas = handle.getMapState("deltas", "seq BIGINT", "delta STRING")
        self.head = handle.getValueState("head", DELTA_STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        count, last, newest, timer = self.head.get() if self.head.exists() else (0, -1, 0, 0)
        for row in rows:
            newest = max(newest, int(row.ts.timestamp() * 1000))
            if row.done:
                last = max(last, row.seq)
            if not self.deltas.containsKey((row.seq,)):
                self.deltas.updateValue((row.seq,), (row.delta,))
                count += 1
        # Only when there are enough of them is it worth looking whether none is missing.
        if 0 <= last < count and all(self.deltas.containsKey((seq,)) for seq in range(last + 1)):
            yield self.emitted(key, "done")
            if timer:
                self.handle.deleteTimer(timer)
            return
        due = max(newest + self.idle_ms, timerValues.getCurrentWatermarkInMs() + 1)
        if due != timer:
            if timer:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
        self.head.update((count, last, newest, due))

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.head.exists():
            yield self.emitted(key, "abandoned")

    def emitted(self, key: tuple, status: str) -> Row:
        """The item's text, whose state is dropped; its deltas are read once."""
        found = sorted((seq[0], delta[0]) for seq, delta in self.deltas.iterator())
        self.deltas.clear()
        self.head.clear()
        return Row(conv_id=key[0], item_id=key[1], text="".join(delta or "" for _, delta in found), n_deltas=len(found), status=status)

    def close(self) -> None:
        pass


def assemble_stream(deltas: DataFrame, idle: str = "10 minutes", idle_ms: int = 600_000) -> DataFrame:
    """Text deltas (conv_id, item_id, seq, delta, done, ts) to complete items, emitted when their last delta is in.

    The delta marked `done` tells how many there are (seq from 0); of two with one number the first counts. An item is abandoned, with
    the deltas that are there in their order, once the watermark has passed its newest event by `idle`; a delta that comes later than
    the watermark is dropped. So no item stays for ever. State is kept by RocksDB, delta by delta: a batch adds its own deltas and a
    row of four numbers per item that it touches. A null delta counts as empty.
    """
    deltas.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    typed = deltas.select("conv_id", "item_id", F.col("seq").cast("long").alias("seq"), "delta", F.coalesce("done", F.lit(False)).alias("done"), "ts")
    return typed.withWatermark("ts", idle).groupBy("conv_id", "item_id").transformWithState(Assembly(idle_ms), ASSEMBLED, "Append", "EventTime")


def sync_changes(
    changes: DataFrame, root: str, key: list[str], checkpoint: str, source: str = "change-feed"
) -> StreamingQuery:
    """Apply a stream of change rows to the versioned table at `root`, one new version per batch.

    The ledger records the batch, so a batch replayed after a failure is not applied twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        columns = [c for c in batch.columns if c not in FEED_COLUMNS]
        base = (
            batch.select(*columns).filter(F.lit(False))
            if latest_version(spark, root) is None
            else read_version(spark, root)
        )
        publish(apply_changes(base, batch, key), root, "SYNC", source, batch_id)

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def index_rows(texts: DataFrame, key: list[str], text: str, buckets: int = BUCKETS) -> DataFrame:
    """Texts as rows of a vector index: key, embedding and the bucket of the key."""
    bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")
    return embed(texts, key, text).select(*key, "embedding", bucket)


def bucket_count(texts: DataFrame, dim: int = DIM, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets an index of these texts should have; an index keeps its number for good, so leave room to grow."""
    return max(BUCKETS, -(-texts.count() * dim * 8 // bucket_bytes))


def write_buckets(index: DataFrame, path: str) -> None:
    """Store index rows, one folder per bucket; folders of other buckets stay as they are.

    Adaptive execution gives a large bucket to several tasks, which write a file each, and small ones to one.
    """
    writer = index.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("bucket").parquet(path)


def sync_index(
    changes: DataFrame, path: str, key: list[str], text: str, checkpoint: str, buckets: int = BUCKETS
) -> StreamingQuery:
    """Apply a stream of change rows to the vector index at `path`.

    Of each batch only the changed texts are embedded and only the buckets of their keys are rewritten. The new rows of
    these buckets are stored beside the index before any folder is replaced, so a batch that is repeated after a failure
    finds them and replaces the folders again. One writer at a time.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        staged = f"{path}-staged/batch={batch_id}"
        if not exists(spark, f"{staged}/_SUCCESS"):
            changed = batch.filter(F.col("_change_type") != "update_preimage").groupBy(*key).agg(
                F.max_by(F.struct("_change_type", text), "_commit_version").alias("_last")
            )
            live = changed.filter(F.col("_last._change_type") != "delete").select(*key, F.col(f"_last.{text}").alias(text))
            of_key = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int")
            touched = sorted(row.bucket for row in changed.select(of_key.alias("bucket")).distinct().collect())
            fresh = index_rows(live, key, text, buckets)
            if exists(spark, path):
                before = spark.read.parquet(path).filter(F.col("bucket").isin(touched)).select(*fresh.columns)
                names = changed.select(*[F.col(k).alias(f"_{n}") for n, k in enumerate(key)])
                same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{n}")) for n, k in enumerate(key)])
                fresh = fresh.unionByName(before.join(names, same, "left_anti"))
            fresh.write.mode("overwrite").parquet(staged)
            spark.createDataFrame([(b,) for b in touched], "bucket INT").coalesce(1).write.mode("overwrite").parquet(f"{staged}-touched")
        rows = spark.read.parquet(staged)
        filled = {row.bucket for row in rows.select("bucket").distinct().collect()}
        write_buckets(rows, path)
        for row in spark.read.parquet(f"{staged}-touched").collect():
            if row.bucket not in filled:
                remove(spark, f"{path}/bucket={row.bucket}")
        remove(spark, staged)
        remove(spark, f"{staged}-touched")

    return (
        changes.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
