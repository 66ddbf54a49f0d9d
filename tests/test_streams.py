import json
import os

import pytest
from conftest import rows

from lorebase.operators.messages import assemble_deltas, done_items, nonempty_chunks
from lorebase.sources import publish
from lorebase.streaming import streams

DELTA = "conv_id BIGINT, item_id BIGINT, seq BIGINT, delta STRING, done BOOLEAN, ts TIMESTAMP"


def drop(folder, name, records):
    """Write a file; the number in its name is its place in the stream."""
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records))
    written = 1_700_000_000 + int(name.split(".")[0])
    os.utime(folder / name, (written, written))


def run(df, name):
    query = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination(120)
    return df.sparkSession.table(name)


def test_filters_are_the_same_on_streams(spark, tmp_path):
    drop(tmp_path / "in", "1.json", [{"type": "response.output_item.done", "item": "a", "choices": []}])
    drop(tmp_path / "in", "2.json", [{"type": "x", "item": "b", "choices": ["c"]}, {"type": "y", "item": "d"}])
    schema = "type STRING, item STRING, choices ARRAY<STRING>"
    stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    batch = spark.read.schema(schema).json(str(tmp_path / "in"))
    assert rows(run(done_items(stream), "done_rows")) == rows(done_items(batch)) == [("a", [])]
    assert rows(run(nonempty_chunks(stream), "chunk_rows")) == rows(nonempty_chunks(batch)) == [("x", "b", ["c"])]


def test_items_are_assembled_across_batches(spark, tmp_path):
    def part(item, seq, text, done=False, minute=0):
        return {"conv_id": 1, "item_id": item, "seq": seq, "delta": text, "done": done, "ts": f"2024-01-01T00:{minute:02d}:00Z"}

    drop(tmp_path / "in", "1.json", [part(1, 1, "b"), part(2, 0, "lost"), part(3, 0, "x", True)])
    drop(tmp_path / "in", "2.json", [part(1, 2, "c", True, 1)])
    drop(tmp_path / "in", "3.json", [part(1, 0, "a", minute=2), part(4, 0, "late", True, 59)])
    drop(tmp_path / "in", "4.json", [part(5, 0, "end", True, 59)])
    stream = spark.readStream.schema(DELTA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    found = {r.item_id: (r.text, r.n_deltas, r.status) for r in run(streams.assemble_stream(stream), "items").collect()}
    assert found == {
        1: ("abc", 3, "done"),
        2: ("lost", 1, "abandoned"),
        3: ("x", 1, "done"),
        4: ("late", 1, "done"),
        5: ("end", 1, "done"),
    }
    batch = assemble_deltas(spark.read.schema(DELTA).json(str(tmp_path / "in")), ["conv_id", "item_id"])
    assert {r.item_id: r.text for r in batch.collect()} == {i: t for i, (t, _, _) in found.items()}


def test_a_waiting_item_outlives_batches_without_it(spark, tmp_path):
    def part(item, seq, text, second, done=False):
        return {"conv_id": 1, "item_id": item, "seq": seq, "delta": text, "done": done, "ts": f"2024-01-01T12:00:{second:02d}Z"}

    drop(tmp_path / "in", "1.json", [part(1, 0, "a", 0)])
    drop(tmp_path / "in", "2.json", [part(2, 0, "x", 1, True)])
    drop(tmp_path / "in", "3.json", [part(1, 1, "b", 2, True)])
    stream = spark.readStream.schema(DELTA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    assert rows(run(streams.assemble_stream(stream), "waiting"), "item_id", "text", "status") == [(1, "ab", "done"), (2, "x", "done")]


def parts(item, seqs, minute=0, last=None):
    return [{"conv_id": 1, "item_id": item, "seq": n, "delta": f"{n},", "done": n == last, "ts": f"2024-01-01T00:{minute:02d}:00Z"} for n in seqs]


def test_a_batch_writes_what_it_brings(spark, tmp_path):
    """State of an item of 600 deltas: each batch adds its own ones, not the text so far."""
    for number in range(6):
        drop(tmp_path / "in", f"{number}.json", parts(1, range(100 * number, 100 * number + 100), last=599))
    stream = spark.readStream.schema(DELTA).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    query = (
        streams.assemble_stream(stream).writeStream.format("memory").queryName("written").outputMode("append")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(240)
    row = spark.table("written").first()
    assert (row.text, row.n_deltas) == ("".join(f"{n}," for n in range(600)), 600)
    progress = [json.loads(p.json)["stateOperators"][0] for p in query.recentProgress]
    updated = [p["numRowsUpdated"] for p in progress if p["numRowsUpdated"]]
    # 100 deltas, the head, and the timer with its index.
    assert len(updated) >= 5 and max(updated) <= 100 + 8
    assert progress[-1]["numRowsTotal"] == 0


def test_late_missing_and_repeated_deltas(spark, tmp_path):
    folder, state = tmp_path / "in", str(tmp_path / "state")
    drop(folder, "1.json", parts(1, [0, 2], last=2) + parts(2, [1, 1, 0]) + [{**parts(3, [0])[0], "delta": None}, {**parts(3, [1], last=1)[0], "delta": "z"}])
    drop(folder, "2.json", parts(2, [1, 2], 1, last=2) + parts(4, [0], 45))
    drop(folder, "3.json", parts(5, [0], 58, last=0))
    drop(folder, "4.json", parts(1, [1], 1))
    stream = spark.readStream.schema(DELTA).option("maxFilesPerTrigger", 1).json(str(folder))
    target = str(tmp_path / "out")
    streams.append_stream(streams.assemble_stream(stream), target, state).awaitTermination(240)
    # Item 1 lacked a delta until the watermark had passed it; the delta came after that and is dropped.
    wanted = [(1, "0,2,", 2, "abandoned"), (2, "0,1,2,", 3, "done"), (3, "z", 2, "done"), (5, "0,", 1, "done")]
    assert rows(spark.read.parquet(target), "item_id", "text", "n_deltas", "status") == wanted
    # A restart goes on with the state that there is: item 4 ends with what comes now.
    drop(folder, "5.json", parts(4, [1], 59, last=1))
    stream = spark.readStream.schema(DELTA).option("maxFilesPerTrigger", 1).json(str(folder))
    streams.append_stream(streams.assemble_stream(stream), target, state).awaitTermination(240)
    assert rows(spark.read.parquet(target).filter("item_id = 4"), "text", "status") == [("0,1,", "done")]


def test_ingest_reads_each_file_once(spark, tmp_path):
    source, target, state = tmp_path / "pdf", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()
    (source / "a.pdf").write_bytes(b"one")
    (source / "empty.pdf").write_bytes(b" ")
    (source / "c.txt").write_bytes(b"no")
    streams.ingest_stream(spark, str(source), target, state).awaitTermination(120)
    assert rows(spark.read.parquet(target)) == [("a", "one")]
    (source / "b.pdf").write_bytes(b"two")
    streams.ingest_stream(spark, str(source), target, state).awaitTermination(120)
    assert rows(spark.read.parquet(target)) == [("a", "one"), ("b", "two")]


def test_ingest_looks_files_up_in_few_tasks(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for number in range(150):
        (source / f"d{number}.pdf").write_bytes(b"x")
    query = streams.ingest_stream(spark, str(source), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    tracker = spark.sparkContext.statusTracker()
    stages = {stage for job in tracker.getJobIdsForGroup(str(query.runId)) for stage in tracker.getJobInfo(job).stageIds}
    tasks = [tracker.getStageInfo(stage).numTasks for stage in stages]
    assert tasks and max(tasks) <= 16
    assert spark.read.parquet(str(tmp_path / "out")).count() == 150


def test_columns_of_a_table_may_start_with_an_underscore(spark, tmp_path):
    after = spark.createDataFrame([("a", 1)], "k STRING, _v INT")
    publish.snapshot_changes(after.limit(0), after, ["k"], 0).write.parquet(str(tmp_path / "feed"))
    changes = spark.readStream.schema(spark.read.parquet(str(tmp_path / "feed")).schema).parquet(str(tmp_path / "feed"))
    streams.sync_changes(changes, str(tmp_path / "copy"), ["k"], str(tmp_path / "state")).awaitTermination(120)
    assert rows(publish.read_version(spark, str(tmp_path / "copy"))) == [("a", 1)]


@pytest.mark.parametrize("per_batch", [1, 10])
def test_change_feed_keeps_a_copy_in_step(spark, tmp_path, per_batch):
    schema = "k STRING, v STRING, _change_type STRING, _commit_version BIGINT"
    states = [[("a", "1"), ("b", "2")], [("a", "9"), ("c", "3")], [("c", "3"), ("d", None)]]
    before = spark.createDataFrame([], "k STRING, v STRING")
    for version, state in enumerate(states):
        after = spark.createDataFrame(state, "k STRING, v STRING")
        feed = publish.snapshot_changes(before, after, ["k"], version)
        feed.coalesce(1).write.mode("append").json(str(tmp_path / "feed"))
        before = after
    changes = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).json(str(tmp_path / "feed"))
    root, state = str(tmp_path / "copy"), str(tmp_path / "state")
    streams.sync_changes(changes, root, ["k"], state).awaitTermination(120)
    assert rows(publish.read_version(spark, root)) == rows(before)
    versions = publish.history(spark, root).count()
    streams.sync_changes(changes, root, ["k"], state).awaitTermination(120)
    assert publish.history(spark, root).count() == versions


def test_an_index_is_kept_in_step(spark, tmp_path):
    def files():
        return {str(p): p.stat().st_mtime_ns for p in (tmp_path / "index").rglob("*.parquet")}

    before = spark.createDataFrame([(f"k{n}", f"text {n}") for n in range(40)] + [(None, "null key")], "k STRING, v STRING")
    after = before.filter("k <> 'k3'").unionByName(spark.createDataFrame([("k3", "other words"), ("new", "more")], "k STRING, v STRING"))
    after = after.filter("k <> 'k9'")
    path = str(tmp_path / "index")
    streams.write_buckets(streams.index_rows(before, ["k"], "v", 8), path)
    old = files()
    publish.snapshot_changes(before, after, ["k"], 1).write.parquet(str(tmp_path / "feed"))
    changes = spark.readStream.schema(spark.read.parquet(str(tmp_path / "feed")).schema).parquet(str(tmp_path / "feed"))
    streams.sync_index(changes, path, ["k"], "v", str(tmp_path / "state"), 8).awaitTermination(120)
    wanted = rows(streams.index_rows(after, ["k"], "v", 8))
    assert rows(spark.read.parquet(path), "k", "embedding", "bucket") == wanted
    kept = {p for p, changed in old.items() if files().get(p) == changed}
    assert 0 < len(kept) < len(old)
    # All rows gone: no bucket keeps a stale one.
    publish.snapshot_changes(after, after.limit(0), ["k"], 2).write.mode("append").parquet(str(tmp_path / "feed"))
    streams.sync_index(changes, path, ["k"], "v", str(tmp_path / "state"), 8).awaitTermination(120)
    assert not files()


def test_a_large_bucket_is_written_by_several_tasks(spark, tmp_path):
    texts = spark.createDataFrame([(f"k{n}", f"text {n} of {n % 13}") for n in range(4000)], "k STRING, v STRING").repartition(8)
    assert streams.bucket_count(texts) == 64 and streams.bucket_count(texts, bucket_bytes=1 << 10) == 2000
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
        streams.write_buckets(streams.index_rows(texts, ["k"], "v", 2), str(tmp_path / "index"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert all(len(list((tmp_path / "index" / f"bucket={n}").glob("*.parquet"))) > 1 for n in range(2))
    assert spark.read.parquet(str(tmp_path / "index")).count() == 4000
