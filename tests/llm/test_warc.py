"""Archives give back every page; equal payloads are stored once; the format is that of the standard."""

import hashlib
import struct

import duckdb
import pytest
import zstandard

from lorebase.llm import queries, warc


def wanted(rows):
    largest, found = {}, []
    for key, _, html in rows:
        if key is not None and len((html or "").encode()) >= 1000:
            largest[html] = max(key, largest.get(html, key))
    for key, _, html in rows:
        data = (html or "").encode()
        top = largest.get(html) if key is not None else None
        refers_to = top if top is not None and top != key else None
        kind = "response" if refers_to is None else "revisit"
        found.append((key, kind, refers_to, len(data), hashlib.sha1(data).hexdigest()))
    return sorted(found, key=str)


DIGEST = ("page_id", "record_type", "refers_to", "payload_bytes", "payload_digest")


@pytest.mark.parametrize("archive_bytes", [warc.ARCHIVE_BYTES, 30_000])
def test_pages(spark, monkeypatch, archive_bytes):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive_bytes)
    big, small, edge = "é<p>text " * 300, "x" * 999, "y" * 1000
    rows = [(k, f"http://a/{k % 7}?q=1", f"<html>page {k} " + "word " * (k % 90) * 5) for k in range(300)]
    rows += [(k, "http://b/ c\r\nd", html) for k, html in enumerate([big, small, edge, big, small, edge, "\r\n\r\n", ""], 400)]
    rows += [(500, None, None), (None, "http://n", big), (401, "http://same", small), (403, "http://b/", big)]
    rows += [(-k, "u", big) for k in range(1, 40)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "page_id BIGINT, url STRING, html STRING, payload INT")
    listing = warc.write(df)
    found = warc.read(listing)
    assert sorted(map(tuple, found.select(*DIGEST).collect()), key=str) == wanted(rows)
    payloads = {(r.page_id, r.payload.decode()) for r in found.where("payload IS NOT NULL").collect()}
    assert payloads == {(k, h or "") for (k, _, h) in rows if (k, "response") in {(w[0], w[1]) for w in wanted(rows)}}
    urls = {r.page_id: r.url for r in found.collect()}
    assert urls[3] == "http://a/3?q=1" and urls[500] is None and urls[402] == "http://b/%20c%0D%0Ad"
    assert warc.read(warc.write(df.limit(0))).collect() == []


def test_an_archive_is_readable_by_frames(tmp_path):
    pages = [warc.page_record(k, f"http://a/{k}", f"<p>{'some words ' * (k % 40)}{k}".encode(), "0" * 40, None, "d") for k in range(900)]
    path = str(tmp_path / "one.warc.zst")
    size = warc.write_archive(path, pages, "2020-01-01T00:00:00Z")
    data = open(path, "rb").read()
    magic, length = struct.unpack("<II", data[:8])
    assert (size, magic) == (len(data), 0x184D2A5D)
    table = zstandard.ZstdCompressionDict(data[8 : 8 + length])
    assert table.dict_id() != 0
    first = zstandard.ZstdDecompressor(dict_data=table).decompressobj().decompress(data[8 + length :])
    assert first.startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    assert [block for headers, block in warc.read_archive(path)][1:] == [warc.parsed(p)[1] for p in pages]
    plain = sum(len(zstandard.ZstdCompressor(level=3).compress(p)) for p in pages)
    assert len(data) - length < 0.8 * plain


def test_a_damaged_archive_is_an_error(tmp_path):
    page = warc.page_record(1, "http://a", b"text", hashlib.sha1(b"other").hexdigest(), None, "d")
    path = str(tmp_path / "one.warc.zst")
    warc.write_archive(path, [page], "d")
    with pytest.raises(ValueError, match="differ"):
        [warc.page_of(*r) for r in list(warc.read_archive(path))[1:]]
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-5])
    with pytest.raises(ValueError, match="inside"):
        list(warc.read_archive(path))


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{folder}/pages.parquet'")
    result = con.execute(queries.ORACLES["op5_warc"])
    columns = [d[0] for d in result.description]
    assert sorted(map(tuple, queries.op5_warc(spark, folder).select(*columns).collect())) == sorted(result.fetchall())


def test_a_hot_payload_is_spread(spark):
    """Half of the rows share a payload: with small thresholds adaptive execution splits their join."""
    settings = {
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        rows = [(k, "u", "x" * 1500 if k % 2 else f"{k}" * 300) for k in range(8000)]
        listing = warc.write(spark.createDataFrame(rows, "page_id BIGINT, url STRING, html STRING").repartition(8))
        assert max(r.records for r in listing.collect()) < 8000 / 5
        assert warc.read(listing, "record_type").where("record_type = 'revisit'").count() == 3999
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
