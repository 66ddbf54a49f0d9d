"""WARC archives, compressed record by record with a Zstandard dictionary of the archive's own records.

An archive is a file of its own: a skippable frame with the dictionary, then one frame per record, so any record can be read
by its place and the dictionary alone. The dictionary is trained on records spread evenly over the archive; where these are
too few to train on, their last bytes serve as a raw dictionary. The first record is a warcinfo record.

Payloads that are equal, by SHA-1 and length, and have at least `least` bytes are archived once: the row with the largest id is the
response, the others are revisit records that refer to it and keep the HTTP header with the payload's length. Rows are
compared by joining them with the largest id of each repeated digest. These are written first: a join of two plain shuffles is one whose
hot digest adaptive execution splits, which it doesn't do where one side is still being added up.

Cases: a null payload counts as empty; a row with a null id is always a response and nothing refers to it; rows that
share the largest id of a payload are all responses; a null URL gives a record without a target; blanks and control characters in a
URL are percent-encoded; other columns are ignored; an empty table gives no archive and no row.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lorebase.llm.common import Batches, Written, in_batches, map_batches, rows_of
from lorebase.llm.files import attempt_path, one_file_a_task, open_input, open_output
from lorebase.session import fresh_path

# Fixed values of the archive format.
DICTIONARY_FRAME = 0x184D2A5D
VERSION = b"WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes of records in one archive before compression, of a dictionary, and of the records it is trained on.
ARCHIVE_BYTES, DICTIONARY_BYTES, TRAINING_BYTES = 16 << 20, 64 << 10, 4 << 20
LEVEL = 3
READ = 1 << 20


def record(headers: list[tuple[str, str]], block: bytes) -> bytes:
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return VERSION + lines.encode() + f"Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def record_id(key: int | None) -> str:
    return f"<urn:page:{'' if key is None else key}>"


def key_of(identifier: str) -> int | None:
    digits = identifier.removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def page_record(key: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """A response with its payload, or a revisit of another record with the HTTP header only."""
    headers = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(key))]
    headers.append(("WARC-Date", date))
    if url is not None:
        headers.append(("WARC-Target-URI", quote(url, safe="".join(map(chr, range(33, 127))))))
    headers.append(("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()))
    if refers_to is not None:
        headers += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    headers.append(("Content-Type", "application/http; msgtype=response"))
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    return record(headers, http.encode() + (payload if refers_to is None else b""))


def dictionary(records: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on records at even distances, as many as TRAINING_BYTES hold."""
    total = sum(map(len, records))
    step = max(1, -(-total // TRAINING_BYTES))
    samples = records[::step]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples, level=LEVEL)
    except zstandard.ZstdError:
        raw = b"".join(one[-DICTIONARY_BYTES:] for one in samples[-8:])[-DICTIONARY_BYTES:]
        return zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def write_archive(path: str, records: list[bytes], date: str) -> int:
    """Write one archive; its size in bytes."""
    fields = b"software: lorebase\r\nformat: WARC File Format 1.1\r\n"
    about = [("WARC-Type", "warcinfo"), ("WARC-Record-ID", "<urn:archive:info>"), ("WARC-Date", date)]
    trained = dictionary(records)
    content = trained.as_bytes()
    trained.precompute_compress(level=LEVEL)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_checksum=True)
    with open_output(path) as out:
        out.write(struct.pack("<II", DICTIONARY_FRAME, len(content)) + content)
        for one in [record([*about, ("Content-Type", "application/warc-fields")], fields), *records]:
            out.write(compressor.compress(one))
        return out.tell()


def read_archive(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of every record, decompressed one at a time."""
    with open_input(path) as file:
        magic, length = struct.unpack("<II", file.read(8))
        if magic != DICTIONARY_FRAME:
            raise ValueError(f"{path}: no dictionary frame")
        content = file.read(length)
        decompressor = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        frame, parts, begun = decompressor.decompressobj(), [], False
        while data := file.read(READ):
            view, place = memoryview(data), 0
            while place < len(view):
                piece = view[place : place + 4096]
                parts.append(frame.decompress(piece))
                begun = True
                place += len(piece)
                if frame.eof:
                    place -= len(frame.unused_data)
                    yield parsed(b"".join(parts))
                    frame, parts, begun = decompressor.decompressobj(), [], False
        if begun:
            raise ValueError(f"{path}: ends inside a record")


def parsed(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    if not head.startswith(VERSION):
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    return headers, rest[: int(headers["Content-Length"])]


def page_of(headers: dict[str, str], block: bytes) -> tuple:
    """(id, url, record type, id referred to, payload length, SHA-1 in hex, payload) of a response or revisit record."""
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(http.rpartition(b"Content-Length: ")[2])
    digest = base64.b32decode(headers["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    refers_to = headers.get("WARC-Refers-To")
    key = key_of(headers["WARC-Record-ID"])
    if refers_to is None and (len(payload) != length or hashlib.sha1(payload).hexdigest() != digest):
        raise ValueError(f"record {key}: payload and digest differ")
    return (
        key,
        headers.get("WARC-Target-URI"),
        headers["WARC-Type"],
        key_of(refers_to) if refers_to else None,
        length,
        digest,
        payload if refers_to is None else None,
    )


def write_step(folder: str, date: str):
    schema = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def rows(batches: Batches) -> Iterator[tuple]:
        task, number, records, size = TaskContext.get().partitionId(), 0, [], 0

        def written() -> tuple:
            path = attempt_path(folder, "pages", task, number, ".warc.zst")
            return path, len(records), write_archive(path, records, date)

        for key, url, payload, digest, refers_to in rows_of(batches):
            records.append(page_record(key, url, payload, digest, refers_to, date))
            size += len(records[-1])
            if size >= ARCHIVE_BYTES:
                yield written()
                number, records, size = number + 1, [], 0
        if records:
            yield written()

    return lambda batches: in_batches(rows(batches), schema)


def write(
    df: DataFrame,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    least: int = 1000,
    date: str = "1970-01-01T00:00:00Z",
    folder: str | None = None,
) -> DataFrame:
    """Archive every row; the listing of the archives (path, records, bytes), stored."""
    folder = folder or fresh_path(df.sparkSession, "archives")
    pages = df.select(
        F.col(key).cast("long").alias("key"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    repeated = (
        pages.select("key", "digest", F.octet_length("payload").alias("bytes"))
        .where((F.col("bytes") >= least) & F.col("key").isNotNull())
        .groupBy("digest", "bytes")
        .agg(F.max("key").alias("response"), F.min("key").alias("lowest"))
        .where("lowest < response")
        .drop("lowest")
    )
    repeated = Written(repeated, "repeated-payloads").df
    marked = (
        pages.withColumn("bytes", F.octet_length("payload"))
        .join(repeated, ["digest", "bytes"], "left")
        .select("key", "url", "payload", "digest", F.expr("CASE WHEN key < response THEN response END").alias("refers_to"))
    )
    return Written(map_batches(marked, "path STRING, records BIGINT, bytes BIGINT", write_step(folder, date)), "archive-listing").df


FIELDS = ("page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")
TYPES = {
    "page_id": pa.int64(),
    "url": pa.string(),
    "record_type": pa.string(),
    "refers_to": pa.int64(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "payload": pa.binary(),
}
SQL_TYPES = {pa.int64(): "BIGINT", pa.string(): "STRING", pa.binary(): "BINARY"}


def read(listing: DataFrame, *fields: str) -> DataFrame:
    """The fields asked for, all by default, of every page record in the archives of a listing.

    A payload that doesn't fit its digest is an error; a revisit record has no payload."""
    fields = fields or FIELDS
    places = [FIELDS.index(name) for name in fields]
    schema = pa.schema([(name, TYPES[name]) for name in fields])

    def rows(batches: Batches) -> Iterator[tuple]:
        for (path,) in rows_of(batches):
            for headers, block in read_archive(path):
                if headers["WARC-Type"] in ("response", "revisit"):
                    page = page_of(headers, block)
                    yield tuple(page[place] for place in places)

    columns = ", ".join(f"{name} {SQL_TYPES[TYPES[name]]}" for name in fields)
    return map_batches(one_file_a_task(listing.select("path")), columns, lambda batches: in_batches(rows(batches), schema))
