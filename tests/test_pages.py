"""Pages and documents are the same whatever the cuts; names are looked up in the listing; streams read each file once."""

import os
import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lorebase.sources import pages
from lorebase.sources.extract import extract_documents
from lorebase.sources.readers import read_documents
from lorebase.streaming.streams import append_stream


def content(draw):
    return "\f".join(draw.choice(["", " ", "word", "Zeile\n", "日本" * 9, "x" * 40]) for _ in range(draw.randrange(9))).encode()


@pytest.fixture
def folder(tmp_path):
    draw = random.Random(6)
    root = tmp_path / "docs"
    root.mkdir()
    for number in range(40):
        (root / f"d{number}.pdf").write_bytes(content(draw))
    (root / "end.pdf").write_bytes(b"a\f")
    (root / "start.pdf").write_bytes(b"\f\fb")
    (root / "empty.pdf").write_bytes(b"")
    (root / "bad.pdf").write_bytes(b"fine\f\xff\xfe\fmore")
    (root / "twice.pdf.pdf").write_bytes(b"two")
    (root / "other.PDF").write_bytes(b"no")
    (root / "sub").mkdir()
    (root / "sub" / "s.pdf").write_bytes(b"no")
    return str(root)


@pytest.mark.parametrize("split", [16, 90, 1 << 20])
def test_documents(spark, folder, split):
    read = pages.read_pages(spark, folder, split_bytes=split)
    whole = {r.product_name: r for r in extract_documents(read_documents(spark, folder)).collect()}
    found = {r.product_name: r for r in pages.documents_of(read).collect()}
    assert len(found) == 45
    for name, row in found.items():
        # Spark's file source leaves out files without a byte.
        assert row.product_doc == (whole[name].product_doc if name in whole else ""), name
        assert name not in whole or (row.error is None) == (whole[name].error is None)
    assert found["bad"].error.startswith("UnicodeDecodeError") and found["twice"].product_doc == "two"
    want = [(f"{folder}/start.pdf".split("/")[-1], place, text) for place, text in ((0, ""), (1, ""), (2, "b"))]
    got = read.filter("product_name = 'start'").select(F.element_at(F.split("path", "/"), -1), "place", "text")
    assert sorted(map(tuple, got.collect())) == want


def test_a_long_document_is_many_tasks(spark, tmp_path):
    lines = [f"page {n} " * 20 for n in range(3000)]
    (tmp_path / "long.pdf").write_bytes("\f".join(lines).encode())
    read = pages.read_pages(spark, str(tmp_path), split_bytes=50_000)
    tasks = read.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(tasks) == -(-os.path.getsize(tmp_path / "long.pdf") // 50_000) and sum(r["count"] for r in tasks) == 3000
    assert max(r["count"] for r in tasks) < 2 * min(r["count"] for r in tasks) + 200
    assert pages.documents_of(read).first().product_doc == "".join(f"{line}\n" for line in lines).strip()


def test_many_small_stretches_share_tasks(spark, tmp_path, monkeypatch):
    """The number of tasks is bounded where documents are cut into far more stretches than that; no page is lost or read twice."""
    monkeypatch.setattr(pages, "TASKS", 8)
    lines = [[f"d{n} p{m} " + "x" * (m * 7 % 50) for m in range(n % 40)] for n in range(120)]
    for number, some in enumerate(lines):
        (tmp_path / f"d{number}.pdf").write_bytes("\f".join(some).encode())
    options = {"path": str(tmp_path), "splitbytes": "64"}
    for tasks in (
        pages.PageSource(options).reader(None).partitions(),
        pages.PageSource(options).streamReader(None).partitions({"time": -1, "path": ""}, {"time": 1 << 62, "path": ""}),
    ):
        assert len(tasks) <= 10
        assert any(start for task in tasks for _, start, _, _ in task.parts)
        # Within a task a document is one stretch.
        assert all(len({path for path, *_ in task.parts}) == len(task.parts) for task in tasks)
    found = {r.product_name: r.product_doc for r in pages.documents_of(pages.read_pages(spark, str(tmp_path), split_bytes=64)).collect()}
    assert found == {f"d{n}": "".join(f"{line}\n" for line in some).strip() for n, some in enumerate(lines)}


def test_names_are_looked_up_in_the_listing(spark, folder):
    read = pages.read_pages(spark, folder, split_bytes=1 << 20)
    assert {r.product_name for r in read.filter("product_name IN ('start', 'end') AND place >= 0").collect()} == {"start", "end"}
    reader = pages.PageSource({"path": folder, "splitbytes": "1"}).reader(None)
    left = list(reader.pushFilters([pages.EqualTo(("product_name",), "end"), pages.EqualTo(("place",), 0)]))
    assert [one.attribute for one in left] == [("place",)]
    assert {path.rsplit("/")[-1] for stretch in reader.partitions() for path, *_ in stretch.parts} == {"end.pdf"}
    assert rows(read.filter("product_name = 'none'")) == []
    # Spark leaves the filter to the source.
    assert "+- Filter" not in (shown := plan(read.filter("product_name IN ('start', 'end')"), "simple")) and "*(1) Filter" not in shown


def test_another_kind_of_document(spark, tmp_path):
    class Lines:
        whole = True

        def pages(self, file, start, end, size):
            for place, line in enumerate(file.read().splitlines()):
                yield place, line

    class LineSource(pages.PageSource):
        kind = Lines()

        @classmethod
        def name(cls):
            return "line_documents"

    (tmp_path / "a.txt").write_bytes(b"one\ntwo")
    read = pages.read_pages(spark, str(tmp_path), ".txt", 2, LineSource)
    assert rows(read, "product_name", "place", "text") == [("a", 0, "one"), ("a", 1, "two")]


def test_nothing_to_read(spark, tmp_path):
    assert pages.documents_of(pages.read_pages(spark, str(tmp_path))).collect() == []
    assert pages.documents_of(pages.read_pages(spark, str(tmp_path / "missing"))).collect() == []


def test_a_stream_reads_each_file_once(spark, tmp_path):
    source, target, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    source.mkdir()

    def put(name, text, time):
        (source / name).write_bytes(text)
        os.utime(source / name, (time, time))

    def run():
        append_stream(pages.stream_pages(spark, str(source), split_bytes=2), target, state).awaitTermination(120)
        return rows(pages.documents_of(spark.read.schema(pages.PAGES).parquet(target)), "product_name", "product_doc")

    put("a.pdf", b"one\ftwo\fthree", 1_700_000_000)
    put("b.pdf", b"x", 1_700_000_000)
    assert run() == [("a", "one\ntwo\nthree"), ("b", "x")]
    assert run() == [("a", "one\ntwo\nthree"), ("b", "x")]
    put("c.pdf", b"new\f", 1_700_000_000)
    put("d.txt", b"no", 1_700_000_009)
    assert run() == [("a", "one\ntwo\nthree"), ("b", "x"), ("c", "new")]
