import datetime

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lorebase.sources import extract
from lorebase.sources.readers import read_documents, read_policies, read_texts, scan, schema_rows


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "a.pdf").write_bytes("first page \f second".encode())
    (tmp_path / "b.PDF").write_bytes(b"upper case")
    (tmp_path / "c.txt").write_bytes(b"other kind")
    (tmp_path / "e.pdf.pdf").write_bytes("é only".encode())
    (tmp_path / "blank.pdf").write_bytes(b" \f\n ")
    (tmp_path / "broken.pdf").write_bytes(b"fine \f \xff")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "d.pdf").write_bytes(b"nested")
    return str(tmp_path)


def test_only_direct_files_with_the_exact_suffix(spark, folder):
    names = read_documents(spark, folder).select(F.element_at(F.split("path", "/"), -1))
    assert rows(names) == [("a.pdf",), ("blank.pdf",), ("broken.pdf",), ("e.pdf.pdf",)]


def test_extraction(spark, folder):
    extracted = extract.extract_documents(read_documents(spark, folder)).cache()
    assert rows(extract.accepted(extracted)) == [("a", "first page \n second"), ("e", "é only")]
    rejected = dict(rows(extract.rejects(extracted)))
    assert rejected["blank"] == "empty text"
    assert rejected["broken"].startswith("UnicodeDecodeError")
    assert rows(extract.ingest_summary(extracted)) == [(4, 2, 2, 19 + 6)]


def test_any_reader_of_bytes(spark, folder):
    def no_pages(content):
        return []

    assert extract.accepted(extract.extract_documents(read_documents(spark, folder), no_pages)).count() == 0


def test_pages_without_python(spark):
    html = "<p>a <b>b</b><script>x('</p>')</script><!-- c > d --></p>\n <style>y</style>\te"
    df = spark.createDataFrame([("http://h/x.html/y.html.html", html), ("n", None)], "url STRING, html STRING")
    assert rows(extract.extract_pages(df, "url", "html"), "product_name", "product_doc") == [("n", None), ("y", "a b e")]


def test_policy_file(spark, tmp_path):
    path = tmp_path / "policies.csv"
    path.write_text('policy,policy_details,last_updated\nA,"one, two",2023-02-20\nB,plain,2023-01-30\nC,"say ""x""",\n')
    found = {r[0]: r for r in read_policies(spark, str(path)).collect()}
    assert found["A"].policy_details == "one, two"
    assert found["B"].last_updated == datetime.date(2023, 1, 30)
    assert found["C"].last_updated is None
    assert rows(schema_rows(read_policies(spark, str(path)))) == [
        (0, "policy", "string", True),
        (1, "policy_details", "string", True),
        (2, "last_updated", "date", True),
    ]


def test_texts_are_spread_only_when_there_are_few_tasks(spark, tmp_path):
    spark.range(100).select("id", F.lit("t").alias("t")).coalesce(1).write.parquet(f"{tmp_path}/one.parquet")
    assert read_texts(spark, str(tmp_path), "one", ["id"], "t").rdd.getNumPartitions() == 4
    spark.range(100).select("id", F.lit("t").alias("t")).repartition(9).write.parquet(f"{tmp_path}/many.parquet")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        assert read_texts(spark, str(tmp_path), "many", ["id"], "t").rdd.getNumPartitions() >= 9
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before


def test_catalog_names_of_three_parts(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("lore_scanned")
    assert scan(spark, "spark_catalog.default.lore_scanned").count() == 3
    spark.sql("DROP TABLE lore_scanned")
