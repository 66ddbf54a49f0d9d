import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lorebase.session import fresh_path
from lorebase.sources import publish


def table(spark, data):
    return spark.createDataFrame(data, "k STRING, v STRING")


def test_versions_ledger_and_schema(spark):
    root = fresh_path(spark, "t")
    assert publish.latest_version(spark, root) is None
    with pytest.raises(ValueError):
        publish.read_version(spark, root)
    assert publish.publish(table(spark, [("a", "1"), ("b", None)]), root, "CREATE") == 0
    wider = publish.read_version(spark, root).withColumn("n", F.lit(1))
    assert publish.publish(wider, root) == 1
    assert publish.read_version(spark, root).columns == ["k", "v", "n"]
    assert publish.read_version(spark, root, 0).columns == ["k", "v"]
    history = [tuple(r) for r in publish.history(spark, root).select("version", "operation", "mode", "row_count").collect()]
    assert history == [(1, "WRITE", "overwrite", 2), (0, "CREATE", "overwrite", 2)]


def test_an_unfinished_version_is_invisible(spark):
    root = fresh_path(spark, "t")
    publish.publish(table(spark, [("a", "1")]), root)
    table(spark, [("x", "9")]).write.parquet(f"{root}/v1")
    assert rows(publish.read_version(spark, root)) == [("a", "1")]
    assert publish.publish(table(spark, [("b", "2")]), root) == 1
    assert rows(publish.read_version(spark, root)) == [("b", "2")]


def test_a_batch_is_published_once(spark):
    root = fresh_path(spark, "t")
    first = publish.publish(table(spark, [("a", "1")]), root, source="s", batch_id=3)
    assert publish.publish(table(spark, [("a", "1")]), root, source="s", batch_id=3) == first
    assert publish.history(spark, root).count() == 1


def test_catalog_table_replaces_its_schema(spark):
    publish.publish_catalog(table(spark, [("a", "1")]), "lore_t")
    publish.publish_catalog(spark.range(2), "lore_t")
    assert spark.table("lore_t").columns == ["id"]
    spark.sql("DROP TABLE lore_t")


def test_tables_bucketed_alike_join_without_a_shuffle(spark):
    for name in ("lore_left", "lore_right"):
        publish.publish_catalog(table(spark, [(f"k{i}", name) for i in range(50)]), name, ["k"], 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("lore_left").join(spark.table("lore_right"), "k")
        assert joined.count() == 50 and "Exchange" not in plan(joined, "simple")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("DROP TABLE lore_left")
        spark.sql("DROP TABLE lore_right")


def test_values_that_only_swap_columns_with_a_null_are_changes(spark):
    old = spark.createDataFrame([("a", None, "x"), ("b", "x", "y")], "k STRING, v STRING, w STRING")
    new = spark.createDataFrame([("a", "x", None), ("b", "x", "y")], "k STRING, v STRING, w STRING")
    assert rows(publish.snapshot_changes(old, new, ["k"], 1), "k", "_change_type") == [("a", "update_postimage"), ("a", "update_preimage")]


def test_change_rows(spark):
    old = table(spark, [("same", "1"), ("gone", "2"), ("new text", "3"), ("null", None), ("to null", "4")])
    new = table(spark, [("same", "1"), ("come", "5"), ("new text", "6"), ("null", None), ("to null", None)])
    assert rows(publish.snapshot_changes(old, new, ["k"], 7), "k", "v", "_change_type", "_commit_version") == sorted(
        [
            ("come", "5", "insert", 7),
            ("gone", "2", "delete", 7),
            ("new text", "3", "update_preimage", 7),
            ("new text", "6", "update_postimage", 7),
            ("to null", "4", "update_preimage", 7),
            ("to null", None, "update_postimage", 7),
        ],
        key=lambda r: [(v is None, str(v)) for v in r],
    )


@pytest.mark.parametrize("seed", range(4))
def test_applying_the_changes_gives_the_new_snapshot(spark, seed):
    dice = random.Random(seed)

    def snapshot():
        return table(spark, [(f"k{i}", dice.choice(["x", "y", "", None])) for i in range(60) if dice.random() < 0.7])

    old, new = snapshot(), snapshot()
    changes = publish.snapshot_changes(old, new, ["k"], 1)
    assert rows(publish.apply_changes(old, changes, ["k"])) == rows(new)


def test_the_last_change_of_a_key_counts(spark):
    base = table(spark, [("a", "0"), ("b", "0")])
    changes = spark.createDataFrame(
        [("a", "1", "update_postimage", 1), ("a", "1", "delete", 2), ("b", "0", "delete", 1), ("b", "9", "insert", 3)],
        "k STRING, v STRING, _change_type STRING, _commit_version BIGINT",
    )
    assert rows(publish.apply_changes(base, changes, ["k"])) == [("b", "9")]


def test_gate(spark):
    source = table(spark, [("a", "1"), ("b", "2")])
    assert rows(publish.publish_gate(source, source, "k")) == [(2, 2, 0, 0, True)]
    bad = table(spark, [("a", "1"), ("a", "2"), (None, "3")])
    assert rows(publish.publish_gate(source, bad, "k")) == [(2, 3, 1, 2, False)]
    assert rows(publish.publish_gate(source, source.filter("false"), "k")) == [(2, 0, 0, 0, False)]
    assert publish.schema_matches(source, bad) and not publish.schema_matches(source, source.select("v", "k"))


def test_changes_in_nested_nulls_and_null_keys(spark):
    before = spark.sql("""SELECT * FROM VALUES
        ('a', named_struct('a', 'v', 'b', CAST(NULL AS STRING)), array(1), TIMESTAMP '2024-01-01 00:00:00.000001'),
        ('b', named_struct('a', 'v', 'b', 'w'), array(1, NULL), TIMESTAMP '2024-01-01 00:00:00'),
        ('c', named_struct('a', 'v', 'b', 'w'), array(1), TIMESTAMP '2024-01-01 00:00:00.000001'),
        (NULL, NULL, NULL, NULL) AS t(k, s, l, t)""")
    after = spark.sql("""SELECT * FROM VALUES
        ('a', named_struct('a', CAST(NULL AS STRING), 'b', 'v'), array(1), TIMESTAMP '2024-01-01 00:00:00.000001'),
        ('b', named_struct('a', 'v', 'b', 'w'), array(1), TIMESTAMP '2024-01-01 00:00:00'),
        ('c', named_struct('a', 'v', 'b', 'w'), array(1), TIMESTAMP '2024-01-01 00:00:00.000002') AS t(k, s, l, t)""")
    feed = publish.snapshot_changes(before, after, ["k"], 1)
    kinds = rows(feed, "k", "_change_type")
    both = [(k, kind) for k in "abc" for kind in ("update_postimage", "update_preimage")]
    assert kinds == sorted([*both, (None, "delete")], key=lambda r: [(v is None, str(v)) for v in r])
    assert rows(publish.apply_changes(before, feed, ["k"])) == rows(after)
    assert rows(publish.apply_changes(after, publish.snapshot_changes(after, before, ["k"], 2), ["k"])) == rows(before)


def test_content_gate(spark):
    rows_ = [(i, f"t{i % 7}", None if i % 5 == 0 else i / 2) for i in range(200)]
    source = spark.createDataFrame(rows_, "k INT, t STRING, v DOUBLE").repartition(3)

    def failed(changed):
        found = publish.content_gate(source, spark.createDataFrame(changed, "k INT, t STRING, v DOUBLE").repartition(5))
        return sorted(r.column for r in found.filter("NOT passed").collect())

    assert failed(rows_[::-1]) == []
    assert failed([*rows_[:-1], (199, "other", 99.5)]) == ["*", "t"]
    assert failed(rows_[:-1]) == ["*", "k", "t", "v"] and failed([*rows_, rows_[3]]) == ["*", "k", "t", "v"]
    assert failed([*rows_[:-1], rows_[0]]) == ["*", "k", "t", "v"]
    assert failed([(k, t, 0.0 if v is None else v) for k, t, v in rows_]) == ["*", "v"]
    # Values that only change places are told by the rows.
    swapped = [(rows_[1][0], rows_[2][1], rows_[1][2]), (rows_[2][0], rows_[1][1], rows_[2][2])]
    assert failed([rows_[0], *swapped, *rows_[3:]]) == ["*"]
    less = publish.content_gate(source, source.drop("v"))
    assert rows(less.filter("NOT passed"), "column") == [("*",), ("v",)]
    empty = publish.content_gate(source.limit(0), source.limit(0))
    assert rows(empty, "column", "rows_in", "checksum", "passed") == [(c, 0, "0", True) for c in ("*", "k", "t", "v")]
    sketched = {r.column: r for r in publish.content_sums(source, sketches=True).collect()}
    assert sketched["t"].distinct == 7 and sketched["v"].nulls == 40 and sketched["t"].quantiles is None
    assert abs(sketched["k"].quantiles[0] - 100) < 3
