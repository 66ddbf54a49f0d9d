import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lorebase.operators.skew import hot_keys, positions, running_sum, split_join, whole


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, identical copies among them, a null key, and many small keys."""
    dice = random.Random(7)
    data = [(1, i // 7, 1) for i in range(400)] + [(None, i, 2) for i in range(5)]
    data += [(dice.randrange(2, 90), dice.randrange(1000), dice.randrange(5)) for _ in range(800)]
    return spark.createDataFrame(data, "k BIGINT, o BIGINT, v BIGINT").repartition(5).cache()


def test_hot_keys(skewed):
    assert rows(hot_keys(skewed, ["k"], 100)) == [(1, 400)]
    assert hot_keys(skewed, ["k"], 1_000) is None


def test_hot_keys_of_a_large_table_are_estimated(spark):
    df = spark.range(3_000_000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"))
    ((key, n),) = rows(hot_keys(df, ["k"], 500_000))
    assert key is None and 900_000 < n < 1_100_000
    assert hot_keys(df, ["k"], 1_500_000) is None


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_split_join_equals_join(spark, skewed, how):
    right = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "n")], "k BIGINT, w STRING")
    split = split_join(skewed, right, ["k"], how, rows=20)
    assert rows(split) == rows(skewed.join(right, ["k"], how).select(*split.columns))


@pytest.mark.parametrize("how", ["left", "left_anti", "inner"])
def test_split_join_spreads_null_keys(spark, how):
    left = spark.range(300).select(F.when(F.col("id") % 3 > 0, F.col("id") % 7).alias("k"), "id")
    right = spark.createDataFrame([(0, "a"), (1, "b"), (None, "n")], "k BIGINT, w STRING")
    split = split_join(left, right, ["k"], how, rows=60)
    assert "_salt" in plan(split)
    assert rows(split) == rows(left.join(right, ["k"], how).select(*split.columns))


def test_split_join_deals_a_hot_key_out(spark, skewed):
    right = spark.createDataFrame([(1, "a")], "k BIGINT, w STRING")
    assert "_salt" in plan(split_join(skewed, right, ["k"], rows=20))
    assert "_salt" not in plan(split_join(skewed, right, ["k"]))


@pytest.mark.parametrize("limit", [10, 50, 1_000_000])
def test_running_sum_over_slots(skewed, limit):
    keyed = skewed.filter("k IS NOT NULL").withColumn("id", F.monotonically_increasing_id())
    summed = running_sum(keyed, ["k"], ["o", "id"], F.col("v"), "s", limit).toPandas().sort_values(["k", "o", "id"])
    assert (summed.groupby("k")["v"].cumsum() == summed["s"]).all()
    assert len(summed) == keyed.count()


def test_positions_are_dense(spark):
    df = spark.range(1_000).select((F.col("id") % 2).alias("k"), F.col("id").alias("o"))
    found = positions(df, ["k"], ["o"], "p", 30).toPandas()
    for _, group in found.sort_values("o").groupby("k"):
        assert list(group["p"]) == list(range(1, 501))


def test_whole_division_is_exact(spark):
    big = 2**62 + 1
    assert spark.range(1).select(whole(F.lit(big), 2).alias("h")).first()[0] == 2**61


def test_stored_tables_can_be_released(spark, tmp_path):
    import os

    from lorebase.session import release, session_folder, stored

    kept = stored(spark.range(3).filter("id > 5"))
    assert kept.count() == 0 and kept.columns == ["id"]
    folder = session_folder(spark)
    assert os.path.isdir(folder)
    release(spark)
    assert not os.path.isdir(folder)
