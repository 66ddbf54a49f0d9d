"""The table function folds as the DataFrame form does."""

import random

from conftest import rows
from pyspark.sql import functions as F

from lorebase.functions.runs import create_fold_runs
from lorebase.operators import messages as ops


def test_fold_in_sql(spark):
    draw = random.Random(2)
    made = [
        (conv, seq, draw.choice(["assistant", "assistant", "user", None]), draw.choice(["a", "b", "", "tool call", None]))
        for conv in range(30)
        for seq in range(draw.randrange(1, 12))
    ]
    draw.shuffle(made)
    spark.createDataFrame(made, "conv_id BIGINT, seq BIGINT, role STRING, content STRING").repartition(3).createOrReplaceTempView("some_messages")
    create_fold_runs(spark)
    found = spark.sql("SELECT * FROM fold_runs(TABLE(some_messages) PARTITION BY conv_id ORDER BY seq)")
    chat = spark.table("some_messages").select("*", F.lit(None).cast("string").alias("call_id"), F.lit(None).cast(ops.TOOL_CALLS).alias("tool_calls"))
    columns = ["conv_id", "run_no", "seq", "n_messages", "role", "content"]
    assert rows(found, *columns) == rows(ops.merge_assistant_runs(chat), *columns)
    nothing = spark.sql("SELECT * FROM fold_runs(TABLE(SELECT * FROM some_messages WHERE conv_id < 0) PARTITION BY conv_id ORDER BY seq)")
    assert nothing.count() == 0
