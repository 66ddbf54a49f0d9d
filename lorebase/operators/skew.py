"""Keeping hot keys out of single tasks.

The hot keys of a table are its 1,000 most frequent ones, as far as they have more than `rows` rows; any other key
holds less than a thousandth of the table. They are found when an operator is set up, by a count over the key columns
that is pre-aggregated before its shuffle. The count only decides how rows are dealt out to tasks, so an estimate will do:
it looks at a share of the rows in which a hot key still shows thousands of times. Every row takes part in the result
either way. Without a hot key the operators below are the plain join or window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.window import Window

from lorebase.session import stored

HOT_ROWS = 1_000_000
MAX_HOT = 1_000
SHOWN = 10_000
MAX_SALT = 4_096
MAX_SLOTS = 10_000


def whole(dividend: Column, divisor: int) -> Column:
    """Integer division of whole numbers, exact for every BIGINT."""
    return F.call_function("div", dividend, F.lit(divisor))


def hot_keys(df: DataFrame, keys: list[str], rows: int = HOT_ROWS) -> DataFrame | None:
    """The hot keys of `df` with their estimated row count `_n`, at most 1,000 rows; None if there are none.

    A key of `rows` rows shows about SHOWN times among the rows looked at; for small `rows` these are all. A null is
    a key like any other here.
    """
    share = min(1.0, SHOWN / rows)
    looked_at = df.select(*keys) if share == 1.0 else df.select(*keys).sample(share, seed=1)
    counts = looked_at.groupBy(*keys).agg((F.count(F.lit(1)) / share).cast("long").alias("_n"))
    top = counts.filter(F.col("_n") > rows).orderBy(F.desc("_n"), *keys).limit(MAX_HOT)
    found = top.collect()
    return df.sparkSession.createDataFrame(found, top.schema) if found else None


def split_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", rows: int = HOT_ROWS) -> DataFrame:
    """Equi-join whose hot keys on the left are spread over several tasks.

    Left rows of a hot key are dealt to ceil(n / rows) salts; the right rows of that key are repeated once per
    salt, every other right row exactly once. Left rows with a null key match nothing and may go anywhere. `how` is
    inner, left, left_semi or left_anti: each decides per left row, so repeating right rows under different salts
    never changes the result.
    """
    hot = hot_keys(left, on, rows)
    if hot is None:
        return left.join(right, on, how)
    salts = F.least(F.lit(MAX_SALT), F.ceil(F.col("_n") / rows)).cast("int")
    hot = F.broadcast(hot.select(*on, salts.alias("_salts")))
    # The salt follows from the row and its task, so a task that is run again deals its rows the same way.
    hashed = [f.name for f in left.schema if not isinstance(f.dataType, T.MapType)]
    drawn = F.xxhash64(*hashed, F.spark_partition_id())
    unmatched = reduce(Column.__or__, [F.col(key).isNull() for key in on])
    dealt = left.join(hot, on, "left").withColumn(
        "_salt", F.pmod(drawn, F.when(unmatched, MAX_SALT).otherwise(F.coalesce("_salts", F.lit(1)))).cast("int")
    )
    repeated = right.join(hot, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))
    )
    return dealt.drop("_salts").join(repeated.drop("_salts"), [*on, "_salt"], how).drop("_salt")


def running_sum(
    df: DataFrame, keys: list[str], order: list[str], value: Column, out: str, rows: int = HOT_ROWS
) -> DataFrame:
    """Inclusive running sum of `value` per key, in `order`, as BIGINT column `out`.

    The rows of hot keys are range-partitioned by key and order into slots of about `rows` rows. Each slot is
    summed by itself and then lifted by the total of the slots before it, so a key may spread over any number of
    tasks. The cut is stored, because both steps must see the same one. Keys must not be null.
    """
    upto = Window.unboundedPreceding, Window.currentRow
    plain = F.sum(value).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(*upto)).cast("long")
    hot = hot_keys(df, keys, rows)
    if hot is None:
        return df.withColumn(out, plain)
    names = F.broadcast(hot.select(*keys))
    slots = max(2, min(MAX_SLOTS, -(-hot.agg(F.sum("_n")).first()[0] // rows)))
    cut = stored(
        df.join(names, keys, "left_semi")
        .repartitionByRange(slots, *keys, *order)
        .withColumn("_slot", F.spark_partition_id()),
        "slots",
    )
    piece = [*keys, "_slot"]
    earlier = Window.partitionBy(*keys).orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per slot and one per hot key: never more than 11,000.
    before = cut.groupBy(*piece).agg(F.sum(value).alias("_total")).select(
        *piece, F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_before")
    )
    inside = F.sum(value).over(Window.partitionBy(*piece).orderBy(*order).rowsBetween(*upto))
    lifted = (
        cut.withColumn("_inside", inside)
        .join(F.broadcast(before), piece)
        .withColumn(out, (F.col("_inside") + F.col("_before")).cast("long"))
        .drop("_slot", "_inside", "_before")
    )
    return df.join(names, keys, "left_anti").withColumn(out, plain).unionByName(lifted)


def positions(df: DataFrame, keys: list[str], order: list[str], out: str, rows: int = HOT_ROWS) -> DataFrame:
    """1-based position of each row within its key: `row_number()` with hot keys spread over tasks."""
    return running_sum(df, keys, order, F.lit(1), out, rows)
