"""Structured look-ups for whole sets of requests at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lorebase.operators.skew import HOT_ROWS, positions, running_sum, split_join
from lorebase.session import stored

RETURNS_PER_YEAR = 12
RETURN_DAYS = 30


def newest_policies(policies: DataFrame) -> DataFrame:
    """One row per policy name: the newest, of equally new ones the first by text."""
    age = F.coalesce(-F.unix_date("last_updated"), F.lit(2**31 - 1)).alias("age")
    return (
        policies.groupBy("policy")
        .agg(F.min(F.struct(age, "policy_details", "last_updated")).alias("_newest"))
        .select("policy", "_newest.policy_details", "_newest.last_updated")
    )


def lookup_policies(requests: DataFrame, policies: DataFrame, name: str = "policy", rows: int = HOT_ROWS) -> DataFrame:
    """Every request row with the policy it names; requests for unknown policies yield no row."""
    found = newest_policies(policies).withColumnRenamed("policy", name)
    return split_join(requests, found, [name], rows=rows)


def service_history(service: DataFrame, as_of: Column) -> DataFrame:
    """Cases per customer and category, for all customers."""
    return service.groupBy("email", "issue_category").agg(
        F.count(F.lit(1)).cast("int").alias("returns_last_12_months"), as_of.cast("date").alias("todays_date")
    )


def lookup_service_history(requests: DataFrame, service: DataFrame, as_of: Column) -> DataFrame:
    """The service history of every distinct requested e-mail. Cases are counted before they meet the requests."""
    return service_history(service, as_of).join(requests.select("email").distinct(), "email", "left_semi")


def service_history_pivot(service: DataFrame, categories: list[str]) -> DataFrame:
    """One row per customer, one column per category, 0 where there is no case; `other` counts all other categories."""
    return service.groupBy("email").agg(
        *[F.count_if(F.col("issue_category") == c).alias(c) for c in categories],
        F.count_if(~F.coalesce(F.col("issue_category").isin(categories), F.lit(False))).alias("other"),
        F.count(F.lit(1)).alias("total"),
    )


def trailing_counts(service: DataFrame, spans: dict[str, Column], rows: int = HOT_ROWS) -> DataFrame:
    """Cases of the customer in the span that ends at each of their timestamps, both ends included.

    One row per (email, ts) with `cases` at that moment and one count per entry of `spans` (column name to
    interval). Each count is the difference of two running sums, so no frame is ever held in memory.
    """
    moments = stored(service.groupBy("email", "ts").agg(F.count(F.lit(1)).alias("cases")), "moments")
    marks = [F.struct(F.col("ts").alias("at"), F.lit(1).alias("side"), F.lit("").alias("span"), F.col("cases").alias("add"))]
    # A mark at the open end sorts before the cases of that very moment, which belong to the span.
    marks += [
        F.struct((F.col("ts") - width).alias("at"), F.lit(0).alias("side"), F.lit(name).alias("span"), F.lit(0).cast("long").alias("add"))
        for name, width in spans.items()
    ]
    marked = moments.select("email", "ts", "cases", F.explode(F.array(*marks)).alias("_m")).select("email", "ts", "cases", "_m.*")
    summed = running_sum(marked, ["email"], ["at", "side"], F.col("add"), "_upto", rows)
    upto = F.max(F.when(F.col("span") == "", F.col("_upto")))
    return summed.groupBy("email", "ts").agg(
        F.max("cases").alias("cases"),
        *[(upto - F.max(F.when(F.col("span") == name, F.col("_upto")))).alias(name) for name in spans],
    )


def return_eligibility(returns: DataFrame, order: list[str], rows: int = HOT_ROWS) -> DataFrame:
    """Which returns the return policy covers.

    `returns` has customer, purchased and returned timestamps; exchanges are left out beforehand. A return counts
    when it is among the customer's first 12 of its calendar year and at most 30 days after the purchase.
    """
    dated = returns.withColumn("return_year", F.year("returned"))
    ranked = positions(dated, ["customer", "return_year"], ["returned", *order], "ordinal", rows)
    waited = F.datediff("returned", "purchased")
    return ranked.withColumn("days_kept", waited).withColumn(
        "eligible", (F.col("ordinal") <= RETURNS_PER_YEAR) & waited.between(0, RETURN_DAYS)
    )
