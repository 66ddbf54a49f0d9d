import datetime

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from lorebase.functions.tables import create_get_policy, create_get_service_history
from lorebase.operators import service
from lorebase.session import fresh_path

POLICY = "policy STRING, policy_details STRING, last_updated DATE"


def day(text):
    return datetime.date.fromisoformat(text)


@pytest.fixture
def policies(spark):
    df = spark.createDataFrame(
        [
            ("Refund", "old", day("2023-01-01")),
            ("Refund", "new b", day("2023-05-01")),
            ("Refund", "new a", day("2023-05-01")),
            ("Refund", "undated", None),
            ("Return", "only", None),
        ],
        POLICY,
    )
    df.createOrReplaceTempView("test_policies")
    return df


def test_one_policy(spark, policies):
    create_get_policy(spark, "test_policies", "policy_of")
    assert rows(spark.sql("SELECT * FROM policy_of('Refund')")) == [("Refund", "new a", day("2023-05-01"))]
    assert rows(spark.sql("SELECT * FROM policy_of(policy_name => 'Return')")) == [("Return", "only", None)]
    assert rows(spark.sql("SELECT * FROM policy_of('refund')")) == []
    assert spark.sql("SELECT * FROM policy_of('Refund')").schema.simpleString() == (
        "struct<policy:string,policy_details:string,last_updated:date>"
    )


def test_functions_kept_in_the_catalog(spark, policies, cases):
    policies.write.mode("overwrite").saveAsTable("lore_policies")
    cases.write.mode("overwrite").saveAsTable("lore_cases")
    for _ in range(2):  # creating again replaces
        create_get_policy(spark, "lore_policies", "default.lore_get_policy", temporary=False)
        create_get_service_history(spark, "lore_cases", "default.lore_history", temporary=False)
    assert rows(spark.sql("SELECT policy_details FROM lore_get_policy('Refund')")) == [("new a",)]
    assert spark.sql("SELECT * FROM lore_history('a@x')").count() == 2
    for drop in ("FUNCTION lore_get_policy", "FUNCTION lore_history", "TABLE lore_policies", "TABLE lore_cases"):
        spark.sql(f"DROP {drop}")


def test_lateral_call_answers_every_request(spark, policies):
    create_get_policy(spark, "test_policies", "policy_of")
    spark.createDataFrame([(1, "Refund"), (2, "Return"), (3, "Missing"), (4, "Refund")], "id INT, p STRING").createOrReplaceTempView("asked")
    found = spark.sql("SELECT id, f.policy_details FROM asked, LATERAL policy_of(asked.p) f")
    assert rows(found) == [(1, "new a"), (2, "only"), (4, "new a")]


@pytest.mark.parametrize("limit", [1, 1_000])
def test_batch_of_policies(spark, policies, limit):
    asked = spark.createDataFrame([(1, "Refund"), (2, "Return"), (3, "Missing"), (4, "Refund")], "id INT, policy STRING")
    assert rows(service.lookup_policies(asked, policies, rows=limit), "id", "policy_details") == [(1, "new a"), (2, "only"), (4, "new a")]
    assert rows(service.newest_policies(policies), "policy", "policy_details") == [("Refund", "new a"), ("Return", "only")]


@pytest.fixture
def cases(spark):
    path = fresh_path(spark, "cases")
    spark.createDataFrame(
        [("a@x", "late"), ("a@x", "late"), ("a@x", None), ("b@x", "lost"), ("A@x", "late"), (None, "lost")],
        "email STRING, issue_category STRING",
    ).write.parquet(path)
    df = spark.read.parquet(path)
    df.createOrReplaceTempView("test_cases")
    return df


def test_service_history(spark, cases):
    create_get_service_history(spark, "test_cases", "history_of", as_of="DATE '2024-03-01'")
    one = spark.sql("SELECT * FROM history_of('a@x')")
    assert rows(one) == [(1, None, day("2024-03-01")), (2, "late", day("2024-03-01"))]
    assert one.schema.simpleString() == "struct<returns_last_12_months:int,issue_category:string,todays_date:date>"
    assert rows(spark.sql("SELECT * FROM history_of('nobody')")) == []
    shown = plan(one)
    assert "EqualTo(email,a@x)" in shown and "partial_count" in shown
    create_get_service_history(spark, "test_cases", "history_now")
    assert rows(spark.sql("SELECT todays_date FROM history_now('b@x')")) == [(spark.sql("SELECT current_date()").first()[0],)]


def test_batch_of_histories(spark, cases):
    asked = spark.createDataFrame([("a@x",), ("a@x",), ("c@x",)], "email STRING")
    found = service.lookup_service_history(asked, cases, F.lit("2024-03-01"))
    assert rows(found, "email", "issue_category", "returns_last_12_months") == [("a@x", "late", 2), ("a@x", None, 1)]
    create_get_service_history(spark, "test_cases", "history_of", as_of="DATE '2024-03-01'")
    asked.distinct().createOrReplaceTempView("asked_mails")
    lateral = spark.sql("SELECT a.email, f.* FROM asked_mails a, LATERAL history_of(a.email) f")
    assert rows(lateral, "email", "issue_category", "returns_last_12_months") == rows(
        found, "email", "issue_category", "returns_last_12_months"
    )
    assert rows(service.service_history_pivot(cases.filter("email = 'a@x'"), ["late", "lost"])) == [("a@x", 2, 0, 1, 3)]


@pytest.mark.parametrize("limit", [2, 1_000])
def test_trailing_counts(spark, limit):
    stamps = [("a", t) for t in ("2024-01-01 00:00:00", "2024-01-01 00:00:00", "2024-01-08 00:00:00", "2024-01-08 00:00:01", "2025-01-05 12:00:00")]
    stamps += [("b", "2024-02-29 00:00:00"), ("b", "2025-02-28 00:00:00")]
    df = spark.createDataFrame(stamps, "email STRING, t STRING").select("email", F.col("t").cast("timestamp_ntz").alias("ts"))
    spans = {"week": F.expr("INTERVAL 7 DAYS"), "year": F.expr("INTERVAL 12 MONTHS")}
    found = rows(service.trailing_counts(df, spans, limit), "email", F.col("ts").cast("string"), "cases", "week", "year")
    assert found == [
        ("a", "2024-01-01 00:00:00", 2, 2, 2),
        ("a", "2024-01-08 00:00:00", 1, 3, 3),
        ("a", "2024-01-08 00:00:01", 1, 2, 4),
        ("a", "2025-01-05 12:00:00", 1, 1, 3),
        ("b", "2024-02-29 00:00:00", 1, 1, 1),
        ("b", "2025-02-28 00:00:00", 1, 1, 2),
    ]


@pytest.mark.parametrize("limit", [3, 1_000])
def test_return_eligibility(spark, limit):
    made = [(1, "2024-01-01", f"2024-01-{2 + i:02d}", i) for i in range(14)]
    made += [(1, "2024-12-20", "2025-01-19", 20), (1, "2024-12-19", "2025-01-19", 21), (2, "2024-05-05", "2024-05-01", 22)]
    df = spark.createDataFrame(made, "customer BIGINT, p STRING, r STRING, id BIGINT").select(
        "customer", F.col("p").cast("timestamp_ntz").alias("purchased"), F.col("r").cast("timestamp_ntz").alias("returned"), "id"
    )
    found = {r.id: (r.ordinal, r.days_kept, r.eligible) for r in service.return_eligibility(df, ["id"], limit).collect()}
    assert found[0] == (1, 1, True) and found[11] == (12, 12, True) and found[12] == (13, 13, False)
    assert found[20] == (1, 30, True) and found[21] == (2, 31, False) and found[22] == (1, -4, False)
