"""Queries over policies and service cases, each with the SQL that gives the same rows.

Dates come out as text, so that every client compares them alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lorebase.functions.tables import create_get_policy, create_get_service_history
from lorebase.operators import service
from lorebase.plans import roles
from lorebase.plans.roles import AS_OF, CATEGORIES
from lorebase.session import stored
from lorebase.sources.readers import read_table

#: Rows from which a key counts as hot where a query shows how hot keys are dealt out.
SMALL = 100
SPANS = {
    "trailing_7_days": "INTERVAL 7 DAYS",
    "trailing_12_months": "INTERVAL 12 MONTHS",
}


def _text_dates(df: DataFrame) -> DataFrame:
    dated = {f.name for f in df.schema if f.dataType.typeName() == "date"}
    return df.select(*[F.col(c).cast("string").alias(c) if c in dated else F.col(c) for c in df.columns])


def get_policy(spark: SparkSession, sf: str) -> DataFrame:
    roles.policies(spark, sf).createOrReplaceTempView("policies")
    create_get_policy(spark, "policies")
    return _text_dates(spark.sql("SELECT * FROM get_policy('Policy 7')"))


def get_service_history(spark: SparkSession, sf: str) -> DataFrame:
    roles.service(spark, sf).createOrReplaceTempView("cust_service_data")
    create_get_service_history(spark, "cust_service_data", as_of=f"DATE '{AS_OF}'")
    return _text_dates(spark.sql("SELECT * FROM get_service_history(user_email => 'user8@example.com')"))


def policy_latest(spark: SparkSession, sf: str) -> DataFrame:
    return _text_dates(service.newest_policies(roles.brand_policies(spark, sf)))


def batch_policy_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Every product asks for the policy of its brand."""
    asked = read_table(spark, sf, "part").select(F.col("p_partkey").alias("request_id"), F.col("p_brand").alias("policy"))
    return _text_dates(service.lookup_policies(asked, roles.brand_policies(spark, sf)))


def batch_service_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer of the shop asks; those without a case get no row."""
    asked = read_table(spark, sf, "customer").select(roles.email(F.col("c_custkey")).alias("email"))
    return _text_dates(service.lookup_service_history(asked, roles.service(spark, sf), roles.as_of()))


def lateral_policies(spark: SparkSession, sf: str) -> DataFrame:
    """The table function called for every product's brand."""
    roles.brand_policies(spark, sf).createOrReplaceTempView("brand_policies")
    create_get_policy(spark, "brand_policies", "get_brand_policy")
    read_table(spark, sf, "part").createOrReplaceTempView("asked_parts")
    return _text_dates(
        spark.sql("SELECT p_partkey AS request_id, found.* FROM asked_parts, LATERAL get_brand_policy(p_brand) AS found")
    )


def lateral_service_history(spark: SparkSession, sf: str) -> DataFrame:
    """The table function called for every customer."""
    roles.service(spark, sf).createOrReplaceTempView("service_cases")
    create_get_service_history(spark, "service_cases", "get_case_history", as_of=f"DATE '{AS_OF}'")
    customers = read_table(spark, sf, "customer").select(roles.email(F.col("c_custkey")).alias("email"))
    customers.createOrReplaceTempView("asking_customers")
    return _text_dates(spark.sql("SELECT email, found.* FROM asking_customers, LATERAL get_case_history(email) AS found"))


def service_history_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return service.service_history_pivot(roles.service(spark, sf), CATEGORIES)


def trailing_returns(spark: SparkSession, sf: str) -> DataFrame:
    spans = {name: F.expr(width) for name, width in SPANS.items()}
    return service.trailing_counts(roles.service(spark, sf), spans)


def trailing_returns_in_slots(spark: SparkSession, sf: str) -> DataFrame:
    """The same with every customer of more than SMALL marks cut into slots, as hot ones are at full size."""
    spans = {name: F.expr(width) for name, width in SPANS.items()}
    return service.trailing_counts(roles.service(spark, sf), spans, SMALL)


def return_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    returned = stored(roles.returns(spark, sf), "returns")
    judged = service.return_eligibility(returned, ["l_orderkey", "l_linenumber"])
    return judged.select("l_orderkey", "l_linenumber", "customer", "return_year", "ordinal", "days_kept", "eligible")


QUERIES = {
    f.__name__: f
    for f in (
        get_policy,
        get_service_history,
        policy_latest,
        batch_policy_lookup,
        batch_service_history,
        lateral_policies,
        lateral_service_history,
        service_history_pivot,
        trailing_returns,
        trailing_returns_in_slots,
        return_eligibility,
    )
}

SERVICE = "SELECT 'user' || user_id || '@example.com' AS email, event_type AS issue_category, ts FROM events"
POLICIES = (
    "SELECT 'Policy ' || item_id AS policy, text AS policy_details, "
    "CAST(DATE '2023-01-01' + CAST(item_id % 365 AS INT) AS VARCHAR) AS last_updated FROM benchmark"
)
BRANDS = (
    "SELECT policy, policy_details, last_updated FROM (SELECT p_brand AS policy, p_name || ' ' || p_partkey AS policy_details, "
    "CAST(DATE '2023-01-01' + p_size AS VARCHAR) AS last_updated, row_number() OVER (PARTITION BY p_brand "
    "ORDER BY p_size DESC, p_name || ' ' || p_partkey) AS n FROM part) WHERE n = 1"
)
HISTORY = (
    f"SELECT email, issue_category, CAST(count(*) AS INT) AS returns_last_12_months, '{AS_OF}' AS todays_date "
    f"FROM ({SERVICE}) GROUP BY 1, 2"
)

TRAILING = f"""
        SELECT email, ts, count(*) AS cases, max(d) AS trailing_7_days, max(y) AS trailing_12_months
        FROM (SELECT email, ts,
                count(*) OVER (PARTITION BY email ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW) AS d,
                count(*) OVER (PARTITION BY email ORDER BY ts RANGE BETWEEN INTERVAL 12 MONTH PRECEDING AND CURRENT ROW) AS y
              FROM ({SERVICE}))
        GROUP BY 1, 2"""

ORACLES = {
    "get_policy": f"SELECT * FROM ({POLICIES}) WHERE policy = 'Policy 7'",
    "get_service_history": f"SELECT returns_last_12_months, issue_category, todays_date FROM ({HISTORY}) "
    "WHERE email = 'user8@example.com'",
    "policy_latest": BRANDS,
    "batch_policy_lookup": f"SELECT p_partkey AS request_id, b.* FROM part JOIN ({BRANDS}) b ON policy = p_brand",
    "batch_service_history": f"SELECT h.* FROM ({HISTORY}) h "
    "WHERE email IN (SELECT 'user' || c_custkey || '@example.com' FROM customer)",
    "lateral_policies": f"SELECT p_partkey AS request_id, b.* FROM part JOIN ({BRANDS}) b ON policy = p_brand",
    "lateral_service_history": f"SELECT h.* FROM ({HISTORY}) h "
    "WHERE email IN (SELECT 'user' || c_custkey || '@example.com' FROM customer)",
    "service_history_pivot": "SELECT email, "
    + ", ".join(f"count(*) FILTER (issue_category = '{c}') AS {c}" for c in CATEGORIES)
    + ", count(*) FILTER (issue_category IS NULL OR issue_category NOT IN ("
    + ", ".join(f"'{c}'" for c in CATEGORIES)
    + f")) AS other, count(*) AS total FROM ({SERVICE}) GROUP BY 1",
    "trailing_returns": TRAILING,
    "trailing_returns_in_slots": TRAILING,
    "return_eligibility": """
        SELECT l_orderkey, l_linenumber, customer, return_year, ordinal, days_kept,
               ordinal <= 12 AND days_kept BETWEEN 0 AND 30 AS eligible
        FROM (SELECT l_orderkey, l_linenumber, o_custkey AS customer, CAST(year(l_shipdate) AS INT) AS return_year,
                     row_number() OVER (PARTITION BY o_custkey, year(l_shipdate) ORDER BY l_shipdate, l_orderkey, l_linenumber) AS ordinal,
                     CAST(date_diff('day', o_orderdate, l_shipdate) AS INT) AS days_kept
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag = 'R')""",
}
