"""SQL table functions over the policy and service tables."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _kind(temporary: bool) -> str:
    return "TEMPORARY FUNCTION" if temporary else "FUNCTION"


def create_get_policy(spark: SparkSession, policies: str, name: str = "get_policy", temporary: bool = True) -> None:
    """`SELECT * FROM get_policy('Refund Policy')`: the newest policy of that exact name, or no row.

    The body aggregates instead of ending in LIMIT 1: called through LATERAL, a limit would be applied to the
    whole table before the name is matched.
    """
    spark.sql(f"""
        CREATE OR REPLACE {_kind(temporary)} {name}(policy_name STRING COMMENT 'Exact name of the policy')
        RETURNS TABLE (policy STRING, policy_details STRING, last_updated DATE)
        COMMENT 'Returns the details of a company policy'
        RETURN
          SELECT policy, newest.policy_details, newest.last_updated
          FROM (
            SELECT policy, min(struct(coalesce(-unix_date(last_updated), 2147483647) AS age, policy_details, last_updated)) AS newest
            FROM {policies}
            WHERE policy = policy_name
            GROUP BY policy)
    """)


def create_get_service_history(
    spark: SparkSession, service: str, name: str = "get_service_history", temporary: bool = True, as_of: str = "now()"
) -> None:
    """`SELECT * FROM get_service_history('a@example.com')`: one row per issue category of that customer.

    Every row of the customer is counted, whatever its date, although the column speaks of 12 months;
    `trailing_counts` has the dated form. `as_of` is an SQL expression for today.
    """
    spark.sql(f"""
        CREATE OR REPLACE {_kind(temporary)} {name}(user_email STRING COMMENT 'E-mail address of the customer')
        RETURNS TABLE (returns_last_12_months INT, issue_category STRING, todays_date DATE)
        COMMENT 'Returns the number of service cases of a customer per issue category'
        RETURN
          SELECT CAST(count(*) AS INT), issue_category, CAST({as_of} AS DATE)
          FROM {service}
          WHERE email = user_email
          GROUP BY issue_category
    """)
