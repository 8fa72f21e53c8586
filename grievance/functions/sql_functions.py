"""Expose the business rules to Spark SQL, and staging as a query over the raw table.

The rules are SQL-bodied functions (``CREATE FUNCTION ... RETURN``), so
Catalyst inlines them like any other expression: no Python runs per row.  As
temporary functions they belong to a session; ``register_rules`` keeps them in
a database, where every session with the same catalog finds them.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from grievance.functions.expressions import region_case_sql, timeliness_case_sql
from grievance.schemas import CONSENT_PROVIDED, NO_TAGS, NOT_SPECIFIED, SURROGATE_KEY_NULL_MARKER, UNKNOWN

_RULES = {
    "classify_response_timeliness": ("days INT", timeliness_case_sql("days")),
    "calculate_region": ("state STRING", region_case_sql("state")),
}


def register_sql_functions(spark: SparkSession) -> None:
    """The rules as functions of this session."""
    for name, (argument, body) in _RULES.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({argument}) RETURNS STRING RETURN {body}")


def register_rules(spark: SparkSession, database: str) -> None:
    """The rules as functions of a database, for every session of the catalog."""
    for name, (argument, body) in _RULES.items():
        spark.sql(f"CREATE OR REPLACE FUNCTION {database}.{name}({argument}) RETURNS STRING RETURN {body}")


def staging_sql(raw: str) -> str:
    """The staging query over the raw table, as text for a view; the same rows as ``operators.staging``."""
    blank = lambda c, default: f"COALESCE(NULLIF(TRIM({c}), ''), '{default}')"
    flag = lambda c: f"CASE WHEN UPPER({c}) = 'YES' THEN TRUE WHEN UPPER({c}) = 'NO' THEN FALSE END"
    columns = {
        "complaint_sk": f"MD5(COALESCE(CAST(complaint_id AS STRING), '{SURROGATE_KEY_NULL_MARKER}'))",
        "complaint_id": "complaint_id",
        "date_received": "date_received",
        "date_sent_to_company": "CASE WHEN date_sent_to_company >= date_received THEN date_sent_to_company END",
        "product": blank("product", NOT_SPECIFIED),
        "sub_product": blank("sub_product", NOT_SPECIFIED),
        "issue": blank("issue", NOT_SPECIFIED),
        "sub_issue": blank("sub_issue", NOT_SPECIFIED),
        "company_name": "UPPER(TRIM(company))",
        "company_response": blank("company_response_to_consumer", NOT_SPECIFIED),
        "state": "UPPER(TRIM(state))",
        "zip_code": "LPAD(TRIM(zip_code), 5, '0')",
        "timely_response_flag": flag("timely_response"),
        "consumer_disputed_flag": flag("consumer_disputed"),
        "has_narrative_flag": f"COALESCE(consumer_consent_provided = '{CONSENT_PROVIDED}' AND consumer_complaint_narrative IS NOT NULL, FALSE)",
        "complaint_narrative": "consumer_complaint_narrative",
        "submitted_via": blank("submitted_via", UNKNOWN),
        "tags": blank("tags", NO_TAGS),
        "response_days": "DATEDIFF(date_sent_to_company, date_received)",
        "dbt_loaded_at": "CURRENT_TIMESTAMP()",
    }
    chosen = ", ".join(f"{expression} AS {name}" for name, expression in columns.items())
    required = " AND ".join(f"{c} IS NOT NULL" for c in ("complaint_id", "date_received", "product", "company"))
    return f"SELECT {chosen} FROM {raw} WHERE {required}"
