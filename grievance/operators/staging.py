"""Silver layer: the cleaned complaint view."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grievance.functions.expressions import (
    blank_default,
    guarded_sent_date,
    narrative_flag,
    response_days,
    surrogate_key,
    upper_trim,
    yes_no_flag,
    zip_lpad,
)
from grievance.schemas import NO_TAGS, NOT_SPECIFIED, UNKNOWN

REQUIRED_FIELDS = ("complaint_id", "date_received", "product", "company")

STAGING_COLUMNS = [
    "complaint_sk", "complaint_id", "date_received", "date_sent_to_company",
    "product", "sub_product", "issue", "sub_issue", "company_name", "company_response",
    "state", "zip_code", "timely_response_flag", "consumer_disputed_flag",
    "has_narrative_flag", "complaint_narrative", "submitted_via", "tags", "response_days",
]


def required_fields(raw: DataFrame) -> DataFrame:
    """Rows whose raw id, received date, product and company are present.

    Applied to the *raw* columns, so a blank product survives (and later
    becomes 'Not Specified') while a NULL one is dropped.  The predicates are
    pushed into the Parquet scan.
    """
    cond = None
    for c in REQUIRED_FIELDS:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return raw.filter(cond)


def staging_columns(raw: DataFrame) -> list:
    """The staging projection over raw columns (one ``select``, so every
    expression sees the raw inputs: ``response_days`` uses the unguarded date)."""
    recv = F.col("date_received").cast("date")
    sent = F.col("date_sent_to_company").cast("date")
    return [
        surrogate_key("complaint_id").alias("complaint_sk"),
        F.col("complaint_id").cast("bigint").alias("complaint_id"),
        recv.alias("date_received"),
        guarded_sent_date(sent, recv).alias("date_sent_to_company"),
        blank_default("product", NOT_SPECIFIED).alias("product"),
        blank_default("sub_product", NOT_SPECIFIED).alias("sub_product"),
        blank_default("issue", NOT_SPECIFIED).alias("issue"),
        blank_default("sub_issue", NOT_SPECIFIED).alias("sub_issue"),
        upper_trim("company").alias("company_name"),
        blank_default("company_response_to_consumer", NOT_SPECIFIED).alias("company_response"),
        upper_trim("state").alias("state"),
        zip_lpad("zip_code").alias("zip_code"),
        yes_no_flag("timely_response").alias("timely_response_flag"),
        yes_no_flag("consumer_disputed").alias("consumer_disputed_flag"),
        narrative_flag("consumer_consent_provided", "consumer_complaint_narrative").alias("has_narrative_flag"),
        F.col("consumer_complaint_narrative").alias("complaint_narrative"),
        blank_default("submitted_via", UNKNOWN).alias("submitted_via"),
        blank_default("tags", NO_TAGS).alias("tags"),
        response_days(sent, recv).alias("response_days"),
    ]


def stage_complaints(raw: DataFrame) -> DataFrame:
    """raw -> silver staging (required-field filter, then the cleaning projection)."""
    return required_fields(raw).select(*staging_columns(raw))
