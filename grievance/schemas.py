"""Schemas, column contracts and the fixed values the pipeline must reproduce.

Everything in the "fixed values" blocks must stay exactly as written: the
surrogate keys, region labels, timeliness buckets and quality thresholds are
compared value-for-value against the warehouse this engine replaces.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# CSV header -> raw column name (in file order).
# ---------------------------------------------------------------------------
COLUMN_MAPPING: dict[str, str] = {
    "Date received": "date_received",
    "Product": "product",
    "Sub-product": "sub_product",
    "Issue": "issue",
    "Sub-issue": "sub_issue",
    "Consumer complaint narrative": "consumer_complaint_narrative",
    "Company public response": "company_public_response",
    "Company": "company",
    "State": "state",
    "ZIP code": "zip_code",
    "Tags": "tags",
    "Consumer consent provided?": "consumer_consent_provided",
    "Submitted via": "submitted_via",
    "Date sent to company": "date_sent_to_company",
    "Company response to consumer": "company_response_to_consumer",
    "Timely response?": "timely_response",
    "Consumer disputed?": "consumer_disputed",
    "Complaint ID": "complaint_id",
}

# ---------------------------------------------------------------------------
# Raw table column order and declared VARCHAR lengths.
# ---------------------------------------------------------------------------
RAW_COLUMNS: list[str] = [
    "complaint_id", "date_received", "product", "sub_product",
    "issue", "sub_issue", "consumer_complaint_narrative",
    "company_public_response", "company", "state", "zip_code",
    "tags", "consumer_consent_provided", "submitted_via",
    "date_sent_to_company", "company_response_to_consumer",
    "timely_response", "consumer_disputed",
]

VARCHAR_LIMITS: dict[str, int] = {
    "product": 255,
    "sub_product": 255,
    "issue": 500,
    "sub_issue": 500,
    "company": 255,
    "state": 2,
    "zip_code": 10,
    "tags": 100,
    "consumer_consent_provided": 50,
    "submitted_via": 50,
    "company_response_to_consumer": 255,
    "timely_response": 10,
    "consumer_disputed": 10,
}

RAW_DATE_COLUMNS = ("date_received", "date_sent_to_company")

RAW_SCHEMA = T.StructType(
    [T.StructField("complaint_id", T.LongType(), False)]
    + [
        T.StructField(
            c,
            T.DateType() if c in RAW_DATE_COLUMNS else T.StringType(),
            True,
        )
        for c in RAW_COLUMNS[1:]
    ]
)

# Every CSV field is read as text; typing happens in the normaliser.
CSV_TEXT_SCHEMA = T.StructType(
    [T.StructField(h, T.StringType(), True) for h in COLUMN_MAPPING]
)

# ---------------------------------------------------------------------------
# Tokens a CSV reader with default settings treats as missing
# (the pandas ``read_csv`` default list).
# ---------------------------------------------------------------------------
NA_TOKENS: tuple[str, ...] = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# ---------------------------------------------------------------------------
# Surrogate-key hashing (md5 over '-'-joined text, NULL marker).
# ---------------------------------------------------------------------------
SURROGATE_KEY_SEPARATOR = "-"
SURROGATE_KEY_NULL_MARKER = "_dbt_utils_surrogate_key_null_"

# ---------------------------------------------------------------------------
# Blank-to-default replacements in staging.
# ---------------------------------------------------------------------------
NOT_SPECIFIED = "Not Specified"
UNKNOWN = "Unknown"
NO_TAGS = "None"
CONSENT_PROVIDED = "Consent provided"

# ---------------------------------------------------------------------------
# US census regions plus territories, by two-letter state code.
# ---------------------------------------------------------------------------
REGIONS: dict[str, tuple[str, ...]] = {
    "Northeast": ("CT", "ME", "MA", "NH", "RI", "VT", "NJ", "NY", "PA"),
    "Midwest": ("IL", "IN", "MI", "OH", "WI", "IA", "KS", "MN", "MO", "NE", "ND", "SD"),
    "South": ("DE", "FL", "GA", "MD", "NC", "SC", "VA", "WV", "AL", "KY", "MS", "TN",
              "AR", "LA", "OK", "TX", "DC"),
    "West": ("AZ", "CO", "ID", "MT", "NV", "NM", "UT", "WY", "AK", "CA", "HI", "OR", "WA"),
    "Territories": ("AS", "GU", "MP", "PR", "VI", "UM", "FM", "MH", "PW"),
}

# ---------------------------------------------------------------------------
# Response-timeliness buckets (inclusive day ranges).
# ---------------------------------------------------------------------------
TIMELINESS_BUCKETS: tuple[tuple[str, int, int], ...] = (
    ("Immediate", 0, 3),
    ("Fast", 4, 7),
    ("Timely", 8, 15),
)
TIMELINESS_LATE = "Late"
TIMELY_THRESHOLD_DAYS = 15

# ---------------------------------------------------------------------------
# Accepted-value lists of the gold tests.
# ---------------------------------------------------------------------------
ACCEPTED_TIMELINESS = ("Immediate", "Fast", "Timely", "Late", "Unknown")
ACCEPTED_SUBMITTED_VIA = ("Web", "Phone", "Postal mail", "Email", "Fax", "Referral", "Unknown")
ACCEPTED_REGIONS = ("Northeast", "Midwest", "South", "West", "Territories", "Unknown")
ACCEPTED_QUARTERS = (1, 2, 3, 4)

# ---------------------------------------------------------------------------
# Calendar spine of the date dimension (end exclusive).
# ---------------------------------------------------------------------------
DATE_SPINE_START = "2011-01-01"
DATE_SPINE_END = "2030-12-31"

# ---------------------------------------------------------------------------
# Final volume gate on the fact table (warn only).
# ---------------------------------------------------------------------------
FACT_MIN_ROWS = 100_000
