"""Column expressions (no per-row Python) and their SQL temporary functions."""
from grievance.functions.expressions import (  # noqa: F401
    blank_default,
    date_key,
    guarded_sent_date,
    lenient_bigint,
    lenient_date,
    narrative_flag,
    null_if_na_token,
    region,
    response_days,
    surrogate_key,
    timeliness_category,
    upper_trim,
    yes_no_flag,
    zip5,
    zip_lpad,
)
from grievance.functions.sql_functions import register_sql_functions  # noqa: F401
